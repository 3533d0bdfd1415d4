"""The command line runs the jobs end to end (in-process, shared session)."""
import json
import os

import pytest

from opsflow.__main__ import main
from opsflow.plans.world import care_tables
from opsflow.sources.tables import Tables

from test_ingest import HEADER, _rows, _write

SF = "/root/testdata/sf0.001"


def test_cli_etl(spark, scratch, capsys):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _write(src, "sales_a.txt", [HEADER] + _rows("K", 4, 1))
    assert main(["etl", src, os.path.join(scratch, "t"), "--archive", os.path.join(src, "archived"),
                 "--as-of", "2026-03-02T14:42:00"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["files"][0]["inserted"] == 4 and out["failed"] == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_cli_rules_and_compliance(spark, scratch, capsys):
    c = care_tables(Tables.from_parquet_dir(spark, SF))
    tables = os.path.join(scratch, "tables")
    for n in ["patients", "residency", "employees", "users", "admissions", "certifications", "task_entries",
              "visits", "hold_reports", "comm_logs", "eligibility", "utilization", "overtime_reports",
              "assignee_types"]:
        c[n].write.parquet(os.path.join(tables, n))
    state = os.path.join(scratch, "state")
    assert main(["rules", tables, state, "--as-of", "1998-06-18T09:30:00"]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["log_version"] == 1 and out["snapshot_version"] == 1
    assert main(["fail-summary", state, "--as-of", "1998-06-18T09:30:00"]) == 0
    assert main(["compliance", tables, os.path.join(scratch, "out"), "--as-of", "1998-06-18T09:30:00"]) == 0
    assert spark.read.parquet(os.path.join(scratch, "out", "actions")).count() > 0


def test_cli_etl_stream(spark, scratch, capsys):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _write(src, "sales_s.txt", [HEADER] + _rows("S", 5, 1))
    tgt = os.path.join(scratch, "t")
    assert main(["etl", src, tgt, "--stream", os.path.join(scratch, "ckpt")]) == 0
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["batches"] == 1 and spark.read.parquet(tgt).count() == 5
