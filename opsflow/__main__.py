"""Command line for the scheduled jobs.

    python -m opsflow etl SOURCE_DIR TARGET [--archive DIR] [--stream CHECKPOINT] [--sep CHAR] [--table] [--as-of TS]
    python -m opsflow rules TABLES_DIR STATE_DIR [--as-of TS]
    python -m opsflow manager TABLES_DIR STATE_DIR --sender MODULE:FUNCTION [--unanswered hold|resend] [--as-of TS]
    python -m opsflow fail-summary STATE_DIR [--export PATH] [--as-of TS]
    python -m opsflow compliance TABLES_DIR OUT_DIR [--as-of TS]

``TABLES_DIR`` holds one parquet dataset per care table (``admissions``,
``certifications``, ``task_entries``, ``patients``, ``visits``, ...), which
are right-trimmed on read (fixed-width text). ``STATE_DIR`` holds the
versioned ``task_log``, ``queue`` and ``county_snapshot``. The task manager's
sender is a function of one payload (JSON text) that returns the vendor's response text; Spark
calls it on the executors, once per task. With ``--table`` the ETL's TARGET is a catalog table's name.
The session comes from ``spark-submit``/the environment; only settings the
results depend on are pinned.
"""

from __future__ import annotations

import argparse
import importlib
import json
from datetime import datetime

from .plans import ingest, jobs
from .plans.outbox import row_sender
from .session import get_session
from .sources.files import Files
from .sources.tables import Tables
from .sources.versioned import VersionedTable

CARE_TABLES = ["patients", "residency", "employees", "users", "admissions", "certifications", "task_entries",
               "visits", "hold_reports", "comm_logs", "eligibility", "utilization", "overtime_reports",
               "assignee_types"]


def _as_of(s: str | None) -> datetime:
    return datetime.fromisoformat(s) if s else datetime.now().replace(microsecond=0)


def _tables(spark, root: str) -> Tables:
    files = Files(spark, root)
    present = [n for n in CARE_TABLES if files.exists(f"{root}/{n}")]
    return Tables({n: (lambda n=n: spark.read.parquet(f"{root}/{n}")) for n in present}).normalized()


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="opsflow")
    sub = ap.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("source_dir")
    e.add_argument("target")
    e.add_argument("--archive")
    e.add_argument("--pattern", default="sales*.txt")
    e.add_argument("--stream", metavar="CHECKPOINT")
    e.add_argument("--sep", default=",")
    e.add_argument("--table", action="store_true")
    r = sub.add_parser("rules")
    r.add_argument("tables_dir")
    r.add_argument("state_dir")
    m = sub.add_parser("manager")
    m.add_argument("tables_dir")
    m.add_argument("state_dir")
    m.add_argument("--sender", required=True)
    m.add_argument("--unanswered", choices=("hold", "resend"), default="hold")
    f = sub.add_parser("fail-summary")
    f.add_argument("state_dir")
    f.add_argument("--export")
    c = sub.add_parser("compliance")
    c.add_argument("tables_dir")
    c.add_argument("out_dir")
    for p in (e, r, m, f, c):
        p.add_argument("--as-of", dest="as_of")
    a = ap.parse_args(argv)
    spark = get_session(app=f"opsflow-{a.cmd}")
    as_of = _as_of(a.as_of)
    out: dict = {"job": a.cmd, "as_of": as_of.isoformat()}
    if a.cmd == "etl":
        path, name = (None, a.target) if a.table else (a.target, None)
        if a.stream:
            from .streaming.ingest_stream import start_ingest_stream
            q = start_ingest_stream(spark, a.source_dir, path, a.stream, pattern=a.pattern,
                                    archive_dir=a.archive, sep=a.sep, target_table=name)
            q.awaitTermination()
            out["batches"] = q.last_load["batches"]
        else:
            res = ingest.run_etl(spark, a.source_dir, path, as_of, archive_dir=a.archive, pattern=a.pattern, sep=a.sep,
                                 target_table=name)
            out["failed"] = res["failed"]
            out["files"] = [r.asDict() for r in res["stats"].collect()] if res["stats"] is not None else []
    elif a.cmd == "rules":
        t = _tables(spark, a.tables_dir)
        out.update(jobs.run_rules(t, VersionedTable(spark, f"{a.state_dir}/task_log"),
                                  VersionedTable(spark, f"{a.state_dir}/county_snapshot"), as_of))
    elif a.cmd == "manager":
        module, _, function = a.sender.partition(":")
        sender = row_sender(getattr(importlib.import_module(module), function))
        out.update(jobs.run_manager(_tables(spark, a.tables_dir), VersionedTable(spark, f"{a.state_dir}/task_log"),
                                    VersionedTable(spark, f"{a.state_dir}/queue"), as_of, sender, unanswered=a.unanswered))
    elif a.cmd == "fail-summary":
        row = jobs.run_fail_summary(VersionedTable(spark, f"{a.state_dir}/task_log"), as_of, a.export).first()
        out.update({"total_rows": row.total_rows, "body_rows": row.body_rows})
    elif a.cmd == "compliance":
        res = jobs.run_compliance(_tables(spark, a.tables_dir), as_of)
        for name, df in res.items():
            df.write.mode("overwrite").parquet(f"{a.out_dir}/{name}")
        out["written"] = sorted(res)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
