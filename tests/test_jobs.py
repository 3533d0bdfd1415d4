"""Scheduled jobs over versioned state, on the sf0.001 driver tables."""
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow.plans import jobs
from opsflow.plans.world import care_tables
from opsflow.sources.tables import Tables
from opsflow.sources.versioned import VersionedTable

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_versioned_table_pins_and_publishes(spark, scratch):
    vt = VersionedTable(spark, os.path.join(scratch, "t"))
    assert vt.current_version() is None
    assert vt.write_next(spark.range(3)) == 1
    v1 = vt.read()
    assert vt.write_next(spark.range(5)) == 2
    assert vt.read().count() == 5 and vt.read(1).count() == 3 and v1.count() == 3


def test_daily_jobs(spark, scratch):
    c = care_tables(Tables.from_parquet_dir(spark, SF))
    log = VersionedTable(spark, os.path.join(scratch, "log"))
    snap = VersionedTable(spark, os.path.join(scratch, "snap"))
    queue = VersionedTable(spark, os.path.join(scratch, "queue"))
    log.write_next(c["task_log"])
    snap.write_next(c["prev_county"])
    as_of = datetime(1998, 6, 18, 9, 30)
    r = jobs.run_rules(c, log, snap, as_of)
    assert r == {"log_version": 2, "snapshot_version": 2}
    grown = log.read().count() - log.read(1).count()
    assert grown > 0

    def send(payloads):  # the caller's vendor client; here every task succeeds
        return payloads.select("taskid", F.concat(F.lit('{"statusCode":200,"data":"Task \''),
                                                  F.col("taskid").cast("string"), F.lit('\' ok"}')).alias("response"))

    m = jobs.run_manager(c, log, queue, as_of, send)
    assert m["log_version"] == 3 and queue.read().count() == 0
    assert log.read().where(F.col("status") == "Pending").count() == 0
    digest = jobs.run_fail_summary(log, as_of, os.path.join(scratch, "export")).first()
    assert digest.total_rows >= 1
    out = jobs.run_compliance(c, as_of)
    assert out["check"].count() > 0 and out["actions"].count() > 0


def test_manager_marks_vendor_completions(spark, scratch):
    c = care_tables(Tables.from_parquet_dir(spark, SF))
    log = VersionedTable(spark, os.path.join(scratch, "log"))
    queue = VersionedTable(spark, os.path.join(scratch, "queue"))
    log.write_next(c["task_log"])
    as_of = datetime(1998, 6, 18, 9, 30)

    def send(payloads):  # vendor numbers every task as "V<taskid>"
        return payloads.select("taskid", F.concat(F.lit('{"statusCode":200,"data":"Task \'V'),
                                                  F.col("taskid").cast("string"), F.lit('\' ok"}')).alias("response"))

    pending = c["task_log"].where(F.col("status") == "Pending").select("taskid")
    entries = pending.select(F.concat(F.lit("V"), F.col("taskid").cast("string")).alias("wf_task_number"),
                             (F.col("taskid") % 2).cast("int").alias("cb_completed"))
    jobs.run_manager(c, log, queue, as_of, send, entries=entries)
    after = log.read().join(pending, "taskid")
    counts = {r.status: r["count"] for r in after.groupBy("status").count().collect()}
    n = pending.count()
    assert counts.get("Completed", 0) == pending.where(F.col("taskid") % 2 == 1).count()
    assert counts.get("Completed", 0) + counts.get("Sent", 0) == n
