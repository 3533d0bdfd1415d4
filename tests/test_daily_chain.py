"""End-to-end daily chain on the sf0.001 driver tables."""
import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow.plans import reports, tasklog, triggers
from opsflow.plans.world import care_tables
from opsflow.schemas import QUEUE_COLUMNS
from opsflow.session import cut_lineage
from opsflow.sources.tables import Tables

SF = "/root/testdata/sf0.001"
AS_OF = datetime(1998, 6, 18, 9, 30)
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_daily_chain(spark, scratch):
    c = care_tables(Tables.from_parquet_dir(spark, SF))
    log0 = c["task_log"]
    new = triggers.run_all(c, log0, c["prev_county"], AS_OF)
    n_new = new.count()
    assert n_new > 0 and set(r.status for r in new.select("status").distinct().collect()) == {"Pending"}

    # version 1 of the log: persisted, lineage cut through the shared checkpoint dir
    log1 = tasklog.append_tasks(log0, new)
    path1 = tasklog.write_version(log1, os.path.join(scratch, "log"), 1)
    log1 = cut_lineage(spark.read.parquet(path1))
    assert log1.count() == log0.count() + n_new
    assert log1.select("taskid").distinct().count() == log1.count()

    empty_q = spark.createDataFrame([], log1.select(*QUEUE_COLUMNS).schema)
    queue = tasklog.enqueue(log1, empty_q)
    assert tasklog.enqueue(log1, queue).count() == queue.count()          # enqueue twice adds nothing

    payloads = tasklog.build_payload(queue, c["assignee_types"])
    sample = json.loads(payloads.first().payload)
    assert [e["Key"] for e in sample][-1] == "AssignTaskTo_Group"

    # a caller-owned sender answered: every third task fails
    resp = queue.select("taskid", F.when(F.col("taskid") % 3 == 0, F.lit('{"statusCode":422,"detailedMessage":"x"}'))
                        .otherwise(F.concat(F.lit('{"statusCode":200,"data":"Task \''), F.col("taskid").cast("string"),
                                            F.lit('\' ok"}'))).alias("response"))
    log2, queue2 = tasklog.apply_responses(log1, queue, resp, AS_OF)
    assert log2.count() == log1.count() and queue2.count() == 0            # conservation; queue drained
    got = log2.join(queue.select("taskid"), "taskid").groupBy("status").count().collect()
    counts = {r.status: r["count"] for r in got}
    assert counts.get("Sent", 0) + counts.get("Failed", 0) == queue.count()

    entries = log2.where(F.col("status") == "Sent").select(F.col("ehr_task_number").alias("wf_task_number"),
                                                           F.lit(1).alias("cb_completed"))
    log3 = tasklog.mark_completed(log2, entries)
    assert log3.where(F.col("status") == "Sent").count() == 0

    digest = reports.fail_digest(log3, AS_OF).first()
    assert digest.total_rows >= 1 and "<tr><td>x</td></tr>" in digest.body_rows
