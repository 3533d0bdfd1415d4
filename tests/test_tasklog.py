import json
import os
from datetime import date, datetime

from pyspark.sql import functions as F

from opsflow.plans import reports, tasklog
from opsflow.schemas import LOG_DDL, QUEUE_COLUMNS

AS_OF = datetime(2026, 3, 5, 8, 0)


def _log(spark, rows):
    cols = [c.split()[0] for c in LOG_DDL.split(", ")]
    data = []
    for r in rows:
        d = dict.fromkeys(cols)
        d.update(r)
        data.append(d)
    return spark.createDataFrame(data, LOG_DDL)


def _base(spark):
    return _log(spark, [
        dict(taskid=1, task_code="ASSIGN NURSE", due=date(2026, 3, 1), status="Pending", notes='say "hi" <b>',
             grp1_type1=3, grp1_assignee1="HM1", status_note="stale"),
        dict(taskid=2, task_code="OT Alert", due=date(2026, 3, 2), status="Pending", grp1_type1=1),
        dict(taskid=3, task_code="OT Alert", due=date(2026, 3, 2), status="Pending"),
        dict(taskid=4, task_code="OT Alert", status="Sent", ehr_task_number="900"),
        dict(taskid=5, task_code="X", status="Failed", status_note="a & b"),
    ])


def test_enqueue_is_idempotent(spark):
    log = _base(spark)
    empty = spark.createDataFrame([], log.select(*QUEUE_COLUMNS).schema)
    q1 = tasklog.enqueue(log, empty)
    q2 = tasklog.enqueue(log, q1)
    assert sorted(r.taskid for r in q1.collect()) == [1, 2, 3]
    assert q2.count() == 3


def test_apply_responses_state_machine(spark):
    log = _base(spark)
    queue = tasklog.enqueue(log, spark.createDataFrame([], log.select(*QUEUE_COLUMNS).schema))
    resp = spark.createDataFrame([
        (1, '{"statusCode":200,"data":"Task \'T-77\' created"}'),
        (2, '{"statusCode":400,"detailedMessage":"bad assignee"}'),
        (3, '{"statusCode":500}'),
        (4, '{"statusCode":200,"data":"Task \'T-1\' created"}'),   # not queued: ignored
    ], "taskid bigint, response string")
    nlog, nqueue = tasklog.apply_responses(log, queue, resp, AS_OF)
    got = {r.taskid: r for r in nlog.collect()}
    assert nlog.count() == log.count()                         # row count conserved
    assert (got[1].status, got[1].ehr_task_number, got[1].status_note) == ("Sent", "T-77", None)
    assert (got[2].status, got[2].status_note) == ("Failed", "bad assignee")
    assert (got[3].status, got[3].status_note) == ("Failed", None)      # Q12: no message inherited
    assert got[4].status == "Sent" and got[4].ehr_task_number == "900" and got[4].processed_date is None
    assert all(got[i].processed_date == AS_OF for i in (1, 2, 3))
    assert nqueue.count() == 0


def test_mark_completed(spark):
    log = _base(spark)
    entries = spark.createDataFrame([("900", 1), ("900", 1), ("901", 0)], "wf_task_number string, cb_completed int")
    out = {r.taskid: r.status for r in tasklog.mark_completed(log, entries).collect()}
    assert out[4] == "Completed" and out[1] == "Pending" and len(out) == 5


def test_payload_round_trips(spark):
    log = _base(spark)
    types = spark.createDataFrame([(1, "CaseManager"), (3, "User")], "id int, type string")
    queue = tasklog.enqueue(log, spark.createDataFrame([], log.select(*QUEUE_COLUMNS).schema))
    rows = {r.taskid: json.loads(r.payload) for r in tasklog.build_payload(queue, types).collect()}
    p1 = {e["Key"]: e["Value"] for e in rows[1]}
    assert p1["WF_Task_Code"] == "ASSIGN NURSE" and p1["Due_Date"] == "2026-03-01"
    assert p1["WF_Task_Notes"] == 'say "hi" <b>' and p1["Start_Date"] == ""
    grp = p1["AssignTaskTo_Group"][0]
    assert grp == [{"Key": "Assignee1_Type", "Value": "User"}, {"Key": "Assignee1", "Value": "HM1"}]
    p3 = {e["Key"]: e["Value"] for e in rows[3]}
    assert p3["AssignTaskTo_Group"][0][0]["Value"] == ""


def test_fail_digest_escapes_and_handles_null(spark):
    log = _log(spark, [dict(taskid=1, status="Failed", status_note="x<y"),
                       dict(taskid=2, status="Failed", status_note=None),
                       dict(taskid=3, status="Failed", status_note="x<y"),
                       dict(taskid=4, status="Sent")])
    d = reports.fail_digest(log, AS_OF).first()
    assert d.total_rows == 2 and d.body_rows == "<tr></tr><tr><td>x&lt;y</td></tr>"
    none = reports.fail_digest(log.where(F.col("status") == "Sent"), AS_OF).first()
    assert none.total_rows == 0 and none.body_rows == ""
    assert [r.taskid for r in reports.fail_export(log).collect()] == [1, 2, 3]


def test_append_tasks_numbers_after_max(spark):
    log = _base(spark)
    new = log.where(F.col("taskid") <= 2).drop("taskid")
    out = tasklog.append_tasks(log, new)
    assert sorted(r.taskid for r in out.collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_fail_export_file_format(spark, scratch):
    import glob
    log = _log(spark, [dict(taskid=3, status="Failed", status_note="b"), dict(taskid=1, status="Failed",
                                                                             status_note="a\\tb"),
                       dict(taskid=2, status="Sent")])
    out = os.path.join(scratch, "export")
    reports.write_fail_export(reports.fail_export(log).coalesce(1), out)
    text = "".join(open(f).read() for f in sorted(glob.glob(os.path.join(out, "part-*"))))
    lines = text.splitlines()
    assert lines[0].split("\t")[:3] == ["taskid", "task_code", "due"]
    assert [ln.split("\t")[0] for ln in lines[1:]] == ["1", "3"]


def test_mark_completed_spreads_tasks_without_number(spark):
    """Rows whose join key is null must not meet in one task (its memory grew with the table)."""
    log = spark.range(2000).select(F.col("id").alias("taskid"), F.when(F.col("id") % 10 == 0, F.col("id").cast("string")).alias("ehr_task_number"))
    entries = spark.range(0, 2000, 20).select(F.col("id").cast("string").alias("wf_task_number"), F.lit(1).alias("cb_completed"))
    entries = entries.union(spark.createDataFrame([(None, 1)], "wf_task_number string, cb_completed int"))
    keys = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        rows = tasklog.mark_completed(tasklog.to_log_rows(log), entries).select("taskid", "status", F.spark_partition_id().alias("part")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(rows) == 2000
    assert {r.taskid for r in rows if r.status == "Completed"} == set(range(0, 2000, 20))
    per = [sum(r.part == p for r in rows) for p in {r.part for r in rows}]
    assert max(per) < 2 * len(rows) / 8
