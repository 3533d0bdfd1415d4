"""Task log and queue lifecycle (B5-B13, J23, J24) as immutable versions.

The source mutates a log and a queue row by row from a cursor. Here every
step takes the current version(s) and returns the next one: a merge is a
keyed left join plus ``coalesce``/``when``, a delete is a left-anti join.
The caller persists each version (``sources.versioned.VersionedTable``, or
``sources.bucketed.BucketedTable``, which rewrites only the buckets that a merge
touches), so a failed job never leaves a half-updated log behind.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..schemas import LOG_COLUMNS, LOG_FIELDS, NEW_TASK_COLUMNS, QUEUE_COLUMNS
from ..session import staged
from ..sources import constants as K

_POS_BITS = 33  # monotonically_increasing_id keeps the row position in the low 33 bits


def assign_taskids(new_tasks: DataFrame, log: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """``taskid = max(log.taskid) + dense position`` under a total order.

    Two-level offsets instead of one global window: rows are range-sorted and
    *written* with the number of their partition and their position in it; the
    written partitions are counted, and a running sum over those counts (one row per
    partition) gives each one's offset. Both the counts and the ids come from the same written
    rows, so ids are dense and unique whatever the planner reuses, whatever AQE does
    and whatever is run again. No step funnels rows through a single task.
    """
    order = order or [F.col(c).asc_nulls_first() for c in NEW_TASK_COLUMNS]
    n = int(new_tasks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = new_tasks.repartitionByRange(n, *order).sortWithinPartitions(*order) \
        .withColumn("_mid", F.monotonically_increasing_id())
    s = staged(s.withColumn("_pid", F.shiftright("_mid", _POS_BITS))
                .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1)).drop("_mid"), "task-ids")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # Running sum over the counts table: at most one row per partition, so
    # its single-partition window is bounded by the partition count.
    offs = counts.select("_pid", F.coalesce(
        F.sum("_n").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    base = log.agg(F.coalesce(F.max("taskid"), F.lit(0)).cast("bigint")).scalar()  # scalar subquery
    out = s.join(F.broadcast(offs), "_pid")
    return out.withColumn("taskid", (base + F.col("_off") + F.col("_pos") + 1).cast("bigint")) \
              .drop("_pid", "_pos", "_off")


def to_log_rows(df: DataFrame) -> DataFrame:
    """Project to the full log schema; absent columns become typed NULLs."""
    have = set(df.columns)
    return df.select(*[(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in LOG_FIELDS])


def append_tasks(log: DataFrame, new_tasks: DataFrame) -> DataFrame:
    """B5+B6: next log version = log + numbered new tasks."""
    return to_log_rows(log).unionByName(to_log_rows(assign_taskids(new_tasks, log)))


def enqueue(log: DataFrame, queue: DataFrame) -> DataFrame:
    """Next queue version = queue + Pending log rows not yet queued."""
    pending = log.where(T.ci_eq("status", K.STATUS_PENDING)).select(*QUEUE_COLUMNS)
    queued = queue.select(F.col("taskid").alias("_q_id"))
    fresh = pending.join(queued, pending.taskid == queued._q_id, "left_anti")
    return queue.select(*QUEUE_COLUMNS).unionByName(fresh)


# ---- fixed values: payload keys, in template order ----
PAYLOAD_FIELDS = [
    ("WF_Task_Code", "task_code"),
    ("Due_Date", "due"),
    ("Start_Date", "start_date"),
    ("End_Date", "end_date"),
    ("Patient_Number", "patient_number"),
    ("Admission_Number", "admission_number"),
    ("CP_Clinical_Note_Number", "clinical_note_number"),
    ("Employee_ID", "employeeid"),
    ("WF_Task_Notes", "notes"),
]


def _kv(key: str, value: Column) -> Column:
    return F.to_json(F.struct(F.lit(key).alias("Key"), value.alias("Value")))


def build_payload(queue: DataFrame, assignee_types: DataFrame) -> DataFrame:
    """One JSON payload per Pending queue row, ``(taskid, payload)``.

    Values are ``ISNULL(x, '')`` text; the assignee type id is resolved to
    its name through ``assignee_types(id, type)``. ``to_json`` escapes the
    text (quirk Q13 fixed).
    """
    q = queue.where(T.ci_eq("status", K.STATUS_PENDING))
    at = assignee_types.select(F.col("id").alias("_at_id"), F.col("type").alias("_at_type"))
    q = q.join(at, q.grp1_type1 == at._at_id, "left")
    txt = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    elems = [_kv(k, txt(c)) for k, c in PAYLOAD_FIELDS]
    group = F.array(F.array(
        F.struct(F.lit("Assignee1_Type").alias("Key"), F.coalesce(F.col("_at_type"), F.lit("")).alias("Value")),
        F.struct(F.lit("Assignee1").alias("Key"), txt("grp1_assignee1").alias("Value"))))
    elems.append(F.to_json(F.struct(F.lit("AssignTaskTo_Group").alias("Key"), group.alias("Value"))))
    return q.select("taskid", F.concat(F.lit("["), F.concat_ws(",", *elems), F.lit("]")).alias("payload"))


def classify_responses(responses: DataFrame) -> DataFrame:
    """``(taskid, ok, ehr_task_number, message)`` per response."""
    r = F.col("response")
    ok = F.coalesce(r.like('%"statusCode":200%'), F.lit(False))
    return responses.select(
        "taskid", ok.alias("_ok"),
        F.when(ok, F.nullif(T.between_quotes(F.get_json_object(r, "$.data")), F.lit(""))).alias("_number"),
        F.when(~ok, F.get_json_object(r, "$.detailedMessage")).alias("_message"))


def response_updates(queue: DataFrame, responses: DataFrame) -> DataFrame:
    """What the answers to Pending queue rows say: _u_id, _ok, _number, _message; one row per answered task."""
    batch = queue.where(T.ci_eq("status", K.STATUS_PENDING)).select(F.col("taskid").alias("_b_id"))
    # Of repeated answers to a task the least text counts, so a log row is never multiplied.
    answers = responses.groupBy("taskid").agg(F.min("response").alias("response"))
    upd = classify_responses(answers)
    return upd.join(batch, upd.taskid == batch._b_id, "left_semi").withColumnRenamed("taskid", "_u_id")


def answered_rows(log: DataFrame, updates: DataFrame, as_of: datetime, how: str = "left") -> DataFrame:
    """Log rows with their answers merged in; ``how="inner"`` gives the changed rows only."""
    j = log.join(updates, log.taskid == updates._u_id, how)
    hit = F.col("_u_id").isNotNull()
    new = {
        "status": F.when(hit, F.when(F.col("_ok"), F.lit(K.STATUS_SENT)).otherwise(F.lit(K.STATUS_FAILED))).otherwise(F.col("status")),
        "ehr_task_number": F.when(hit & F.col("_ok"), F.col("_number")).otherwise(F.col("ehr_task_number")),
        "status_note": F.when(hit, F.col("_message")).otherwise(F.col("status_note")),
        "processed_date": F.when(hit, D.ts_lit(as_of)).otherwise(F.col("processed_date")),
    }
    return j.select(*[new.get(n, F.col(n)).alias(n) for n in LOG_COLUMNS])


def apply_responses(log: DataFrame, queue: DataFrame, responses: DataFrame,
                    as_of: datetime) -> tuple[DataFrame, DataFrame]:
    """J24 (B8-B12) as one keyed merge instead of a cursor.

    Every Pending queue row with a response is processed: its stale note is
    cleared, success sets ``Sent`` and the vendor task number, failure sets
    ``Failed`` and the message (quirk Q12 fixed: a missing value is NULL,
    never a previous task's), ``processed_date`` is stamped and the row
    leaves the queue. Returns ``(next_log, next_queue)``.
    """
    upd = response_updates(queue, responses)
    next_queue = queue.join(upd.select("_u_id"), F.col("taskid") == F.col("_u_id"), "left_anti")
    return answered_rows(log, upd, as_of), next_queue


def mark_completed(log: DataFrame, entries: DataFrame, how: str = "left") -> DataFrame:
    """Log rows whose vendor task is completed become ``Completed``; ``how="inner"`` gives those rows only."""
    done = (entries.where((F.col("cb_completed") == 1) & F.col("wf_task_number").isNotNull())
            .select(F.col("wf_task_number").alias("_done")).distinct())
    # Tasks without a vendor number match nothing, but would all meet in one task; their ids spread them.
    spread = F.concat(F.lit("no number "), F.xxhash64("taskid", "admission_number", "patient_number").cast("string"))
    own = F.coalesce(F.concat(F.lit("="), "ehr_task_number"), spread)
    j = log.join(done, own == F.concat(F.lit("="), "_done"), how)
    return j.select(*[(F.when(F.col("_done").isNotNull(), F.lit(K.STATUS_COMPLETED)).otherwise(F.col(n))
                       if n == "status" else F.col(n)).alias(n) for n in LOG_COLUMNS])


def write_version(df: DataFrame, root: str, version: int, mode: str = "errorifexists") -> str:
    """Persist a log/queue/snapshot version as parquet under ``root/v=N``, without a commit of its own."""
    path = f"{root}/v={version}"
    df.write.mode(mode).parquet(path)
    return path
