"""The source's scheduled procedures as Spark jobs over versioned state.

| source procedure (daily / monthly) | job here |
| --- | --- |
| rule queries appending tasks, county snapshot replace | ``run_rules`` |
| task manager: enqueue, send, classify, update, completion sync | ``run_manager`` |
| failure summary mail | ``run_fail_summary`` |
| quarterly-visit check + corrective actions | ``run_compliance`` |
| sales file ETL | ``ingest.run_etl`` / ``streaming.start_ingest_stream`` |

Scheduling is the caller's (any job scheduler); calendar gates live in the
rules. The vendor call is a caller-supplied ``send(payloads) -> responses``
function over DataFrames -- no HTTP client or server is started here.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LOG_DDL, LOG_FIELDS, QUEUE_COLUMNS
from ..session import cut_lineage, has_checkpoint_dir, staged
from ..sources.bucketed import BucketedTable, changed_buckets, hash_buckets, number_ranges
from ..sources.tables import Tables
from ..sources.versioned import VersionedTable
from . import compliance, reports, tasklog, triggers
from .outbox import Outbox


def _empty_log(spark) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in LOG_FIELDS))


def run_rules(t: Tables, log: VersionedTable | BucketedTable, snapshot: VersionedTable | BucketedTable, as_of: datetime, **params) -> dict:
    """Daily rules: new tasks appended as the next log version; the county
    snapshot is replaced by a new version (B5, B6, B14).

    With a bucketed snapshot (``county_snapshot``) the new one is written first and only those buckets of the old one are
    read whose digest differs: patients of equal buckets have not moved. It becomes current after the tasks are
    in the log, so a crash repeats the comparison instead of losing it.
    """
    spark = log.spark
    cur_log = log.read() if _has_version(log) else _empty_log(spark)
    if isinstance(snapshot, BucketedTable):
        before = snapshot.version()
        after = snapshot.replace(triggers.next_county_snapshot(t), accept=False)
        cur_snap = snapshot.read(before, changed_buckets(snapshot, before, after))
    else:
        cur_snap = snapshot.read() if snapshot.current_version() is not None else spark.createDataFrame([], COUNTY_DDL)
    new = triggers.run_all(t, cur_log, cur_snap, as_of, **params)
    if isinstance(log, BucketedTable):
        v_log = log.upsert(staged(tasklog.to_log_rows(tasklog.assign_taskids(new, cur_log)), "new-tasks"))
    else:
        v_log = log.write_next(tasklog.append_tasks(cur_log, new))
    if isinstance(snapshot, BucketedTable):
        snapshot.accept(after)
        return {"log_version": v_log, "snapshot_version": after}
    v_snap = snapshot.write_next(triggers.next_county_snapshot(t))
    return {"log_version": v_log, "snapshot_version": v_snap}


def _has_version(table: VersionedTable | BucketedTable) -> bool:
    return bool(table.version()) if isinstance(table, BucketedTable) else table.current_version() is not None


COUNTY_DDL = "patient_number string, residency_codes string, residency_desc string, county string"


def county_snapshot(spark, root: str, buckets: int = 1024) -> BucketedTable:
    """The county snapshot in hash buckets of patients, each with a digest."""
    return BucketedTable(spark, root, "patient_number", hash_buckets("patient_number", buckets), COUNTY_DDL)


def task_log(spark, root: str, bucket_rows: int = 1_000_000) -> BucketedTable:
    """The task log in ranges of task ids; a merge rewrites only the ranges of its tasks."""
    return BucketedTable(spark, root, "taskid", number_ranges("taskid", bucket_rows), LOG_DDL)


def _merge_answers(log: BucketedTable, queue: DataFrame, responses: DataFrame, entries: DataFrame | None, as_of: datetime) -> int:
    """B8-B13 on a bucketed log: the changed rows only, read from and written to their own buckets."""
    updates = staged(tasklog.response_updates(queue, responses), "answers")
    own = log.read(buckets=updates.select(F.col("_u_id").alias(log.key)).select(log.bucket.alias("bucket")))
    version = log.upsert(staged(tasklog.answered_rows(own, updates, as_of, "inner"), "answered"))
    if entries is not None:
        version = log.upsert(staged(tasklog.mark_completed(log.read(), entries, "inner"), "completed"))
    return version


def run_manager(t: Tables, log: VersionedTable | BucketedTable, queue: VersionedTable, as_of: datetime,
                send: Callable[[DataFrame], DataFrame], entries: DataFrame | None = None,
                wave_rows: int = 100_000, waves: int | None = None, unanswered: str = "hold") -> dict:
    """Task manager (B7-B13, J23, J24): enqueue, build payloads, hand them to
    ``send`` (returns ``taskid, response``), merge the answers into the log and
    queue, then mark tasks the vendor reports completed.

    What is sent goes through an ``Outbox`` beside the log. A run that a crash cut short is finished first: its intents
    decide what it sends, and nothing whose sending began is sent again (see ``outbox`` for ``unanswered``). A task with a
    ``processed_date`` was answered and is never queued again, so a crash between the two last writes is harmless too.
    ``waves`` fixes the number of waves, else they have some ``wave_rows`` tasks each.
    """
    spark = log.spark
    box = Outbox(spark, f"{log.root}-outbox")
    cur_log = log.read()
    cur_queue = queue.read() if queue.current_version() is not None else spark.createDataFrame(
        [], cur_log.select(*QUEUE_COLUMNS).schema)
    answered = cur_log.where(F.col("processed_date").isNotNull()).select(F.col("taskid").alias("_a_id"))
    q1 = tasklog.enqueue(cur_log, cur_queue.join(answered, F.col("taskid") == F.col("_a_id"), "left_anti"))
    run = box.open_run()
    if run is None:
        payloads = tasklog.build_payload(q1, t["assignee_types"])
        run = box.begin(payloads, waves or max(1, -(-payloads.count() // wave_rows)))
    responses = box.send(run, send, unanswered)
    next_log, next_queue = tasklog.apply_responses(cur_log, q1, responses, as_of)
    if isinstance(log, BucketedTable):
        v_log = _merge_answers(log, q1, responses, entries, as_of)
    else:
        v_log = log.write_next(next_log if entries is None else tasklog.mark_completed(next_log, entries))
    versions = {"log_version": v_log, "queue_version": queue.write_next(next_queue)}
    box.applied(run)
    return versions


def run_fail_summary(log: VersionedTable, as_of: datetime, export_path: str | None = None) -> DataFrame:
    """Failure digest row (B15, B17); optional tab-separated export."""
    cur = log.read()
    if export_path:
        reports.write_fail_export(reports.fail_export(cur), export_path)
    return reports.fail_digest(cur, as_of)


def run_compliance(t: Tables, as_of: datetime) -> dict:
    """Monthly compliance: the check (J4) and the corrective actions.

    The action chain reads the check result more than once (certification
    summary and the rows; ``fallback_due`` also pivots it). It is small -- at most one row per patient
    and required item -- so when the cluster names a shared checkpoint folder
    it is materialised once there (reliable, survives executor loss) instead
    of re-running the check over the full inputs per consumer.
    """
    check = compliance.compliance_check(t["admissions"], t["certifications"], t["task_entries"], t["patients"],
                                        as_of, sort=False, with_code=True)
    if has_checkpoint_dir(check.sparkSession):
        check = cut_lineage(check)
    actions = compliance.task_actions(check, t["certifications"], t["task_entries"], t["admissions"],
                                      t["employees"], t["users"], as_of)
    return {"check": check.drop("wf_task_code").orderBy(F.col("patient_number"), F.col("start_date")), "actions": actions}
