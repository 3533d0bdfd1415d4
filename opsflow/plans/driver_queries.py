"""Registered queries over the driver tables (``queries()`` in the entry).

Each callable ``(spark, sf_dir) -> DataFrame`` derives the care tables from
the driver tables (``world.care_tables``) and runs the real job on them. The
``as_of`` instants are fixed per query so results are reproducible; they sit
inside the driver data's time range (orders 1995-2001).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import text as T
from ..operators.pages import paged_text
from ..schemas import QUEUE_COLUMNS
from ..session import staged, state_root
from ..sources.bucketed import changed_buckets
from ..sources.delimited import REQUIRED_COLUMNS, discover, encoded
from ..sources.key_index import KeyIndex
from ..sources.records import records
from ..sources.tables import Tables
from ..sources.versioned import VersionedTable
from ..streaming.ingest_stream import start_ingest_stream
from . import compliance, ingest, jobs, reports, tasklog, triggers
from .world import RAW_SALES, care_tables

# Fixed evaluation instants (Thursday, day-15, Tuesday) inside the data range.
CARE_AS_OF = datetime(1998, 6, 18, 9, 30)
DAY15_AS_OF = datetime(1998, 7, 15, 9, 30)
TUESDAY_AS_OF = datetime(1998, 6, 16, 9, 30)


def _care(spark: SparkSession, sf_dir: str) -> Tables:
    # Spread small single-row-group inputs over the cores (never more than 256 MB of a table).
    par = spark.sparkContext.defaultParallelism
    return care_tables(Tables.from_parquet_dir(spark, sf_dir, min_partitions=par, min_bytes=4 << 20))


def q_compliance_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return compliance.compliance_check(c["admissions"], c["certifications"], c["task_entries"],
                                       c["patients"], CARE_AS_OF)


def _trigger(fn, as_of, with_log=False, with_snapshot=False, **kw):
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = _care(spark, sf_dir)
        args = [c]
        if with_log:
            args.append(c["task_log"])
        if with_snapshot:
            args.append(c["prev_county"])
        return fn(*args, as_of, **kw)
    q.__doc__ = fn.__doc__
    return q


def q_snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triggers.next_county_snapshot(_care(spark, sf_dir))


def q_over_util_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triggers.util_notes(_care(spark, sf_dir), DAY15_AS_OF, over=True)


QUEUED_BEFORE = date(1997, 1, 1)


def _queue(c: Tables) -> DataFrame:
    """Queue as of the previous run: Pending tasks due before 1997, then B7."""
    log = c["task_log"]
    prev = log.where((F.col("status") == "Pending") & (F.col("due") < F.lit(QUEUED_BEFORE))).select(*QUEUE_COLUMNS)
    return tasklog.enqueue(log, prev)


def _after_responses(c: Tables):
    return tasklog.apply_responses(c["task_log"], _queue(c), c["responses"], CARE_AS_OF)


def q_append_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    log = c["task_log"]
    new = triggers.assign_coordinator(c, log, CARE_AS_OF).unionByName(triggers.assign_nurse(c, log, CARE_AS_OF))
    return tasklog.append_tasks(log, new)


def q_enqueue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _queue(_care(spark, sf_dir))


def q_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return tasklog.build_payload(_queue(c), c["assignee_types"])


def q_apply_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_responses(_care(spark, sf_dir))[0]


def q_dequeue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _after_responses(_care(spark, sf_dir))[1]


CRASH_WAVE, WAVES = 5, 8


def q_manager_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log after a manager run that was cut off while sending and then started again (B7-B12, send once)."""
    c = _care(spark, sf_dir)
    root = f"{state_root(spark)}/manager-{uuid.uuid4().hex}"
    log, queue = VersionedTable(spark, f"{root}/log"), VersionedTable(spark, f"{root}/queue")
    log.write_next(c["task_log"])
    calls = []

    def vendor(payloads: DataFrame) -> DataFrame:
        calls.append(1)
        if len(calls) == CRASH_WAVE + 1:
            raise ConnectionError("the run ends here")
        return payloads.join(c["responses"], "taskid").select("taskid", "response")

    for _ in range(2):
        try:
            jobs.run_manager(c, log, queue, CARE_AS_OF, vendor, waves=WAVES)
        except ConnectionError:
            continue
    return log.read()


def q_mark_completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return tasklog.mark_completed(c["task_log"], c["vendor_entries"])


def q_fail_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fail_digest(_after_responses(_care(spark, sf_dir))[0], CARE_AS_OF)


PAGE_BYTES = 2000


def q_fail_digest_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failure digest in pages: every failed task's note in task order, as table rows."""
    log = _after_responses(_care(spark, sf_dir))[0].filter("upper(rtrim(status)) = 'FAILED'")
    rows = log.select("taskid", F.concat(F.lit("<tr><td>"), F.col("taskid").cast("string"), F.lit("</td><td>"),
                                         T.html_escape(F.coalesce("status_note", F.lit(""))), F.lit("</td></tr>")).alias("line"))
    return paged_text(rows, [], ["taskid"], "line", "", PAGE_BYTES)


def q_fail_reason_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fail_digest_pages(_after_responses(_care(spark, sf_dir))[0], 300)


def q_over_util_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return triggers.util_pages(_care(spark, sf_dir), DAY15_AS_OF, True, PAGE_BYTES)


def q_log_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bucketed task log after two merges: the vendor's answers, then its completions."""
    c = _care(spark, sf_dir)
    log = jobs.task_log(spark, f"{state_root(spark)}/log-{uuid.uuid4().hex}", bucket_rows=2000)
    log.replace(c["task_log"])
    jobs._merge_answers(log, _queue(c), c["responses"], c["vendor_entries"], CARE_AS_OF)
    return log.read()


def q_snapshot_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County changes told from the buckets whose digests differ."""
    c = _care(spark, sf_dir)
    snapshot = jobs.county_snapshot(spark, f"{state_root(spark)}/county-{uuid.uuid4().hex}", buckets=64)
    before = snapshot.replace(c["prev_county"])
    after = snapshot.replace(triggers.next_county_snapshot(c), accept=False)
    old = snapshot.read(before, changed_buckets(snapshot, before, after))
    return triggers.denver_status_change(c, old, CARE_AS_OF)


def q_fail_digest_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fail_digest_rows(_after_responses(_care(spark, sf_dir))[0])


def q_fail_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fail_export(_after_responses(_care(spark, sf_dir))[0])


INGEST_AS_OF = datetime(2026, 3, 2, 14, 42)
SALES_ORDER = ("source_file", "ord1", "ord2", "ord3", "ord4")
_ORD = ["ord1", "ord2", "ord3", "ord4"]


def _validated(c: Tables) -> DataFrame:
    return ingest.validate_sales(c["raw_sales"], INGEST_AS_OF)


def _parsed_once(c: Tables) -> DataFrame:
    """Parsed rows written, for queries that read them twice (as the ETL job does)."""
    return staged(_validated(c), "validated")


def _inserted(c: Tables) -> DataFrame:
    return ingest.load_sales(_validated(c), c["sales_target"], list(SALES_ORDER))


def q_validate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(_care(spark, sf_dir)).drop(*_ORD)


def q_soft_total_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The number column keeps the filter above the parse: pushed below it, every field would be parsed twice.
    v = _validated(_care(spark, sf_dir)).withColumn("_n", F.monotonically_increasing_id())
    return v.where(F.col("total_mismatch") & (F.col("_n") >= 0)).select("source_file", "sale_id", "quantity", "unit_price",
                                                   "total_amount", "expected_total")


def q_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _inserted(_care(spark, sf_dir)).select(*ingest.SALES_OUT)


def q_file_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    rows = _parsed_once(c)
    return ingest.file_stats(rows, ingest.load_sales(rows, c["sales_target"], list(SALES_ORDER)))


def q_run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.run_totals(q_file_stats(spark, sf_dir))


CSV_TEXT = {"quoteAll": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _render(rows: DataFrame, columns: dict[str, Column] | list[tuple[str, Column]], path: str) -> None:
    """Delimited text files, one per partition, each with a header line; names may repeat."""
    if isinstance(columns, dict):
        rows.select(*[v.alias(name) for name, v in columns.items()]).write.options(**CSV_TEXT, header="true").csv(path)
        return
    named = columns
    header = ",".join('"' + name + '"' for name, _ in named)
    line = F.to_csv(F.struct(*[v.alias(f"c{i}") for i, (_, v) in enumerate(named)]), CSV_TEXT)

    def with_header(batches):
        yield pa.record_batch([[header]], ["value"])
        yield from batches

    rows.select(line.alias("value")).mapInArrow(with_header, "value string").write.text(path)


FILE_ROWS = 4_000_000


def _sales_in_load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw_sales`` dealt to partitions so that files, taken by name, hold them in load order.

    The lines are dealt and sorted before their texts are made, so neither the sample of the ranges nor the shuffle makes any.
    What the order derives is a column by then: a sort makes an expression anew for both rows of every comparison.
    """
    t = Tables.from_parquet_dir(spark, sf_dir)
    base, made = t[RAW_SALES.base], {name: sql for name, sql, _ in RAW_SALES.cols}
    derived = {f"_{c}": F.expr(made[c]) for c in SALES_ORDER if made[c] not in base.columns}
    order = [f"_{c}" if f"_{c}" in derived else made[c] for c in SALES_ORDER]
    n = max(spark.sparkContext.defaultParallelism, -(-base.count() // FILE_ROWS))
    dealt = base.withColumns(derived).repartitionByRange(n, *order).sortWithinPartitions(*order)
    return care_tables(t.with_frames(**{RAW_SALES.base: dealt}))["raw_sales"]


def _fields() -> dict[str, Column]:
    return {c: F.col(c) for c in REQUIRED_COLUMNS}


def _drop_folder(spark: SparkSession) -> str:
    return f"{state_root(spark)}/drop-{uuid.uuid4().hex}"


def q_delimited_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales rows rendered as text whose quoted fields hold line ends, read back in ranges that cut through them (A2)."""
    raw, root = _care(spark, sf_dir)["raw_sales"], _drop_folder(spark)
    name = F.concat(F.lit('He said "'), "customer_name", F.lit('",\r\nthen\n'), "product")
    _render(raw, _fields() | {"customer_name": name}, f"{root}/in")
    files = discover(spark, f"{root}/in", "part-*")
    # Ranges far smaller than usual, so that records cross borders at every scale.
    rows = records(spark, files, f"{root}/records", range_bytes=64 << 10)
    return rows.filter("NOT (block = 0 AND pos = 0)").select(*[F.get("fields", F.lit(i)).alias(c) for i, c in enumerate(REQUIRED_COLUMNS)])


def q_mixed_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of three header layouts, one without a required column: their rows, and why the others fail (A3, A4)."""
    raw, root = _care(spark, sf_dir)["raw_sales"], _drop_folder(spark)
    year = F.substring("source_file", 6, 4).cast("int") % 3
    plain = _fields()
    extra = [(f" {c.upper()} ", v) for c, v in reversed(plain.items())] + [("note", F.col("ord1")), ("note", F.col("ord2"))]
    twice = [("Region", F.lit("not this one"))] + list(plain.items())
    short = [(c, v) for c, v in plain.items() if c not in ("region", "product")]
    for k, columns in enumerate((extra, twice, short)):
        _render(raw.filter(year == k), columns, f"{root}/in/{k}")
    files = discover(spark, f"{root}/in", "*/part-*")
    paths = spark.createDataFrame([(encoded(spark, p), i, "") for i, p in enumerate(files)], "source_path string, _file_rank int, source_file string")
    rows = records(spark, files, f"{root}/records")
    verdicts = ingest.file_verdicts(rows, paths)
    failed = verdicts.filter("error IS NOT NULL").select("error").distinct()
    return ingest.sales_rows(rows, verdicts).select(*REQUIRED_COLUMNS, F.lit(None).cast("string").alias("error")).unionByName(
        failed, allowMissingColumns=True)


BAD_YEAR = "sales1996.txt"


def q_file_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads of the same files under one time stamp say of them; one year's files hold bytes that are not UTF-8."""
    raw, root = _care(spark, sf_dir)["raw_sales"], _drop_folder(spark)
    _render(_sales_in_load_order(spark, sf_dir).filter(F.col("source_file") != BAD_YEAR), _fields(), f"{root}/in/a")
    latin = raw.filter(F.col("source_file") == BAD_YEAR).select(*(_fields() | {"product": F.lit("caf\u00e9")}).values())
    latin.toDF(*REQUIRED_COLUMNS).write.options(**CSV_TEXT, header="true", encoding="ISO-8859-1").csv(f"{root}/in/b")
    target = f"{root}/target"
    for _ in range(2):
        ingest.run_etl(spark, f"{root}/in", target, INGEST_AS_OF, pattern="*/part-*", do_archive=False)
    seen = ingest.RunState(spark, f"{target}-runs").manifest()
    return seen.groupBy("run", "error").agg(*[F.sum(c).alias(c) for c in ("parsed", "inserted", "skipped", "errors", "mismatches")])


def q_insert_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT IGNORE against a target that is read by its key index (B1)."""
    c, root = _care(spark, sf_dir), _drop_folder(spark)
    c["sales_target"].repartitionByRange(8, "sale_id").sortWithinPartitions("sale_id").write.parquet(f"{root}/target")
    index = KeyIndex(spark, f"{root}/target", "sale_id")
    index.refresh()
    rows = _validated(c)
    held = index.keys_that_may_match(rows.filter(ingest.is_valid()).select("sale_id"))
    return ingest.load_sales(rows, held, list(SALES_ORDER)).select(*ingest.SALES_OUT)


def q_ingest_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that the drop-folder stream loads: those of the batch job (J3, folder stream)."""
    c, root = _care(spark, sf_dir), _drop_folder(spark)
    done = c["sales_target"].select("sale_id", *[F.lit(None).cast(t).alias(n) for n, t in ingest.SALES_TYPES if n != "sale_id"])
    done.write.parquet(f"{root}/target")
    _render(_sales_in_load_order(spark, sf_dir), _fields(), f"{root}/in")
    q = start_ingest_stream(spark, f"{root}/in", f"{root}/target", f"{root}/checkpoint", pattern="part-*",
                            max_files_per_trigger=2**31 - 1, clock=lambda: INGEST_AS_OF)
    q.awaitTermination()
    return spark.read.parquet(f"{root}/target").filter("processing_date IS NOT NULL").drop("source_file")


def _check(c: Tables) -> DataFrame:
    """The check result feeding the action chain (not persisted: measured
    slower than letting each consumer re-run it, since Spark reuses the
    identical shuffle stages within one plan)."""
    return compliance.compliance_check(c["admissions"], c["certifications"], c["task_entries"], c["patients"],
                                       CARE_AS_OF, sort=False, with_code=True)


def q_cert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return compliance.cert_summary(_check(c), c["certifications"], CARE_AS_OF)


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return compliance.prepare_actions(_check(c), c["certifications"], None, CARE_AS_OF)


def q_correct_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("patient_number", "admission_number", "task_item",
                                           "certification_thru", "correctduedate")


def q_expected_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _prepared(spark, sf_dir).select("patient_number", "admission_number", "task_item", "servicetype",
                                           "task_code")


def q_latest_match_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compliance.latest_task(_care(spark, sf_dir)["task_entries"], CARE_AS_OF)


def q_fallback_due(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return compliance.fallback_due(_check(c), c["certifications"], c["task_entries"], CARE_AS_OF)


def q_task_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _care(spark, sf_dir)
    return compliance.task_actions(_check(c), c["certifications"], c["task_entries"], c["admissions"],
                                   c["employees"], c["users"], CARE_AS_OF)


def q_daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rule queries of one day (gates decide which run), unioned."""
    c = _care(spark, sf_dir)
    return triggers.run_all(c, c["task_log"], c["prev_county"], CARE_AS_OF)


def q_tz_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visit times Denver -> UTC -> Denver, 12/24-hour text."""
    v = _care(spark, sf_dir)["visits"]
    utc = D.local_to_utc(F.col("schedule_date"))
    return v.select("visit_id", "schedule_date", utc.alias("utc_time"),
                    D.utc_to_local(utc).alias("local_again"), D.hhmm_ampm(F.col("schedule_time")).alias("clock"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "compliance_check": q_compliance_check,
    "hold_note": _trigger(triggers.add_hold_note, CARE_AS_OF, with_log=True),
    "snapshot_diff": _trigger(triggers.denver_status_change, CARE_AS_OF, with_snapshot=True),
    "snapshot_replace": q_snapshot_replace,
    "lost_eligibility": _trigger(triggers.lost_eligibility, CARE_AS_OF, with_log=True),
    "over_util": _trigger(triggers.over_utilization, DAY15_AS_OF, with_log=True),
    "over_util_notes": q_over_util_notes,
    "over_util_all": _trigger(triggers.over_utilization, DAY15_AS_OF, with_log=True, limit=None),
    "under_util": _trigger(triggers.under_utilization, DAY15_AS_OF, with_log=True),
    "weekly_overtime": _trigger(triggers.weekly_overtime, CARE_AS_OF),
    "not_div_15": _trigger(triggers.not_div_by_15, DAY15_AS_OF),
    "assign_coordinator": _trigger(triggers.assign_coordinator, CARE_AS_OF, with_log=True),
    "assign_nurse": _trigger(triggers.assign_nurse, CARE_AS_OF, with_log=True),
    "over_15_visits": _trigger(triggers.over_15_min_visits, TUESDAY_AS_OF),
    "daily_or_visit_overtime": _trigger(triggers.daily_overtime, CARE_AS_OF),
    "append_tasks": q_append_tasks,
    "enqueue": q_enqueue,
    "payload": q_payload,
    "apply_responses": q_apply_responses,
    "dequeue": q_dequeue,
    "manager_replay": q_manager_replay,
    "mark_completed": q_mark_completed,
    "fail_digest": q_fail_digest,
    "fail_digest_rows": q_fail_digest_rows,
    "fail_digest_pages": q_fail_digest_pages,
    "fail_reason_pages": q_fail_reason_pages,
    "fail_export": q_fail_export,
    "over_util_pages": q_over_util_pages,
    "log_merge": q_log_merge,
    "snapshot_tree": q_snapshot_tree,
    "validate_rows": q_validate_rows,
    "soft_total_check": q_soft_total_check,
    "insert_ignore": q_insert_ignore,
    "file_stats": q_file_stats,
    "run_totals": q_run_totals,
    "delimited_records": q_delimited_records,
    "mixed_layouts": q_mixed_layouts,
    "file_commit": q_file_commit,
    "ingest_stream": q_ingest_stream,
    "insert_indexed": q_insert_indexed,
    "cert_summary": q_cert_summary,
    "correct_due": q_correct_due,
    "expected_code": q_expected_code,
    "latest_match_back": q_latest_match_back,
    "fallback_due": q_fallback_due,
    "task_actions": q_task_actions,
    "daily_run": q_daily_run,
    "tz_roundtrip": q_tz_roundtrip,
}
