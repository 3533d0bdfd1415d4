"""Sales flat-file ETL (J1-J3, B1-B4, E12) as Spark jobs.

``validate_sales`` turns text rows into typed rows plus a rejection reason
and a soft total check -- all column expressions, no UDF. ``load_sales``
applies INSERT IGNORE semantics (first row per key wins, existing keys are
skipped) and ``file_stats`` reports parsed/inserted/skipped/bad per file.
``run_etl`` wires discovery, reading in ranges, header checks by tasks, file-level
failure, the commit by manifest and the archive step.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import parse as P
from ..functions import text as T
from ..operators import core as O
from ..sources import delimited as S
from ..sources.files import Files, literal
from ..sources.key_index import KeyIndex
from ..sources.records import records

TEXT_FIELDS = ["sale_id", "customer_name", "product", "region", "salesperson"]


def validate_sales(raw: DataFrame, processing_date: datetime) -> DataFrame:
    """Typed sales rows, ``reason`` (NULL when valid) and ``total_mismatch``.

    Checks run in the source's order -- quantity, unit price, total amount,
    sale date -- and the first failure is the row's reason. A total that
    differs from ``quantity * unit_price`` rounded half-even to cents only
    warns (``total_mismatch``); the row is still loaded.

    Three projections: strip once, parse once, then derive reason/checks.
    Catalyst keeps them apart (it does not inline a non-trivial expression
    that is referenced several times), so no field is stripped twice.
    """
    keep = [c for c in raw.columns if c not in S.REQUIRED_COLUMNS]
    stripped = T.strip_columns(raw, S.REQUIRED_COLUMNS)
    typed = stripped.select(
        "*",
        P.parse_int_stripped(F.col("quantity")).alias("_q"),
        P.parse_decimal_stripped(F.col("unit_price")).alias("_up"),
        P.parse_decimal_stripped(F.col("total_amount")).alias("_ta"),
        P.parse_date_stripped(F.col("sale_date")).alias("_sd"))
    q, up, ta, sd = F.col("_q"), F.col("_up"), F.col("_ta"), F.col("_sd")

    def bad(field: str, kind: str) -> Column:
        return F.concat(F.lit(f"Invalid {kind} for '{field}': '"), F.coalesce(F.col(field), F.lit("")), F.lit("'"))

    reason = (F.when(q.isNull(), bad("quantity", "integer"))
               .when(up.isNull(), bad("unit_price", "decimal"))
               .when(ta.isNull(), bad("total_amount", "decimal"))
               .when(sd.isNull(), F.concat(F.lit("Unrecognised date format for 'sale_date': '"),
                                           F.coalesce(F.col("sale_date"), F.lit("")), F.lit("'"))))
    # No cast or product here can throw on a row's values; a product beyond 38 digits is a mismatch.
    expected = P.round_half_even(F.try_multiply(q.cast("decimal(20,0)"), up), 2)
    # Validity on the parsed values only: a filter on it that Catalyst pushes
    # below these projections stays cheap (no message text is built).
    valid = q.isNotNull() & up.isNotNull() & ta.isNotNull() & sd.isNotNull()
    txt = {c: F.coalesce(F.col(c), F.lit("")).alias(c) for c in TEXT_FIELDS}  # '' for empty, like csv
    return typed.select(
        *keep, txt["sale_id"], txt["customer_name"], txt["product"], q.alias("quantity"),
        up.cast("double").alias("unit_price"), ta.cast("double").alias("total_amount"), sd.alias("sale_date"),
        txt["region"], txt["salesperson"], D.ts_lit(processing_date).alias("processing_date"),
        reason.alias("reason"),
        (valid & F.coalesce(ta != expected, F.lit(True))).alias("total_mismatch"),
        expected.cast("double").alias("expected_total"))


def is_valid() -> Column:
    """Row passed validation; equivalent to ``reason IS NULL``."""
    return (F.col("quantity").isNotNull() & F.col("unit_price").isNotNull() & F.col("total_amount").isNotNull()
            & F.col("sale_date").isNotNull())


SALES_TYPES = [("sale_id", "string"), ("customer_name", "string"), ("product", "string"), ("quantity", "bigint"), ("unit_price", "double"),
               ("total_amount", "double"), ("sale_date", "date"), ("region", "string"), ("salesperson", "string"),
               ("processing_date", "timestamp_ntz"), ("source_file", "string")]
SALES_OUT = [n for n, _ in SALES_TYPES]


def load_sales(validated: DataFrame, target_keys: DataFrame, order: list[str]) -> DataFrame:
    """Rows an INSERT IGNORE keyed on ``sale_id`` would insert.

    ``order`` names the columns (ascending) giving the load order of rows.
    """
    return O.insert_ignore(target_keys, validated, "sale_id", order, eligible=is_valid())


def file_stats(validated: DataFrame, inserted: DataFrame) -> DataFrame:
    """B2: parsed / inserted / skipped / bad rows / mismatches per source file."""
    per = validated.groupBy("source_file").agg(
        F.sum(is_valid().cast("int")).cast("bigint").alias("parsed"),
        F.sum((~is_valid()).cast("int")).cast("bigint").alias("errors"),
        F.sum(F.col("total_mismatch").cast("int")).cast("bigint").alias("mismatches"))
    ins = inserted.groupBy(F.col("source_file").alias("_i_file")).agg(
        F.count(F.lit(1)).cast("bigint").alias("inserted"))
    j = per.join(ins, per.source_file == ins._i_file, "left").drop("_i_file")
    j = j.withColumn("inserted", F.coalesce(F.col("inserted"), F.lit(0).cast("bigint")))
    return j.select("source_file", "parsed", "inserted", (F.col("parsed") - F.col("inserted")).alias("skipped"),
                    "errors", "mismatches")


def run_totals(stats: DataFrame) -> DataFrame:
    """Totals over the loaded files (failed files are not in ``stats``)."""
    return stats.agg(F.count(F.lit(1)).cast("bigint").alias("files"),
                     *[F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c)
                       for c in ["parsed", "inserted", "skipped", "errors", "mismatches"]])


def _target(spark: SparkSession, target_path: str | None, target_table: str | None) -> DataFrame | None:
    """The target, or None before the first run; an existing target that cannot be read raises."""
    if target_table:
        return spark.table(target_table) if spark.catalog.tableExists(target_table) else None
    return spark.read.parquet(literal(target_path)) if S.exists(spark, target_path) else None


def _append(df: DataFrame, target_path: str | None, target_table: str | None, buckets: int) -> None:
    if target_table:
        # Catalog table bucketed by the key: later runs' anti-join reads it
        # already hash-partitioned on sale_id, so only the batch is shuffled.
        df.write.mode("append").format("parquet").bucketBy(buckets, "sale_id").saveAsTable(target_table)
    else:
        df.write.mode("append").parquet(target_path)


class RunState:
    """What the runs of one target keep beside it, one folder per run.

        run=R/records, run=R/validated   rows as read, rows as parsed
        run=R/insert                     the rows that the run adds, files that fail left out
        run=R/manifest, run=R/_manifest  one row per file (see ``MANIFEST_DDL``); the marker is the run's commit
        run=R/_published                 the target holds the run's rows

    Before the commit the target is untouched and the run counts for nothing. After it the run will be in the target:
    a crash while publishing is made good by the next run, which adds what is missing by key. Once published, only the
    manifest and the verdicts stay.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def runs(self) -> list[int]:
        return sorted(int(n[4:]) for n, is_dir in self.files.listing(self.root) if is_dir and n.startswith("run=") and n[4:].isdigit())

    def path(self, run: int, name: str) -> str:
        return f"{self.root}/run={run}/{name}"

    def has(self, run: int, marker: str) -> bool:
        return self.files.exists(self.path(run, marker))

    def write(self, df: DataFrame, run: int, name: str) -> DataFrame:
        df.write.parquet(self.path(run, name))
        return self.read(run, name, df.schema)

    def read(self, run: int, name: str, schema=None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(literal(self.path(run, name)))

    def unpublished(self) -> list[int]:
        return [r for r in self.runs() if self.has(r, "_manifest") and not self.has(r, "_published")]

    def manifest(self) -> DataFrame:
        """Every committed run's files."""
        done = [r for r in self.runs() if self.has(r, "_manifest")]
        if not done:
            return self.spark.createDataFrame([], MANIFEST_DDL)
        return self.spark.read.schema(MANIFEST_DDL).parquet(*[literal(self.path(r, "manifest")) for r in done])


MANIFEST_DDL = ("run bigint, source_path string, source_file string, error string, parsed bigint, inserted bigint, skipped bigint, "
                "errors bigint, mismatches bigint, digest string, as_of timestamp_ntz")
STATS = ["source_file", "parsed", "inserted", "skipped", "errors", "mismatches"]


def row_digest() -> Column:
    """Order-free digest of the sales rows of a group: sums of two independent 32-bit halves of each row's hash."""
    h = F.xxhash64(*SALES_OUT)
    low, high = h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32)
    return F.concat_ws("-", F.count(F.lit(1)), F.sum(low), F.sum(high))


def file_verdicts(rows: DataFrame, paths: DataFrame, required: list[str] = S.REQUIRED_COLUMNS) -> DataFrame:
    """One row per file of ``paths`` (source_path, _file_rank, source_file) with its normalised header names and why it fails, or null.

    ``rows`` are the records of ``sources.records``; a file's header is its first one, told by the tasks that read it.
    """
    header = rows.filter("block = 0 AND pos = 0").select(
        F.col("path").alias("_h_path"), F.transform("fields", lambda x: F.lower(T.strip_ws(x))).alias("names"))
    per = rows.groupBy(F.col("path").alias("_p_path")).agg(
        F.bool_and("valid").alias("_valid"), (F.min("width") != F.max("width")).alias("_uneven"))
    j = (paths.join(header, F.col("source_path") == F.col("_h_path"), "left")
         .join(per, F.col("source_path") == F.col("_p_path"), "left"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(c) for c in required]), "names"))
    blank = F.col("names").isNull() | F.forall("names", lambda x: x == "")
    error = (F.when(blank, "file is empty or has no header row")
             .when(~F.col("_valid"), "bytes that are not UTF-8")
             .when(F.size(missing) > 0, F.concat(F.lit("missing required columns ["), F.array_join(missing, ", "), F.lit("]")))
             .when(F.col("_uneven"), "malformed row (wrong number of fields)"))
    return j.select("source_path", "_file_rank", "source_file", "names", error.alias("error"))


def sales_rows(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Data rows of the files that do not fail, the required columns picked by each file's own header.

    Of a repeated name the last column counts. A column's place is told once a file, before the join.
    """
    at = lambda c: (F.size("names") - F.array_position(F.reverse("names"), c)).cast("int")
    good = verdicts.filter("error IS NULL").select("source_path", "_file_rank", "source_file",
                                                   *[at(c).alias(f"_at_{c}") for c in S.REQUIRED_COLUMNS])
    return (rows.filter("NOT (block = 0 AND pos = 0)").join(good, F.col("path") == F.col("source_path"))
            .select(*[F.get("fields", F.col(f"_at_{c}")).alias(c) for c in S.REQUIRED_COLUMNS],
                    "source_path", "source_file", "_file_rank", F.col("block").alias("_block"), F.col("pos").alias("_row_pos")))


def manifest_rows(verdicts: DataFrame, validated: DataFrame, inserted: DataFrame, run: int, as_of: datetime) -> DataFrame:
    """B2: what a run did with each file, counted on the rows that it adds, not on the target."""
    per = validated.groupBy(F.col("_file_rank").alias("_v_rank")).agg(
        F.count_if(is_valid()).alias("parsed"), F.count_if(~is_valid()).alias("errors"), F.count_if("total_mismatch").alias("mismatches"))
    ins = inserted.groupBy(F.col("_file_rank").alias("_i_rank")).agg(F.count(F.lit(1)).alias("inserted"), row_digest().alias("digest"))
    j = (verdicts.join(per, F.col("_file_rank") == F.col("_v_rank"), "left")
         .join(ins, F.col("_file_rank") == F.col("_i_rank"), "left"))
    n = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return j.select(F.lit(run).cast("bigint").alias("run"), "source_path", "source_file", "error", n("parsed").alias("parsed"), n("inserted").alias("inserted"),
                    (n("parsed") - n("inserted")).alias("skipped"), n("errors").alias("errors"), n("mismatches").alias("mismatches"),
                    F.coalesce("digest", F.lit("0")).alias("digest"), D.ts_lit(as_of).alias("as_of"))


def publish(spark: SparkSession, state: RunState, run: int, target_path: str | None, target_table: str | None, buckets: int,
            again: bool = False) -> None:
    """Add a committed run's rows to the target. ``again``: part of them may be there already, told by key."""
    rows = state.read(run, "insert").select(*SALES_OUT)
    existing = _target(spark, target_path, target_table) if again else None
    if existing is not None:
        rows = rows.join(existing.select(F.col("sale_id").alias("_t_id")), F.col("sale_id") == F.col("_t_id"), "left_anti")
    # Sorted by key over all files, so that a key's file can be told from its range.
    _append(rows if target_table else rows.repartitionByRange("sale_id").sortWithinPartitions("sale_id"), target_path, target_table, buckets)
    state.files.create(state.path(run, "_published"))
    for stage in ("records", "validated", "insert"):
        state.files.delete(state.path(run, stage))


def run_etl(spark: SparkSession, source_dir: str, target_path: str | None, as_of: datetime,
            archive_dir: str | None = None, pattern: str = "sales*.txt", sep: str = ",",
            do_archive: bool = True, files: list[str] | None = None, multiline: bool = True,
            target_table: str | None = None, buckets: int = 64, state_path: str | None = None, key_index: bool = False) -> dict:
    """Discover -> read -> header check -> validate -> insert-ignore -> commit -> publish -> archive.

    The target is a parquet table at ``target_path`` (keys read from it), or
    a catalog table ``target_table`` bucketed by ``sale_id`` into ``buckets``. ``state_path`` holds the runs'
    state (``RunState``), by default beside the target. Files that fail (no header, missing columns, malformed
    rows, bytes that are not UTF-8) load nothing; the others load whole. Quoted fields may hold line ends
    whatever ``multiline`` says; the argument is kept for callers. With ``key_index`` (targets at a path) the target is
    written sorted by key, with a sidecar that tells which of its files a batch's keys may be in; only those are read.
    Returns ``{"stats": DataFrame, "failed": [(file, reason)], "archived": [...], "run": number, "files": all listed}``.
    """
    state = RunState(spark, state_path or (f"{target_path.rstrip('/')}-runs" if target_path else
                                           f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target_table}-runs"))
    for open_run in state.unpublished():
        publish(spark, state, open_run, target_path, target_table, buckets, again=True)
    files = discover(spark, source_dir, pattern, archive_dir) if files is None else \
        sorted(S.qualify(spark, f) for f in files)
    if not files:
        return {"stats": None, "failed": [], "archived": [], "run": None, "files": []}
    run = max(state.runs(), default=0) + 1
    by_uri = {S.encoded(spark, p): p for p in files}
    # One row per listed file; its rank is the load order for "first row wins".
    paths = spark.createDataFrame([(u, i, p.rstrip("/").rsplit("/", 1)[-1]) for i, (u, p) in enumerate(by_uri.items())],
                                  "source_path string, _file_rank int, source_file string")
    rows = records(spark, files, state.path(run, "records"), sep)
    verdicts = state.write(file_verdicts(rows, paths), run, "verdicts")
    # Rows are parsed once; everything below reads what was parsed. A row's file is known by its rank alone.
    validated = state.write(validate_sales(sales_rows(rows, verdicts).drop("source_path", "source_file"), as_of), run, "validated")
    existing = _target(spark, target_path, target_table)
    if existing is None:
        target_keys = spark.createDataFrame([], "sale_id string")
    elif key_index and target_path:
        index = KeyIndex(spark, target_path, "sale_id")
        index.refresh()
        target_keys = index.keys_that_may_match(validated.filter(is_valid()).select("sale_id"))
    else:
        target_keys = existing.select("sale_id")
    # Being parsed, rows that fail are told without cost, so only the others are ranked, with what the target takes of them.
    order = ["_file_rank", "_block", "_row_pos"]
    valid = validated.filter(is_valid()).select(*[c for c in SALES_OUT if c != "source_file"], *order)
    names = verdicts.select(F.col("_file_rank").alias("_n_rank"), "source_file")
    added = load_sales(valid, target_keys, order).join(names, F.col("_file_rank") == F.col("_n_rank")).drop("_n_rank", "_block", "_row_pos")
    inserted = state.write(added, run, "insert")
    manifest = state.write(manifest_rows(verdicts, validated, inserted, run, as_of), run, "manifest")
    state.files.create(state.path(run, "_manifest"))
    publish(spark, state, run, target_path, target_table, buckets)
    # One row per listed file.
    told = {r.source_path: r.error for r in manifest.select("source_path", "error").collect()}
    failed = [(by_uri[u], told[u]) for u in by_uri if told[u]]
    ok_paths = [p for u, p in by_uri.items() if not told[u]]
    archived = []
    if do_archive and archive_dir:
        stamp = as_of.strftime("%Y%m%d_%H%M%S")
        if ok_paths:

            def move(p: str):
                try:
                    return S.archive(spark, p, archive_dir, stamp), None
                except Exception as exc:  # rows are committed; report, do not undo (Q17)
                    return None, (p, f"loaded_not_archived: {exc}")

            with ThreadPoolExecutor(max_workers=min(32, len(ok_paths))) as pool:
                moved = list(pool.map(move, ok_paths))
            archived = [m for m, _ in moved if m]
            failed += [f for _, f in moved if f]
    return {"stats": manifest.filter("error IS NULL").select(*STATS), "failed": failed, "archived": archived, "run": run, "files": files}


def discover(spark: SparkSession, source_dir: str, pattern: str, archive_dir: str | None) -> list[str]:
    return S.discover(spark, source_dir, pattern, archive_dir)
