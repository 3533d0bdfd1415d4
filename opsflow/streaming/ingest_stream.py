"""Drop-folder ingest as a Structured Streaming query (J3, §2.10).

The file source tracks which files are new (in the checkpoint, replacing the
move-to-archive marker); each micro-batch hands its file list to the batch
loader, which applies the same header checks, validation and INSERT IGNORE.
Only file *paths* flow through the stream: the ``binaryFile`` source skips
reading content when ``content`` is not selected. Files are taken in arrival
(modification-time) order, so "first row wins" follows arrival, where the
batch job follows file-name order. Re-running a batch after a
failure is harmless because the insert is keyed (existing sale ids are
skipped), so the sink is idempotent.

The source's script leaves a file that failed in the folder and so tries it again
on its next run; a stream's file source hands every path out once. A ``Ledger`` of what
became of each file closes the gap: every trigger also takes up the files that
failed before, as long as they are still there and have attempts left.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans import ingest
from ..sources.files import Files, literal

LEDGER_DDL = "batch string, path string, status string, reason string, at timestamp_ntz"


class Ledger:
    """What became of each file, one event per attempt: ROOT/batch=B holds a trigger's events.

    A trigger that Spark repeats after a crash writes the same folder again, so attempts are not counted twice.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def events(self) -> DataFrame:
        if not any(is_dir for _, is_dir in self.files.listing(self.root)):
            return self.spark.createDataFrame([], LEDGER_DDL)
        return self.spark.read.schema(LEDGER_DDL).parquet(literal(self.root))

    def state(self) -> DataFrame:
        """path, status (loaded or failed), attempts, reason and time of the last attempt."""
        last = F.max_by(F.struct("status", "reason", "at"), F.struct("at", "batch"))
        seen = self.events().groupBy("path").agg(last.alias("last"), F.count(F.lit(1)).alias("attempts"))
        return seen.select("path", F.col("last.status").alias("status"), "attempts", F.col("last.reason").alias("reason"), F.col("last.at").alias("at"))

    def open_files(self, max_attempts: int) -> list[str]:
        """Files that failed and may be tried again, of those still in the folder."""
        rows = self.state().filter((F.col("status") == "failed") & (F.col("attempts") < max_attempts)).select("path").collect()
        return sorted(r.path for r in rows if self.files.exists(r.path))

    def note(self, batch: str, loaded: list[str], failed: list[tuple[str, str]], at: datetime) -> None:
        rows = [(p, "loaded", None, at) for p in loaded] + [(p, "failed", why, at) for p, why in failed]
        df = self.spark.createDataFrame(rows, "path string, status string, reason string, at timestamp_ntz")
        df.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")


def file_stream(spark: SparkSession, source_dir: str, pattern: str = "sales*.txt",
                max_files_per_trigger: int = 1000) -> DataFrame:
    return (spark.readStream.format("binaryFile")
            .schema("path string, modificationTime timestamp_ltz, length bigint, content binary")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "false")
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .load(source_dir)
            .select("path"))


def start_ingest_stream(spark: SparkSession, source_dir: str, target_path: str | None, checkpoint_path: str,
                        pattern: str = "sales*.txt", archive_dir: str | None = None,
                        available_now: bool = True, max_files_per_trigger: int = 1000,
                        clock=datetime.now, sep: str = ",", target_table: str | None = None, buckets: int = 64,
                        max_attempts: int = 5, trigger: str = "1 minute") -> StreamingQuery:
    """Start the stream; ``available_now`` drains what is there and stops.

    Files that failed in earlier runs are tried first, before any new file is looked at; later, each trigger with new
    files tries the failed ones along with them, up to ``max_attempts`` in all. The ledger is ``query.ledger``, its
    folder ``checkpoint_path`` + "-ledger".
    """
    ledger = Ledger(spark, f"{checkpoint_path.rstrip('/')}-ledger")
    last: dict = {"batches": 0}

    def load(files: list[str], batch: str) -> None:
        as_of = clock().replace(microsecond=0)
        out = ingest.run_etl(spark, source_dir, target_path, as_of, archive_dir=archive_dir, pattern=pattern, sep=sep,
                             do_archive=archive_dir is not None, files=files, target_table=target_table, buckets=buckets)
        late = {p for p, why in out["failed"] if why.startswith("loaded_not_archived")}
        failed = {p: why for p, why in out["failed"] if p not in late}
        ledger.note(batch, [p for p in out["files"] if p not in failed], sorted(failed.items()), as_of)
        last.update(batches=last["batches"] + 1, out=out)

    def load_batch(batch: DataFrame, epoch_id: int) -> None:
        # One row per new file, bounded by maxFilesPerTrigger.
        new = [r.path for r in batch.collect()]
        if new:
            load(sorted({*new, *ledger.open_files(max_attempts)}), f"{epoch_id:012d}")

    if again := ledger.open_files(max_attempts):
        load(again, f"start-{clock().strftime('%Y%m%d%H%M%S%f')}")
    w = (file_stream(spark, source_dir, pattern, max_files_per_trigger).writeStream
         .foreachBatch(load_batch).option("checkpointLocation", checkpoint_path))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
    q = w.start()
    q.last_load = last  # type: ignore[attr-defined]
    q.ledger = ledger  # type: ignore[attr-defined]
    return q
