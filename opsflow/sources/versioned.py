"""Versioned tables for mutable state (task log, queue, county snapshot).

The source updates its log in place. Here each run writes the next version
as new parquet files under ``root/v=N``. A version counts once its own commit
file is there, which is created after all data has been written; Spark's
``_SUCCESS`` marker can be switched off and plays no part. Before the data, a
``_started`` record names the version, so what a crash leaves behind is told
from data that something else put there: the first is replaced by the next
run, the second is never overwritten. All file-system calls go through
Hadoop's FileSystem API, so the same code works on HDFS/object stores and on
a local disk in tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .files import Files, literal

COMMITTED = "_committed"


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)

    def _numbers(self) -> list[int]:
        names = [n for n, is_dir in self.files.listing(self.root) if is_dir and n.startswith("v=")]
        return [int(n[2:]) for n in names if n[2:].isdigit()]

    def _started(self, version: int) -> str:
        return f"{self.root}/_started-{version}"

    def current_version(self) -> int | None:
        """The highest committed version, None before the first.

        Raises if folders with data are there but none was ever committed or started by this class (an older
        layout, or somebody else's files): taking the table for empty would lose them. ``adopt`` accepts one.
        """
        found = self._numbers()
        done = [v for v in found if self.files.exists(f"{self.path(v)}/{COMMITTED}")]
        if done:
            return max(done)
        foreign = [v for v in found if not self.files.exists(self._started(v)) and self.files.listing(self.path(v))]
        if foreign:
            raise RuntimeError(f"{self.root}: version(s) {sorted(foreign)} hold data but no commit; adopt() one or move them away")
        return None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version}"

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no version under {self.root}")
        return self.spark.read.parquet(literal(self.path(v)))

    def adopt(self, version: int) -> None:
        """Commit a version that was written by other means."""
        self.files.create(f"{self.path(version)}/{COMMITTED}")

    def write_next(self, df: DataFrame) -> int:
        """Write ``df`` as the next version and commit it; a crash anywhere leaves the earlier version current."""
        nxt = (self.current_version() or 0) + 1
        if not self.files.exists(self._started(nxt)):
            self.files.create(self._started(nxt))
        df.write.mode("overwrite").parquet(self.path(nxt))
        self.files.create(f"{self.path(nxt)}/{COMMITTED}")
        return nxt
