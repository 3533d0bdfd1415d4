"""A keyed table whose merges rewrite only the buckets they touch.

Rows lie in buckets by a function of their key (ranges of a dense number, or a
hash). A merge writes a new version of every bucket that gets, changes or loses
a row and then one commit file that names the version of each bucket:

    ROOT/ver=N/bucket=B/...      the rows of bucket B as of merge N
    ROOT/commits/N/...           bucket, ver, n_rows and digest of every bucket, and the marker ROOT/_commit-N

A crash before the marker leaves the earlier commit current. Readers pin a
commit. The commit has one row per bucket; buckets hold some ``bucket_rows`` rows, so
it stays small beside the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .files import Files, literal

COMMIT_DDL = "bucket bigint, ver bigint, n_rows bigint, digest string"
NAMED, NAMED_SHARE = 32, 4  # up to so many folders of a version, or less than one in so many, are named one by one
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def _listed_by_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed many to a task; Spark would start one task for each."""
    before = spark.conf.get(LISTING, None)
    try:
        spark.conf.set(LISTING, str(4 * spark.sparkContext.defaultParallelism))
        yield
    finally:
        spark.conf.unset(LISTING) if before is None else spark.conf.set(LISTING, before)


def number_ranges(key: str, rows: int) -> Column:
    """Buckets of a dense number: ``rows`` neighbours each. New numbers open new buckets and leave old ones alone."""
    return F.expr(f"`{key}` div {int(rows)}").cast("bigint")


def hash_buckets(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("bigint")


def digest(columns: list[str]) -> Column:
    """Order-free digest of a group's rows: their number and the sums of both halves of their hashes."""
    h = F.xxhash64(*columns)
    return F.concat_ws("-", F.count(F.lit(1)), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32)))


class BucketedTable:
    def __init__(self, spark: SparkSession, root: str, key: str, bucket: Column, schema: StructType | str):
        self.spark, self.root, self.key, self.bucket = spark, root.rstrip("/"), key, bucket
        self.schema = spark.createDataFrame([], schema).schema
        self.files = Files(spark, self.root)

    def version(self) -> int:
        """The current commit; 0 before the first."""
        names = [n for n, is_dir in self.files.listing(self.root) if not is_dir and n.startswith("_commit-")]
        return max((int(n[8:]) for n in names if n[8:].isdigit()), default=0)

    def commit(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if not v:
            return self.spark.createDataFrame([], COMMIT_DDL)
        return self.spark.read.schema(COMMIT_DDL).parquet(literal(f"{self.root}/commits/{v}"))

    def read(self, version: int | None = None, buckets: DataFrame | None = None) -> DataFrame:
        """The table as of a commit; with ``buckets`` (a column bucket), only the files of those buckets."""
        own = self.commit(version)
        if buckets is not None:
            own = own.join(buckets.select("bucket").distinct(), "bucket", "left_semi")
        # One row per bucket read.
        live: dict[int, list[int]] = {}
        for r in own.select("ver", "bucket").collect():
            live.setdefault(r.ver, []).append(r.bucket)
        frames, single = [], []
        for ver, found in sorted(live.items()):
            # A version of which much is current is listed by tasks as a whole; of others, the folders are named one by one.
            if len(found) > NAMED and NAMED_SHARE * len(found) >= len(self.files.listing(f"{self.root}/ver={ver}")):
                frames.append(self._version(ver).filter(F.col("bucket").isin(found)).drop("bucket"))
            else:
                single += [literal(f"{self.root}/ver={ver}/bucket={b}") for b in found]
        if single:
            with _listed_by_few_tasks(self.spark):
                frames.append(self.spark.read.schema(self.schema).parquet(*single))
        if not frames:
            return self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, frames)

    def _version(self, ver: int) -> DataFrame:
        """All that a merge wrote, with the column bucket."""
        schema = StructType([*self.schema.fields, StructField("bucket", LongType())])
        with _listed_by_few_tasks(self.spark):
            return self.spark.read.schema(schema).parquet(literal(f"{self.root}/ver={ver}"))

    def replace(self, rows: DataFrame, accept: bool = True) -> int:
        """The next commit: ``rows`` are the whole table; buckets that they don't fill are gone.

        With ``accept=False`` it is written and can be read by its number, but becomes current only by ``accept``.
        """
        return self._write(rows, None, accept)

    def accept(self, version: int) -> None:
        self.files.create(f"{self.root}/_commit-{version}")

    def upsert(self, rows: DataFrame) -> int:
        """The next commit: ``rows`` (one per key) replace those with their keys and add the others.

        ``rows`` is read twice, so it should be cheap or written; only the files of its buckets are read and written.
        """
        touched = rows.select(self.bucket.alias("bucket")).distinct()
        old = self.read(buckets=touched)
        new = rows.select(*self.schema.names)
        keys = rows.select(F.col(self.key).alias("_k"))
        merged = old.join(keys, F.col(self.key) == F.col("_k"), "left_anti").unionByName(new)
        return self._write(merged, self.commit().join(touched, "bucket", "left_anti"), True)

    def _write(self, rows: DataFrame, keep: DataFrame | None, accept: bool) -> int:
        v = self.version() + 1
        path = f"{self.root}/ver={v}"
        dealt = rows.select(*self.schema.names, self.bucket.alias("bucket")).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
        own = self._version(v).groupBy("bucket").agg(F.lit(v).cast("bigint").alias("ver"), F.count(F.lit(1)).alias("n_rows"), digest(self.schema.names).alias("digest"))
        (own if keep is None else own.unionByName(keep)).write.mode("overwrite").parquet(f"{self.root}/commits/{v}")
        if accept:
            self.accept(v)
        return v


def changed_buckets(table: BucketedTable, before: int, after: int) -> DataFrame:
    """Buckets whose digests differ between two commits, those of one commit only included: a column bucket."""
    old = table.commit(before).select("bucket", F.col("digest").alias("old"))
    new = table.commit(after).select("bucket", F.col("digest").alias("new"))
    return old.join(new, "bucket", "full").filter(~F.col("old").eqNullSafe(F.col("new"))).select("bucket")
