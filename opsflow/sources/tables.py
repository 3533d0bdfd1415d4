"""Logical table name -> DataFrame (A5).

The source addresses tables by four-part names across servers; here a job
receives a ``Tables`` mapping and never cares whether a frame comes from
parquet, the catalog or JDBC. Loaders are lazy: nothing is read until a job's
plan is executed, so Catalyst can still prune columns and push filters into
each scan.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events "
                 "documents embeddings pages benchmark labels conversations").split()


def _size_on_disk(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return int(fs.getContentSummary(p).getLength())


class Tables(Mapping):
    def __init__(self, loaders: Mapping[str, Callable[[], DataFrame]]):
        self._loaders = dict(loaders)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._loaders[name]()
        return self._cache[name]

    def __iter__(self):
        return iter(self._loaders)

    def __len__(self):
        return len(self._loaders)

    def with_frames(self, **frames: DataFrame) -> "Tables":
        loaders = dict(self._loaders)
        loaders.update({k: (lambda v=v: v) for k, v in frames.items()})
        return Tables(loaders)

    def normalized(self, keep: Mapping[str, list[str]] | None = None) -> "Tables":
        """Blank-padded ``char(n)`` semantics at the table boundary.

        The source's tables are fixed-width: trailing blanks are padding and
        never significant in comparisons or joins. Right-trimming every
        string column once, as the table is resolved, gives Spark's binary
        joins the same matches (a lazy projection; Catalyst prunes unused
        columns). ``keep`` lists columns per table whose trailing blanks
        matter (free text) and are left alone.
        """
        keep = keep or {}

        def norm(name: str, df: DataFrame) -> DataFrame:
            skip = set(keep.get(name, []))
            return df.select(*[F.rtrim(F.col(f.name)).alias(f.name)
                               if isinstance(f.dataType, StringType) and f.name not in skip else F.col(f.name)
                               for f in df.schema.fields])

        return Tables({n: (lambda n=n: norm(n, self[n])) for n in self._loaders})

    @classmethod
    def from_frames(cls, **frames: DataFrame) -> "Tables":
        return cls({k: (lambda v=v: v) for k, v in frames.items()})

    @classmethod
    def from_parquet_dir(cls, spark: SparkSession, path: str,
                         names: tuple[str, ...] | list[str] = DRIVER_TABLES,
                         min_partitions: int | None = None, min_bytes: int = 1 << 20,
                         max_bytes: int = 256 << 20) -> "Tables":
        """Parquet tables ``path/<name>.parquet``.

        ``min_partitions``: a scan can only run one task per row group, so a
        non-trivial table stored as a few large row groups would leave most
        cores idle for everything fused after the scan. Such a table (fewer
        scan partitions than ``min_partitions``, ``min_bytes`` to ``max_bytes`` on
        disk) is round-robin repartitioned once at load. Anything larger is read
        as it is: no shuffle of more than ``max_bytes`` is ever added.
        """
        def load(n: str) -> DataFrame:
            df = spark.read.parquet(f"{path}/{n}.parquet")
            if not min_partitions:
                return df
            try:  # planning-time partition count; no job runs
                parts = df.rdd.getNumPartitions()
                size = _size_on_disk(spark, f"{path}/{n}.parquet")
            except Exception:  # e.g. a Spark Connect session: read as is
                return df
            return df.repartition(min_partitions) if parts < min_partitions and min_bytes <= size <= max_bytes else df

        return cls({n: (lambda n=n: load(n)) for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, mapping: Mapping[str, str]) -> "Tables":
        return cls({k: (lambda v=v: spark.table(v)) for k, v in mapping.items()})

    @classmethod
    def from_jdbc(cls, spark: SparkSession, url: str, mapping: Mapping[str, str],
                  properties: Mapping[str, str] | None = None) -> "Tables":
        props = dict(properties or {})
        return cls({k: (lambda v=v: spark.read.jdbc(url, v, properties=props))
                    for k, v in mapping.items()})
