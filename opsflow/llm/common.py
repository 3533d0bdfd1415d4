"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of every text contract here: blank and U+0009..U+000D.
WS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_LOCAL: dict[str, str] = {}  # scratch folders of local sessions, by application


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: the session's ``spark.checkpoint.dir``.

    Only a single-process local session may go without one; a temporary folder
    is then used. A cluster session without the setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="opsflow-scratch-")
    return _LOCAL[app]


def lean(spark: SparkSession) -> None:
    """Settings for stages that move whole texts: small Arrow batches to Python, small row groups in the writers.

    Either holds one batch or row group per running task in memory. Values that the session has changed are left alone.
    """
    for name, usual, small in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("parquet.block.size", None, str(16 << 20))):
        if spark.conf.get(name, None) == usual:
            spark.conf.set(name, small)


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks that were
    running on it, and ids assigned while writing never change afterwards.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/opsflow-llm/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    out = df.write
    if partition_by:
        out = out.partitionBy(partition_by)
    out.parquet(path)
    return spark.read.schema(schema).parquet(path)


def give_back() -> None:
    """Return this process's free memory to the system: Spark keeps idle Python workers, with all they once allocated."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(task):
    """``task`` (batches -> batches), giving back its memory when it ends."""
    def run(batches):
        yield from task(batches)
        give_back()

    return run


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once per row and hand it to ``body`` as a variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def join_stats(rows: DataFrame, stats: DataFrame, key: str, size: str, n_rows: int) -> DataFrame:
    """Left join ``rows`` with one ``stats`` row per key, safe for keys that hold much of the data.

    Keys with more than 1/256 of the rows are at most 256, so their stats rows
    are broadcast; all others meet in an ordinary shuffle join.
    """
    limit = max(1000, n_rows // 256)
    heavy = stats.filter(F.col(size) > limit)
    light = stats.filter(F.col(size) <= limit)
    marked = rows.join(F.broadcast(heavy.select(key, F.lit(True).alias("__heavy"))), key, "left")
    hot = marked.filter("__heavy").drop("__heavy").join(F.broadcast(heavy), key)
    cold = marked.filter("__heavy IS NULL").drop("__heavy").join(light, key, "left")
    return hot.unionByName(cold)


def components(edges: DataFrame) -> DataFrame:
    """Connected components: one row (node, comp) per node of ``edges`` (a, b), comp the least node reached.

    Least-label propagation with pointer jumping. Each round the edges are drawn between the labels of their ends, equal
    ones once and loops not at all, so few are left after the first rounds; every round's tables are written to the shared folder.
    """
    both = written(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "edges")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("comp")), "labels")
    while True:
        far = both.join(labels, both.b == labels.node).select("a", F.col("comp").alias("cb"))
        both = written(far.join(labels, far.a == labels.node).filter("comp <> cb")
                       .select(F.col("comp").alias("a"), F.col("cb").alias("b")).distinct(), "edges")
        near = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
        step = (labels.join(near, labels.node == near.n, "left")
                .select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("mid")))
        hop = labels.select(F.col("node").alias("mid"), F.col("comp").alias("far"))
        new = written(step.join(hop, "mid").select("node", "old", F.least("mid", "far").alias("comp")), "labels")
        labels = new.select("node", "comp")
        if new.filter("old <> comp").isEmpty():
            return labels
