"""SparkSession construction and lineage helpers.

Every job in this package is a pure function of DataFrames and an explicit
``as_of`` instant, so the session only has to pin the semantics the jobs rely
on (UTC session zone, TIMESTAMP_NTZ literals) and turn on AQE so shuffle sizes,
broadcast choices and skewed join partitions are re-planned at runtime.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job depends on for *correct* results (not only speed).
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale: AQE re-plans joins/partition counts from runtime stats,
# splits skewed shuffle partitions, and keeps broadcast decisions size-checked.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Planner/AQE only broadcast a side whose measured size is below this.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
}

# Runtime SQL settings that are safe to set on any live session. Wide row
# projections (file validation, task notes) fuse into one generated method;
# above the JVM's 8000-byte JIT limit that method would run interpreted, so
# such stages fall back to per-expression codegen instead (2x faster here).
TUNING_CONF = {
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, app: str = "opsflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**SEMANTIC_CONF, **SCALE_CONF, **TUNING_CONF, **(extra or {})}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Pin the session settings the jobs' results depend on (+ safe tuning)."""
    for k, v in {**SEMANTIC_CONF, **TUNING_CONF}.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared lineage-cut folder: the cluster's ``spark.checkpoint.dir``.

    Only when the session names none (tests, local runs) do we set
    ``fallback``; a cluster deployment must configure a shared path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback given")
    os.makedirs(fallback, exist_ok=True) if "://" not in fallback else None
    spark.conf.set("spark.checkpoint.dir", fallback)
    spark.sparkContext.setCheckpointDir(fallback)
    return fallback


def state_root(spark: SparkSession) -> str:
    """Folder for state that a job keeps between its steps: below the session's ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder; a cluster session must name a shared one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/opsflow-state"
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the whole cluster shares")
    return tempfile.mkdtemp(prefix="opsflow-state-")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below ``state_root`` and read back, so that what reads it twice sees the same rows.

    The folder is the caller's session's to remove; it holds no state that a later run needs.
    """
    path = f"{state_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def has_checkpoint_dir(spark: SparkSession) -> bool:
    return bool(spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder.

    Survives executor loss (unlike ``localCheckpoint``, never used here);
    used where a plan is re-read several times, e.g. a task-log version
    feeding many triggers. The folder is the session's
    ``spark.checkpoint.dir``; without one this fails loudly instead of
    falling back to a machine-local path.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("cut_lineage needs spark.checkpoint.dir (a folder shared by the cluster)")
        sc.setCheckpointDir(configured)
    return df.checkpoint(eager=True)


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 128 << 20, minimum: int = 200) -> int:
    """Initial shuffle partition count for a given shuffle volume.

    AQE coalesces small partitions but never splits a large non-skewed one,
    so size the initial count from the expected shuffle bytes (e.g. ~800k
    for 100 TB at 128 MB) and let coalescing trim it at run time.
    """
    return max(minimum, -(-shuffle_bytes // target_bytes))
