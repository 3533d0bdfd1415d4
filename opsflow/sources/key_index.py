"""Which files of a keyed target may hold given keys (B1).

An INSERT IGNORE has to know which of a batch's keys the target holds. The target
grows for ever, a batch does not, so reading every key of the target each time
is the wrong way round. Beside the target lies a sidecar with one row per file (or
part of a file that one task read): the least and greatest key and a Bloom filter
over the keys' hashes. Files are written sorted by key, so a batch's
key falls into few files' ranges; the filter then leaves out most files that
do not hold it. Only the files left are read. A filter never misses a key, so the answer is exact.

Files are compared by name: the sidecar is brought up to date from the files that
it doesn't know yet, whoever wrote them.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files, literal

INDEX_DDL = "file string, lo string, hi string, n bigint, bits binary"
BITS_PER_KEY, PROBES = 12, 8
SALTS = 8  # each file's keys are probed by this many tasks
# Ranges known to every task (some 200 bytes each); beyond this many files they are looked up a part at a time.
RANGES_AT_ONCE = 200_000


def _places(hashes: np.ndarray, n_bits: int) -> np.ndarray:
    """PROBES bit numbers of each hash, by double hashing of its halves."""
    h = hashes.view(np.uint64)
    a, b = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    return (a[:, None] + np.arange(PROBES, dtype=np.uint64) * b[:, None]) % np.uint64(n_bits)


def filter_of(hashes: np.ndarray) -> bytes:
    n_bits = max(64, -(-len(hashes) * BITS_PER_KEY // 8) * 8)
    bits = np.zeros(n_bits // 8, np.uint8)
    at = _places(hashes, n_bits).ravel()
    np.bitwise_or.at(bits, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7)).astype(np.uint8)).astype(np.uint8))
    return bits.tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    b = np.frombuffer(bits, np.uint8)
    at = _places(hashes, len(b) * 8)
    return ((b[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)


def _summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per file that this task reads: its keys' range, number and filter."""
    state: dict = {}

    def done() -> pa.RecordBatch:
        bits = filter_of(np.concatenate(state["hashes"]))
        return pa.record_batch([[state["file"]], [state["lo"]], [state["hi"]], pa.array([state["n"]], pa.int64()), [bits]],
                               ["file", "lo", "hi", "n", "bits"])

    for b in batches:
        files, keys, hashes = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_numpy()
        starts = [i for i in range(len(files)) if i == 0 or files[i] != files[i - 1]] + [len(files)]
        for i, j in zip(starts, starts[1:]):
            if state.get("file") != files[i]:
                if state:
                    yield done()
                state = {"file": files[i], "lo": keys[i], "hi": keys[i], "n": 0, "hashes": []}
            state["lo"], state["hi"] = min(state["lo"], *keys[i:j]), max(state["hi"], *keys[i:j])
            state["n"] += j - i
            state["hashes"].append(hashes[i:j].copy())
    if state:
        yield done()


class KeyIndex:
    def __init__(self, spark: SparkSession, target: str, key: str, root: str | None = None):
        self.spark, self.target, self.key = spark, target.rstrip("/"), key
        self.root = root or f"{self.target}-keys"
        self.files = Files(spark, self.target)

    def index(self) -> DataFrame:
        if not self.files.listing(self.root):
            return self.spark.createDataFrame([], INDEX_DDL)
        return self.spark.read.schema(INDEX_DDL).parquet(literal(self.root))

    def _target_files(self) -> list[str]:
        return sorted(n for n, is_dir in self.files.listing(self.target) if not is_dir and not n.startswith(("_", ".")))

    def refresh(self) -> int:
        """Index the target's files that the sidecar does not know; their number."""
        known = {r.file for r in self.index().select("file").distinct().collect()}  # one row per file
        new = [n for n in self._target_files() if n not in known]
        if new:
            rows = self.spark.read.parquet(*[literal(f"{self.target}/{n}") for n in new]).filter(F.col(self.key).isNotNull())
            named = rows.select(F.col("_metadata.file_name").alias("file"), F.col(self.key).alias("key"), F.xxhash64(self.key).alias("h"))
            named.mapInArrow(_summarise, INDEX_DDL).write.mode("append").parquet(self.root)
        return len(new)

    def candidates(self, keys: DataFrame) -> list[str]:
        """Names of the files that may hold one of ``keys`` (a column of the key's name)."""
        batch = keys.select(F.col(self.key).alias("key")).filter(F.col("key").isNotNull()).distinct().withColumn("h", F.xxhash64("key"))
        index = self.index()
        ranges = index.select("file", "lo", "hi").orderBy("lo", "hi", "file").collect()
        found: set[str] = set()
        for at in range(0, len(ranges), RANGES_AT_ONCE):
            part = [tuple(r) for r in ranges[at:at + RANGES_AT_ONCE]]
            pairs = batch.mapInArrow(_in_ranges(part), "file string, h bigint")
            salted = pairs.withColumn("salt", F.pmod("h", F.lit(SALTS)).cast("int")).withColumn("bits", F.lit(None).cast("binary"))
            names = self.spark.createDataFrame([(f,) for f in sorted({r[0] for r in part})], "file string")
            filters = index.join(names, "file", "left_semi").select(
                "file", F.lit(0).cast("bigint").alias("h"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "bits")
            both = filters.unionByName(salted.select("file", "h", "salt", "bits"))
            # Filters come before the hashes that they are asked about; both stream through.
            hit = (both.repartition("file", "salt").sortWithinPartitions("file", "salt", F.col("bits").isNull())
                   .select("file", "salt", "h", "bits").mapInArrow(_probe, "file string"))
            found |= {r.file for r in hit.distinct().collect()}  # one row per file
        return sorted(found)

    def keys_that_may_match(self, keys: DataFrame) -> DataFrame:
        """The target's key column, from the candidate files only."""
        names = self.candidates(keys)
        if not names:
            return self.spark.createDataFrame([], f"`{self.key}` string")
        return self.spark.read.parquet(*[literal(f"{self.target}/{n}") for n in names]).select(self.key)


def _in_ranges(ranges: list[tuple[str, str, str]]):
    """(file, hash) of every key that lies in a file's range. ``ranges`` are sorted by their least key."""
    lows = [r[1] for r in ranges]
    # The greatest key seen up to each range: where it falls short, no earlier range can hold the key either.
    highs, top = [], ""
    for _, _, hi in ranges:
        top = max(top, hi)
        highs.append(top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            files, hashes = [], []
            for key, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                i = bisect_right(lows, key) - 1
                while i >= 0 and highs[i] >= key:
                    if ranges[i][2] >= key:
                        files.append(ranges[i][0])
                        hashes.append(h)
                    i -= 1
            yield pa.record_batch([pa.array(files, pa.string()), pa.array(hashes, pa.int64())], ["file", "h"])
    return run


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, filters, hit = None, [], False
    for b in batches:
        out = []
        for file, salt, h, bits in zip(*[c.to_pylist() for c in b.columns]):
            if (file, salt) != at:
                at, filters, hit = (file, salt), [], False
            if bits is not None:
                filters.append(bits)
            elif not hit and any(may_hold(x, np.array([h], np.int64))[0] for x in filters):
                hit = True
                out.append(file)
        yield pa.record_batch([pa.array(out, pa.string())], ["file"])
