"""Bloom filters built by tasks, for tables of 64-bit hashes.

``repeat_filter`` answers "may this hash occur twice?", ``member_filter``
answers "may this hash occur at all?". Both say yes to every true case; a
false yes only costs work. A filter never exceeds ``max_bytes``: it is the only
thing here that reaches the driver and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 3
SEGMENT = 1 << 16  # bytes of a filter that one merge group handles


def filter_bytes(rows: int, bits_per_row: int, max_bytes: int) -> int:
    """Power of two that gives ``bits_per_row``, within [1 segment, max_bytes]."""
    need = max(SEGMENT, rows * bits_per_row // 8)
    return min(1 << (need - 1).bit_length(), 1 << (max_bytes.bit_length() - 1))


def positions(hashes: np.ndarray, n_bytes: int) -> np.ndarray:
    """(rows, PROBES) bit positions of 64-bit hashes, by double hashing."""
    h = hashes.astype(np.uint64)
    step = ((h >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return ((h[:, None] + step[:, None] * probes) >> np.uint64(7)) % np.uint64(n_bytes * 8)


def _set(bits: np.ndarray, pos: np.ndarray) -> None:
    np.bitwise_or.at(bits, pos >> np.uint64(3), np.left_shift(1, pos & np.uint64(7)).astype(np.uint8))


def _get(bits: np.ndarray, pos: np.ndarray) -> np.ndarray:
    return (bits[pos >> np.uint64(3)] >> (pos & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _build(hashes: DataFrame, n_bytes: int, max_tasks: int = 64) -> np.ndarray:
    """Bits hit at least twice (first half) and at least once (second half)."""
    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(n_bytes, np.uint8), np.zeros(n_bytes, np.uint8)
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            pos, count = np.unique(positions(h, n_bytes), return_counts=True)
            _set(twice, pos[(count > 1) | _get(once, pos)])
            _set(once, pos)
        for k in range(0, n_bytes, SEGMENT):
            if once[k:k + SEGMENT].any():
                yield pa.RecordBatch.from_pydict({
                    "segment": pa.array([k // SEGMENT], pa.int64()),
                    "once": pa.array([once[k:k + SEGMENT].tobytes()], pa.binary()),
                    "twice": pa.array([twice[k:k + SEGMENT].tobytes()], pa.binary())})

    def merge(part: pd.DataFrame) -> pd.DataFrame:
        once, twice = np.zeros(SEGMENT, np.uint8), np.zeros(SEGMENT, np.uint8)
        for a, b in zip(part["once"], part["twice"]):
            a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
            twice |= b | (once & a)
            once |= a
        return pd.DataFrame({"segment": part["segment"][:1], "once": [once.tobytes()], "twice": [twice.tobytes()]})

    shape = "segment long, once binary, twice binary"
    parts = hashes.coalesce(max_tasks).mapInArrow(local, shape)
    out = np.zeros((2, n_bytes), np.uint8)
    for row in parts.groupBy("segment").applyInPandas(merge, shape).toLocalIterator():
        at = slice(row.segment * SEGMENT, (row.segment + 1) * SEGMENT)
        out[0, at], out[1, at] = np.frombuffer(row.twice, np.uint8), np.frombuffer(row.once, np.uint8)
    return out


def _probe(spark, bits: np.ndarray):
    n_bytes, shared = len(bits), spark.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def maybe(h: pd.Series) -> pd.Series:
        return pd.Series(_get(shared.value, positions(h.to_numpy(np.int64).view(np.uint64), n_bytes)).all(axis=1))

    return maybe


def repeat_filter(hashes: DataFrame, rows: int, bits_per_row: int = 16, max_bytes: int = 64 << 20):
    """Column function, true for each hash that occurs twice in ``hashes`` (one long column)."""
    return _probe(hashes.sparkSession, _build(hashes, filter_bytes(rows, bits_per_row, max_bytes))[0])


def member_filter(hashes: DataFrame, rows: int, bits_per_row: int = 16, max_bytes: int = 64 << 20):
    """Column function, true for each hash that occurs in ``hashes`` (one long column)."""
    return _probe(hashes.sparkSession, _build(hashes, filter_bytes(rows, bits_per_row, max_bytes))[1])


def text_hash(digest: Column) -> Column:
    return F.xxhash64(digest)
