"""Substring dedup by content-defined chunking.

A gear hash rolls over the text's bytes, h = (h << 1) + gear[byte]; a chunk ends
where the top byte of its low 16 bits is under ``CUT``. Those bits depend on the
last 16 bytes alone, so an insertion moves the cuts after it but changes none
beyond its own neighbourhood, and chunks average 20 bytes. No least or greatest
chunk size is imposed, as either would make a cut depend on earlier cuts.

Chunks of 20 bytes are too short to be telling. The unit of dedup is therefore
two successive chunks, digested together (64-bit xxh3); every chunk but the
first and last is in two units. A unit is repeated if it occurs in at least two
documents. Overlapping repeated units of a document form runs, and runs of at
least ``min_words`` words are reported. A passage of 50 words holds about 15
cuts, so nearly always some 40 of its words are covered; random agreement over
16 words is far rarer.

Only digests are shuffled. Counting is combined on the map side; a Bloom filter
of the repeated digests then keeps all other units from being shuffled at all;
digests that hold much of the data are joined by broadcast (at most 256 of them).

Defined cases: null and empty texts have no chunks; a document is identified by
its id and its text, so repeated rows count as one document and give one set of
spans; a text's tail after its last cut is a chunk too; an empty table gives no
rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.bloom import member_filter
from opsflow.llm.common import join_stats, written

CUT = 13  # of 256


def gear_table() -> np.ndarray:
    return np.random.default_rng(256).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear_hashes(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """The rolling hash at every byte, modulo 2**16, by doubling the window four times."""
    h = gear[data]
    for shift in (1, 2, 4, 8):
        if len(h) > shift:
            h[shift:] = h[shift:] + (h[:-shift] << np.uint16(shift))
    return h


def cuts(data: bytes, gear: np.ndarray) -> np.ndarray:
    """Chunk boundaries, from 0 to the length."""
    if not data:
        return np.zeros(1, np.int64)
    h = gear_hashes(np.frombuffer(data, np.uint8), gear)
    ends = np.nonzero(h >> np.uint16(8) < CUT)[0] + 1
    return np.unique(np.concatenate([[0], ends, [len(data)]]))


def units(data: bytes, at: np.ndarray) -> list[int]:
    """Digest (signed 64-bit) of each two successive chunks; of the whole text if it is one chunk."""
    import xxhash

    view, edges = memoryview(data), at.tolist()
    ends = edges[2:] or edges[1:]
    return [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(edges, ends)]


def words_before(data: bytes, at: np.ndarray) -> np.ndarray:
    """Words (runs of non-blank bytes) that start before each position."""
    blank = np.isin(np.frombuffer(data, np.uint8), np.array([32, 9, 10, 11, 12, 13], np.uint8))
    starts = ~blank & np.concatenate([[True], blank[:-1]]) if len(blank) else blank
    return np.concatenate([[0], np.cumsum(starts)])[at]


def identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).withColumn(
        "doc", F.xxhash64("doc_id", F.xxhash64("text")))


def distinct_units(rows: DataFrame) -> DataFrame:
    """doc, doc_id, digest: once per document."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for batch in batches:
            for doc, doc_id, text in zip(batch.column("doc").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                found = np.unique(np.array(units(data, cuts(data, gear)), np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([doc] * len(found), pa.int64()), pa.array([doc_id] * len(found), pa.int64()),
                                                  pa.array(found)], ["doc", "doc_id", "digest"])

    return rows.mapInArrow(scan, "doc long, doc_id long, digest long")


def placed_units(rows: DataFrame) -> DataFrame:
    """doc, doc_id, digest, start, stop (bytes), w0, w1 (words before): every occurrence."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gear = gear_table()
        for batch in batches:
            for doc, doc_id, text in zip(batch.column("doc").to_pylist(), batch.column("doc_id").to_pylist(), batch.column("text")):
                data = text.as_py().encode("utf-8", "surrogatepass")
                at = cuts(data, gear)
                found = np.array(units(data, at), np.uint64).view(np.int64)
                n, words = len(found), words_before(data, at)
                skip = 2 if len(at) > 2 else 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * n, pa.int64()), pa.array([doc_id] * n, pa.int64()), pa.array(found),
                     pa.array(at[:n]), pa.array(at[skip:skip + n]), pa.array(words[:n]), pa.array(words[skip:skip + n])],
                    ["doc", "doc_id", "digest", "start", "stop", "w0", "w1"])

    return rows.mapInArrow(scan, "doc long, doc_id long, digest long, start long, stop long, w0 long, w1 long")


def merge_runs(part: pd.DataFrame, min_words: int) -> pd.DataFrame:
    """Runs of overlapping or touching repeated units, per document."""
    part = part.drop_duplicates(["doc", "start"]).sort_values(["doc", "start"], ignore_index=True)
    new = (part["doc"] != part["doc"].shift()) | (part["start"] > part["stop"].shift())
    part["moved"] = np.where(part["is_first"], 0, part["stop"] - np.maximum(part["start"], np.where(new, 0, part["stop"].shift().fillna(0))))
    runs = part.groupby(new.cumsum()).agg(
        doc_id=("doc_id", "first"), start=("start", "min"), stop=("stop", "max"), w0=("w0", "min"), w1=("w1", "max"),
        n_docs=("n_docs", "max"), first_doc_id=("first_doc", "min"), moved=("moved", "sum"))
    runs["n_words"] = runs["w1"] - runs["w0"]
    runs["kept"] = runs.pop("moved") == 0
    runs = runs[runs["n_words"] >= min_words]
    return runs[["doc_id", "start", "stop", "n_words", "n_docs", "first_doc_id", "kept"]]


def repeated_passages(docs: DataFrame, min_words: int = 16) -> DataFrame:
    """One row per repeated run: doc_id, start and stop (bytes of the UTF-8 text, stop exclusive), n_words, n_docs (most
    documents that share a unit of it), first_doc_id (least document that shares one), kept (all of it occurs here first)."""
    rows = identified(docs)
    counted = (distinct_units(rows).groupBy("digest").agg(F.count("*").alias("n_docs"), F.min("doc").alias("lo"), F.max("doc").alias("hi"),
                                                          F.min("doc_id").alias("first_doc")).filter("lo <> hi").drop("lo", "hi"))
    repeated = written(counted, "repeated-units")
    maybe = member_filter(repeated.select("digest"), repeated.count())
    placed = written(placed_units(rows).filter(maybe("digest")), "placed-units")
    n = placed.count()
    flagged = join_stats(placed, repeated, "digest", "n_docs", n).filter("n_docs IS NOT NULL")
    flagged = flagged.withColumn("is_first", F.col("first_doc").eqNullSafe(F.col("doc_id"))).withColumn(
        "part", F.pmod(F.xxhash64("doc"), F.lit(max(1, n // 100_000))))
    shape = "doc_id long, start long, stop long, n_words long, n_docs long, first_doc_id long, kept boolean"
    return flagged.groupBy("part").applyInPandas(lambda part: merge_runs(part, min_words), shape)
