"""Exact dedup by a two-pass Bloom filter.

Pass 1 sets, in two bit arrays, which filter positions the texts' hashes hit
once and twice. A hash whose positions were all hit twice is possibly repeated;
every truly repeated hash is. Pass 2 probes: only rows with a possibly repeated
hash are shuffled and grouped by their SHA-256, all others pass straight
through as their own only copy. A false alarm of the filter costs one row's
shuffle and changes no result.

A filter is at most ``max_filter_bytes``. When the rows need more, the hashes
are cut into slices, each with a filter of its own; the table of hashes is
written by slice, so all slices together still read it once.

Texts are equal when identical after each run of white space (U+0009..U+000D,
blank) becomes one blank; null counts as empty. Of equal texts the row with the
smallest id stays (a null id counts as largest); of rows that also share that
id exactly one stays. An empty table gives no rows. Extra columns of the input
are not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.bloom import repeat_filter, text_hash
from opsflow.llm.common import WS, join_stats, written


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WS, " ")


def text_digest(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 bits_per_row: int = 16, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    hashed = (docs.select(F.col(id_col).cast("long").alias("doc_id"), text_digest(F.col(text_col)).alias("text_sha256"))
              .withColumn("h", text_hash(F.col("text_sha256")))
              .withColumn("rid", F.monotonically_increasing_id()))
    rows = written(hashed, "hashes")
    n = rows.count()
    slices = max(1, -(-n * bits_per_row // (8 * max_filter_bytes)))
    if slices > 1:
        rows = written(rows.withColumn("slice", F.pmod(F.xxhash64("h"), F.lit(slices))), "slices", "slice")
    parts = [rows.filter(F.col("slice") == k).drop("slice") for k in range(slices)] if slices > 1 else [rows]
    out = []
    for part in parts:
        maybe = repeat_filter(part.select("h"), n // slices, bits_per_row, max_filter_bytes)
        out.append(written(part.withColumn("maybe", maybe("h")), "probed", "maybe"))
    probed = reduce(DataFrame.unionByName, out)
    alone = probed.filter(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    shared = probed.filter("maybe").drop("maybe", "h")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid"))
    groups = shared.groupBy("text_sha256").agg(F.count("*").alias("group_size"), first.alias("first"))
    joined = join_stats(shared, groups, "text_sha256", "group_size", n).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("first.rid")).alias("kept"), "text_sha256")
    return alone.unionByName(joined)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                bits_per_row: int = 16, max_filter_bytes: int = 64 << 20) -> DataFrame:
    """The rows that stay, with all their columns.

    Possibly repeated rows meet in a grouped minimum over the whole row, which
    Spark combines before the shuffle; so a text held by a third of the corpus
    sends one row per task. Beyond ``max_filter_bytes`` more false alarms are
    shuffled; the result is the same.
    """
    cols = docs.columns
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"),
                        text_digest(F.col(text_col)).alias("digest"))
    keyed = keyed.withColumn("h", text_hash(F.col("digest")))
    hashes = written(keyed.select("h"), "hashes")
    maybe = repeat_filter(hashes, hashes.count(), bits_per_row, max_filter_bytes)
    probed = keyed.withColumn("maybe", maybe("h"))
    alone = probed.filter(~F.col("maybe")).select("row")
    order = F.struct(F.col(f"row.{id_col}").isNull().alias("no_id"), F.col(f"row.{id_col}").alias("id"), "row")
    kept = probed.filter("maybe").groupBy("digest").agg(F.min(order).alias("first")).select(F.col("first.row").alias("row"))
    return alone.unionByName(kept).select("row.*")
