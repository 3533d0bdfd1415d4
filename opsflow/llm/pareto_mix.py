"""Mixing sources to target weights by Pareto order sampling.

Targets. Sources in code point order (null last) take the cyclic ``weights``
and share all words in that proportion; a target stops at ``max_copies`` times
its source's words, and the excess is shared again by weight until none is
above.

Expected copies. Within a source a document of size class c (by powers of two)
expects ``rate * 2**(tilt * c)`` copies, at most ``max_copies``; the rate makes
the expected words equal the target. ``tilt`` 0 treats all documents of a
source alike; a positive one prefers long documents.

Sample. Whole copies are certain. The fractional part p of the expectation is
the document's inclusion probability, and documents are ranked by
(u / (1 - u)) / (p / (1 - p)), u a hash of id, text and seed: Pareto order
sampling. Each source takes ranked documents for as long as their words fit what
its target leaves after the certain copies; a few rounds then fill the last gap
with the largest unsampled document that fits, so the total is fixed to within
the smallest remaining document.

The cut in a source's ranking is found by radix selection: the rank is a 48-bit
integer, word totals per (source, top 12 bits) find the digit holding the cut,
then the next 12 bits within it, and only the rows of that last digit (about one
in 16 million) are ordered in a window. So a hot source is never in one task.

Defined cases: null text has size 0; documents of size 0 are taken 0 times;
repeated rows are separate documents with the same rank, ordered by a row number
assigned when sizes are written; a corpus without words has targets 0. Tables of
one row per source are written first, so that Spark broadcasts them only by
their measured size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsflow.llm.common import WORD, written

CLASSES = 41  # sizes below 2**40 words
DIGIT = 12


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """source, source_size and place (0-based, code point order, null last), without a one-task window.

    The sorted table is written; a row's place is its rank in its partition plus
    the rows of earlier partitions, of which there is one number per partition.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = written(totals.orderBy(F.col("source").asc_nulls_last())
                   .withColumn("at", F.monotonically_increasing_id()), "sources")
    part = F.shiftrightunsigned("at", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return (rows.withColumn("part", part).join(F.broadcast(offsets), "part")
            .select("source", "source_size", (F.col("offset") + F.col("at") - F.shiftleft("part", 33)).alias("place")))


def mix_targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), max_copies: float = 3) -> DataFrame:
    """source, source_size and target: shares by weight, capped and reshared."""
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    table = written(ranked_sources(sizes).withColumn(
        "weight", F.element_at(cycle, (F.col("place") % len(weights) + 1).cast("int")))
        .withColumn("cap", F.col("source_size") * float(max_copies)), "weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # the level only rises, and each round caps at least one more source
        capped = F.col("weight") * level >= F.col("cap")
        row = table.agg(F.sum(F.when(capped, F.col("cap")).otherwise(0.0)).alias("held"),
                        F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open")).first()
        if not row.open:
            break
        new = (total - row.held) / row.open
        if new <= level:
            break
        level = new
    return table.select("source", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def with_source(rows: DataFrame, per_source: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the source, null equal to null."""
    right = per_source.withColumnRenamed("source", "of_source")
    return rows.join(right, F.col("source").eqNullSafe(F.col("of_source")), how).drop("of_source")


def _rates(sizes: DataFrame, targets: DataFrame, tilt: float, max_copies: float) -> DataFrame:
    """source, rate: expected words at that rate equal the target. At most CLASSES rows per source meet in a window."""
    factor = F.pow(F.lit(2.0), F.lit(float(tilt)) * F.col("cls"))
    hist = (sizes.filter("size > 0").groupBy("source", "cls").agg(F.sum("size").alias("words"))
            .withColumn("f", factor))
    # Classes reach the cap in order of their factor; with those above some class at the cap, the rest carry the remainder.
    order = Window.partitionBy("source").orderBy(F.desc("f"))
    above = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    below = F.sum(F.col("words") * F.col("f")).over(order.rowsBetween(0, Window.unboundedFollowing))
    steps = with_source(hist, targets).select("source", "f", ((F.col("target") - max_copies * above) / below).alias("rate"))
    fits = F.col("rate") * F.col("f") <= max_copies * (1 + 1e-12)
    return steps.groupBy("source").agg(F.coalesce(F.max(F.when(fits, F.col("rate"))), F.lit(math.inf)).alias("rate"))


def _cut(rows: DataFrame, budget: DataFrame, digit: Column, name: str) -> DataFrame:
    """source, the digit value in which the running words pass the source's room, and the room left there."""
    hist = rows.withColumn("digit", digit).groupBy("source", "digit").agg(F.sum("size").alias("words"))
    run = F.sum("words").over(Window.partitionBy("source").orderBy("digit"))
    passing = with_source(hist.withColumn("run", run), budget.select("source", "room")).filter("run > room")
    first = F.min_by(F.struct("digit", F.expr("room - run + words").alias("room")), F.col("digit"))
    return passing.groupBy("source").agg(first.alias("c")).select("source", F.col("c.digit").alias(name), F.col("c.room").alias("room"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), max_copies: int = 3, tilt: float = 0.25,
        seed: int = 7, fill_rounds: int = 6) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, expected, copies, taken, text hash th."""
    cls = F.floor(F.log2(F.greatest(F.col("size"), F.lit(1)))).cast("int")
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                        word_count(F.col("text")).alias("size"), F.xxhash64("text").alias("th"))
    sizes = written(sizes.withColumn("cls", F.least(cls, F.lit(CLASSES - 1)))
                    .withColumn("rid", F.monotonically_increasing_id()), "sizes")
    targets = written(mix_targets(sizes, weights, max_copies), "targets")
    plan = written(with_source(targets, _rates(sizes, targets, tilt, max_copies), "left"), "plan")
    factor = F.pow(F.lit(2.0), F.lit(float(tilt)) * F.col("cls"))
    expected = F.when(F.col("size") == 0, 0.0).otherwise(F.least(F.lit(float(max_copies)), F.col("rate") * factor))
    unit = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "th"), 11).cast("double") + 0.5) / float(1 << 53)
    q = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    rows = (with_source(sizes, plan).withColumn("expected", expected)
            .withColumn("whole", F.floor(F.col("expected") + 1e-9).cast("int"))
            .withColumn("p", F.greatest(F.col("expected") - F.col("whole"), F.lit(0.0)))
            .withColumn("u", unit)
            .withColumn("rank", F.when(F.col("p") > 1e-9, F.floor(q / (1 + q) * float((1 << 48) - 1)).cast("long"))))
    rows = written(rows.drop("cls", "p", "u", "rate"), "ranked")
    room = rows.groupBy("source").agg((F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("room"))
    top, next_digit = F.shiftright("rank", 48 - DIGIT), F.shiftright("rank", 48 - 2 * DIGIT)
    in_play = rows.filter("rank IS NOT NULL")
    first = written(_cut(in_play, room, top, "d1"), "cut1")
    part = with_source(in_play, first.drop("room")).filter(top == F.col("d1"))
    second = written(_cut(part, first, next_digit, "d2"), "cut2")
    edge = with_source(part, second).filter(next_digit == F.col("d2"))
    run = F.sum("size").over(Window.partitionBy("source").orderBy("rank", "doc_id", "th", "rid"))
    inside = edge.withColumn("run", run).filter("run <= room").select("rid", F.lit(True).alias("inside"))
    # A source without a cut has room for all that is in play.
    before = F.col("d2").isNull() | (next_digit < F.col("d2"))
    marked = (with_source(rows, second.drop("room"), "left").join(inside, "rid", "left")
              .withColumn("extra", F.when(F.col("rank").isNotNull() & (before | F.col("inside")), 1).otherwise(0))
              .drop("d2", "inside"))
    marked = _fill(written(marked, "marked"), max_copies, fill_rounds)
    copies = F.col("whole") + F.col("extra")
    return marked.select("doc_id", "source", "size", "source_size", "target", "expected", copies.alias("copies"),
                         (copies * F.col("size")).cast("long").alias("taken"), "th")


def _fill(marked: DataFrame, max_copies: int, rounds: int) -> DataFrame:
    """Give each source's remaining gap to the largest document that fits, one document a round."""
    picked: DataFrame | None = None
    taken = (F.col("whole") + F.col("extra")) * F.col("size")
    gaps = written(marked.groupBy("source").agg((F.first("target") - F.sum(taken)).alias("gap")), "gaps")
    spare = marked.filter((F.col("extra") == 0) & (F.col("size") > 0) & (F.col("whole") < max_copies))
    key = F.struct("size", F.coalesce(-F.col("rank"), F.lit(-(1 << 62))).alias("k"), "doc_id", "th", "rid")
    for _ in range(rounds):
        left = spare if picked is None else spare.join(picked, "rid", "left_anti")
        best = with_source(left, gaps).filter("size <= gap").groupBy("source").agg(F.max(key).alias("m"))
        best = written(best.select("source", F.col("m.size").alias("filled"), F.col("m.rid").alias("rid")), "fill")
        if best.isEmpty():
            break
        picked = best.select("rid") if picked is None else picked.union(best.select("rid"))
        gap = F.col("gap") - F.coalesce("filled", F.lit(0))
        gaps = written(with_source(gaps, best.drop("rid"), "left").select("source", gap.alias("gap")), "gaps")
    if picked is None:
        return marked
    return (marked.join(picked.withColumn("more", F.lit(1)), "rid", "left")
            .withColumn("extra", F.col("extra") + F.coalesce("more", F.lit(0))).drop("more"))


def mixed_rows(docs: DataFrame, **settings) -> DataFrame:
    """The mix: each row with all its columns, as often as it is taken. Rows that share id and text get equal shares, rounded."""
    taken = written(mix(docs, **settings).groupBy("doc_id", "th").agg(F.round(F.avg("copies")).cast("int").alias("copies"))
                    .filter("copies > 0").select(F.col("doc_id").alias("mix_id"), F.col("th").alias("mix_text"), F.col("copies").alias("mix_copies")), "taken")
    # The row travels in a struct, so its own columns can't clash with these.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"))
    same = F.col("id").eqNullSafe(F.col("mix_id")) & (F.col("th") == F.col("mix_text"))
    copies = rows.join(taken, same).withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
    return copies.select("row.*")
