"""Document fingerprints by winnowing, in DataFrame functions only.

Every run of ``k`` code points of the text as it is gets a hash (a text of fewer
is one run). In each window of ``w`` consecutive run hashes the smallest is
chosen, the rightmost of equal ones; the fingerprint is the chosen hashes with
the positions (code point numbers) of their runs. So two texts that share
``w + k - 1`` consecutive characters share a fingerprint entry, spaced or not, and
no shared entry comes from fewer than ``k`` characters (but for texts that are
shorter as a whole).

A document's edited text is a prefix of the document and a prefix of the next one. Their window minima
are known, so only the windows that reach across the joint are hashed and chosen anew; the rest are
slices of the two, the second's positions moved.

Runs are cut from the UTF-32 bytes, where a character's place is known without
counting from the text's start: the work grows with the length, not its square.

Each window minimum is one comparison of numbers: a run's 40 hash bits above 23
bits of its position, counted down so that the rightmost wins ties. Positions
are told modulo 2^23.

The next document is found by sorting (id, text hash) alone into ranges; the texts are
dealt to those ranges in one shuffle, and each range's first row is also sent to the
range before it. Ranges are cut by id and text hash, so many rows of one id, or
without one, still spread.

Defined cases: null is an empty text, an empty text has the empty fingerprint; the
likeness of two empty fingerprints is 1, of one empty and one not 0. Equal texts have
equal fingerprints. Null ids come last; rows that share an id follow by text hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opsflow.llm.common import let, written

POSITION_BITS = 23
POSITIONS = (1 << POSITION_BITS) - 1


def words_of(text: Column) -> Column:
    """What is fingerprinted of a text: all of it, as it is."""
    return text


def run_hashes(words: Column, k: int) -> Column:
    """A 64-bit hash for each run of ``k`` characters."""
    return runs(words, k, lambda h, i: h)


def runs(words: Column, k: int, value) -> Column:
    """``value`` of the hash and the number of each run of ``k`` characters."""
    def cut(chars: Column) -> Column:
        n = F.floor(F.octet_length(chars) / 4).cast("int")
        one = lambda at, i: value(F.xxhash64(F.substring(chars, at, F.lit(4 * k))), i)
        last = F.greatest(n - k, F.lit(0))
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), last * 4 + 1, F.lit(4)), one)).otherwise(F.array().cast("array<bigint>"))

    return let(F.encode(words, "UTF-32"), cut)


def window_minima(p: Column, w: int, span: int = 1) -> Column:
    """The least of each ``w`` consecutive numbers, given those of each ``span``, by joining up to four spans at a time."""
    width = min(w, 4 * span)
    starts = sorted({min(at, width - span) for at in range(0, width, span)})
    joined = F.transform(p, lambda x, i: F.least(x, *[F.get(p, i + at) for at in starts[1:]]))
    if width == w:
        return F.slice(joined, F.lit(1), F.size(p) - w + 1)  # whole windows only
    return let(joined, lambda q: window_minima(q, w, width))


def packed_runs(text: Column, k: int) -> Column:
    """Each run's hash and position as one number; the smaller hash is less, and of equal ones the later."""
    def packed(x: Column, i: Column) -> Column:
        hash_part = F.shiftleft(F.shiftrightunsigned(x, 64 - 40), POSITION_BITS)
        return hash_part.bitwiseOR(F.lit(POSITIONS).cast("long") - i.bitwiseAND(F.lit(POSITIONS)))

    return runs(words_of(text), k, packed)


def all_minima(text: Column, k: int, w: int) -> Column:
    """The least packed number of every whole window, in order; without a whole window, the least of all runs."""
    def least(p: Column) -> Column:
        one = F.when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(p)
        return F.when(F.size(p) > w, window_minima(p, w)).otherwise(one)

    return let(packed_runs(text, k), least)


def moved(minima: Column, by: Column) -> Column:
    """The same entries ``by`` positions later."""
    low = F.lit(POSITIONS).cast("long")
    return F.transform(minima, lambda x: x.bitwiseAND(F.bitwise_not(low)).bitwiseOR((x - by).bitwiseAND(low)))


def fingerprint(text: Column, k: int = 12, w: int = 12) -> Column:
    """Array of packed (hash, position) numbers in order of position."""
    return F.array_distinct(all_minima(text, k, w))


def hashes(fp: Column) -> Column:
    return F.transform(fp, lambda x: F.shiftrightunsigned(x, POSITION_BITS))


def shown(fp: Column) -> Column:
    """``hash@position`` entries, comma-joined."""
    return F.lower(F.array_join(F.transform(fp, lambda x: F.concat(
        F.hex(F.shiftrightunsigned(x, POSITION_BITS)), F.lit("@"),
        (F.lit(POSITIONS).cast("long") - x.bitwiseAND(F.lit(POSITIONS).cast("long"))).cast("string"))), ","))


def likenesses(a: Column, others: list[Column]) -> Column:
    """Jaccard similarities of the first fingerprint's hashes to each other one's."""
    def by(x: Column) -> Column:
        def and_by(y: Column) -> Column:
            both = F.size(F.array_intersect(x, y))
            return F.when((F.size(x) == 0) & (F.size(y) == 0), 1.0).otherwise(
                both / F.greatest(F.size(x) + F.size(y) - both, F.lit(1)))
        return F.array(*[let(F.array_distinct(hashes(b)), and_by) for b in others])
    return let(F.array_distinct(hashes(a)), by)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of the two fingerprints' hashes."""
    return likenesses(a, [b])[0]


def with_next_text(docs: DataFrame) -> tuple[DataFrame, Window]:
    """bucket, ghost, doc_id, text, next_text: the text of the next document by descending doc_id, the last one followed by the first.

    A bucket is a range of (doc_id, text hash) and a window of its own. The next document of a bucket's last row is the
    first row of the bucket after, so each bucket's first row is sent to the bucket before as well, marked as a ghost.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # Ascending in this key is descending in the id, null ids last.
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.bitwise_not(F.coalesce("doc_id", F.lit(0).cast("long"))).alias("id"),
                   F.xxhash64("text").alias("th"))
    rows = rows.withColumn("key", key)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    firsts = (rows.select("key").repartitionByRange(parts, "key").select(F.spark_partition_id().alias("part"), "key")
              .groupBy("part").agg(F.min("key").alias("key")))
    # One row: the first key of every range, ``parts`` at most.
    bounds = written(firsts.agg(F.sort_array(F.collect_list("key")).alias("firsts")), "bounds").select("firsts").scalar()
    steps = F.array(*[F.lit(1 << i) for i in range(parts.bit_length() - 1, -1, -1)])

    def place(b: Column) -> Column:
        # Binary search for the last first key that is not beyond the row's.
        found = F.aggregate(steps, F.lit(-1), lambda at, step: F.when(F.get(b, at + step) <= F.col("key"), at + step).otherwise(at))
        own = lambda at: F.struct(at.alias("bucket"), F.lit(False).alias("ghost"))
        before = lambda at: F.struct(F.when(at > 0, at - 1).otherwise(F.size(b) - 1).alias("bucket"), F.lit(True).alias("ghost"))
        return let(found, lambda at: F.when(F.get(b, at) == F.col("key"), F.array(own(at), before(at))).otherwise(F.array(own(at))))

    dealt = rows.withColumn("bounds", bounds).withColumn("place", F.explode(let(F.col("bounds"), place))).select("place.bucket", "place.ghost", "doc_id", "text", "key")
    order = Window.partitionBy("bucket").orderBy("ghost", "key")
    return dealt.withColumn("next_text", F.lead("text").over(order)), order


def fingerprints(docs: DataFrame, k: int = 12, w: int = 12) -> DataFrame:
    """Each document's fingerprint, that of its edited text, and their likeness."""
    rows, order = with_next_text(docs)
    span = k + w - 1  # characters of a window
    # Of every text the minima and, told once, which of them differ.
    told = let(all_minima(F.col("text"), k, w), lambda m: F.struct(m.alias("minima"), F.array_distinct(m).alias("fp")))
    rows = rows.withColumn("told", told)
    own = (rows.withColumn("next_told", F.lead("told").over(order)).filter(~F.col("ghost"))
           .withColumn("minima", F.col("told.minima")).withColumn("next_minima", F.col("next_told.minima"))
           .withColumn("n", F.length("text")).withColumn("half", F.floor(F.col("n") / 2).cast("int")).withColumn("cut", F.col("n") - F.col("half"))
           .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("cut")),
                                          F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), F.col("half"))))
           .withColumn("ne", F.length("edited")))
    cut, ne, none = F.col("cut"), F.col("ne"), F.array().cast("array<bigint>")
    # Windows before the joint, across it and after it.
    before = F.slice("minima", F.lit(1), F.greatest(cut - span + 1, F.lit(0)))
    at = F.greatest(cut - span + 1, F.lit(0))
    reach = F.least(ne, cut + span - 1) - at
    across = F.when(reach >= span, moved(all_minima(F.substring(F.col("edited"), at + 1, reach), k, w), at)).otherwise(none)
    # Equal entries go first, so fewer are moved.
    after = F.when(ne - cut >= span, moved(F.array_distinct(F.slice("next_minima", F.lit(1), ne - cut - span + 1)), cut)).otherwise(none)
    edited_minima = F.when(ne >= span, F.concat(before, across, after)).otherwise(all_minima(F.col("edited"), k, w))
    fps = own.select("doc_id", "n", "edited", F.col("told.fp").alias("fp"), F.col("next_told.fp").alias("next_fp"),
                     F.array_distinct(edited_minima).alias("edited_fp"))
    fps = fps.withColumn("near", likenesses(F.col("fp"), [F.col("edited_fp"), F.col("next_fp")]))
    return fps.select(
        "doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        shown(F.col("fp")).alias("fingerprint"), shown(F.col("edited_fp")).alias("edited_fingerprint"),
        F.col("near")[0].alias("near_edited"), F.col("near")[1].alias("near_next"))
