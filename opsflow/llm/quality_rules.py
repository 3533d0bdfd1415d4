r"""Quality rules whose cutoffs carry a bound on false rejection, in DataFrame functions only.

Signals of a text (null: no words) are whole numbers, so that every engine
compares them alike. Each rule turns two of them into a share in thousandths and
rejects a text above a cutoff; its cutoffs are listed from lenient to strict:

* ``symbols``: symbol characters per word;
* ``dup_lines``: lines equal to an earlier one, of the lines that have a word;
* ``repeats``: words inside repeated three-word windows, per word;
* ``long_words``: code points per word.

A text also fails by the base rules: fewer than ``min_words`` words, or more than
half of its words in repeated windows.

Which cutoff of a rule is used is decided for each stratum by labelled rows. The
labelled good texts of the stratum that pass the base rules are its holdout: the
cutoffs are fixed before any label is read, so every label is one. For a cutoff
that rejects k of n of them, P(Bin(n, risk) <= k) is the exact p-value of "this
cutoff falsely rejects more than ``risk`` of the stratum's good texts". Each rule may spend
``max_false_rejection / rules``, so the rules together stay below
``max_false_rejection`` (union bound). Errors over many tests are held at
``delta`` in all: cutoffs of a rule are tested from lenient to strict and the
first that is not certified ends the sequence (fixed-sequence testing needs no
further correction), and strata times rules share ``delta`` evenly (Bonferroni).
With probability 1 - delta no stratum loses more than ``max_false_rejection`` of its
good texts. A rule with no certified cutoff rejects nothing in that stratum; so
does every rule where a stratum has too few labelled texts.

A repeated window is told by the 64-bit hash of its three words. Texts whose
hashes are all distinct (most) have no repeated window and end there; only the
others sort their windows. Hashes of one text alone are compared, so two different
windows meet with a probability of about n^2 / 2^65 for n words.

Defined cases: null text has no words and fails the base; a null stratum is one
stratum; repeated rows are judged each; labels that contradict each other count as
good; labels without a document and documents without a label are fine; an empty
table gives no rows, empty labels certify nothing; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.common import WS, join_stats, let, written

# Rule: (counted, per, cutoffs in thousandths from lenient to strict).
RULES = {
    "symbols": ("n_symbols", "n_words", (2000, 1500, 1000, 700, 500, 400, 300, 200, 100)),
    "dup_lines": ("n_dup_lines", "n_lines", (900, 800, 700, 600, 500, 400, 300)),
    "repeats": ("n_repeat_words", "n_words", (450, 400, 350, 300, 250)),
    "long_words": ("word_chars", "n_words", (12000, 10000, 9000, 8000, 7500, 7000)),
}
SYMBOLS = r"[#*$%&|<>]"
BLANKS = " \t\n\x0b\x0c\r"


def repeat_words(grams: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more; ``grams`` are the hashes in text order."""
    def at_sorted(s: Column) -> Column:
        twin = F.filter(s, lambda x, i: (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]))
        return let(F.sort_array(F.transform(twin, lambda x: x["i"])), covered)

    def covered(at: Column) -> Column:
        # Each window adds the words up to the next window's start, three at most.
        steps = F.transform(at, lambda p, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - p, F.lit(3))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), at_sorted)


def signals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, stratum and the counts that the rules compare."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(stratum_col).cast("string")), F.lit("null")).alias("stratum"), text.alias("text"))
    rows = rows.select(
        "doc_id", "stratum", F.filter(F.split("text", WS), lambda w: w != "").alias("words"),
        F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("text", WS, "")).cast("long").alias("word_chars"))
    gram = lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    n = F.size("words")
    rows = rows.select(
        "doc_id", "stratum", n.cast("long").alias("n_words"), "word_chars", "n_symbols", F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), gram)).otherwise(F.array().cast("array<bigint>")).alias("grams"))
    repeated = F.size(F.array_distinct("grams")) < F.size("grams")
    return rows.withColumn("n_repeat_words", F.when(repeated, repeat_words(F.col("grams"))).otherwise(F.lit(0).cast("long"))).drop("grams")


def exceeds(rule: str, cutoff: Column) -> Column:
    """Whether the rule's share lies above a cutoff in thousandths; never with nothing to count per."""
    counted, per, _ = RULES[rule]
    return F.col(counted) * 1000 > cutoff * F.col(per)


def with_base(rows: DataFrame, min_words: int) -> DataFrame:
    return rows.withColumn("base_failed", (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50))


def binomial_p(n: Column, k: Column, risk: float) -> Column:
    """P(Bin(n, risk) <= k), summed exactly in logarithms; 1.0 where k is the mean or more, which certifies nothing."""
    up, odds = math.log1p(-risk), math.log(risk / (1 - risk))
    # log C(n, i) risk^i (1 - risk)^(n - i), from i = 0 upward, with the sum kept relative to (1 - risk)^n by its logarithm.
    start = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("total"))

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        return F.struct(term.alias("term"), (F.greatest(acc["total"], term) + F.log1p(F.exp(-F.abs(acc["total"] - term)))).alias("total"))

    total = F.aggregate(F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")), start, add,
                        lambda acc: F.exp(acc["total"] + n * up))
    return F.when(k >= n * risk, 1.0).otherwise(total)


def certified_cutoffs(rows: DataFrame, labels: DataFrame, max_false_rejection: float, delta: float) -> DataFrame:
    """One row per stratum of the holdout: stratum, n_good and, for each rule, its strictest certified cutoff or null."""
    good = labels.groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("quality")).filter("quality = 1")
    held = rows.filter(~F.col("base_failed")).join(good, F.col("doc_id") == F.col("label_id"), "left_semi")
    counts = [F.array(*[F.count_if(exceeds(r, F.lit(c))) for c in RULES[r][2]]).alias(r) for r in RULES]
    # A row per stratum, counted before the shuffle.
    strata = written(held.groupBy("stratum").agg(F.count("*").alias("n_good"), *counts), "holdout")
    tests = max(1, strata.count()) * len(RULES)
    risk = max_false_rejection / len(RULES)

    def strictest(rule: str) -> Column:
        fails = F.transform(F.col(rule), lambda k: binomial_p(F.col("n_good"), k, risk) > delta / tests)
        # Cutoffs before the first failure hold; get() of -1 is null.
        last = let(F.array_position(fails, True), lambda p: F.when(p == 0, len(RULES[rule][2]) - 1).otherwise(p - 2))
        return F.get(F.array(*[F.lit(c) for c in RULES[rule][2]]), last.cast("int"))

    return strata.select("stratum", "n_good", *[strictest(r).alias(f"cut_{r}") for r in RULES])


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
          min_words: int = 50, max_false_rejection: float = 0.02, delta: float = 0.05) -> DataFrame:
    """One row per input row: doc_id, stratum, the counts, base_failed, failed (names of the rules that reject it) and kept."""
    rows = written(with_base(signals(docs, id_col, text_col, stratum_col), min_words), "signals")
    cuts = certified_cutoffs(rows, labels, max_false_rejection, delta)
    per = rows.groupBy(F.col("stratum").alias("s")).agg(F.count("*").alias("n_stratum"))
    sized = per.join(cuts, F.col("stratum") == F.col("s"), "left").drop("stratum").withColumnRenamed("s", "stratum")
    judged = join_stats(rows, written(sized, "cutoffs"), "stratum", "n_stratum", rows.count())
    fired = F.array_compact(F.array(*[F.when(exceeds(r, F.col(f"cut_{r}")), F.lit(r)) for r in RULES]))
    return judged.withColumn("failed", fired).withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0))
