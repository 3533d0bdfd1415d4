"""Stages of the pipeline on rows with clashing columns, nulls and repeats; signatures of long texts."""

import random

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from opsflow.llm import near_dedup, pareto_mix

CLASH = "doc_id long, text string, lang string, source string, n_chars long, gone_id long, gone_text long, mix_id long, mix_copies int, row string, id long, th long"


def rows(n=120):
    rng = random.Random(5)
    out = []
    for i in range(n):
        text = " ".join(f"w{rng.randrange(4000)}" for _ in range(40)) if i % 10 else [None, "", "one two", " "][i // 10 % 4]
        out.append((i if i % 17 else None, text, "en", f"s{i % 3}" if i % 5 else None, 1, 2, 3, 4, 5, "x", 6, 7))
    return out + out[:5]


def test_stages_keep_the_columns_whatever_their_names(spark):
    docs = spark.createDataFrame(rows(), CLASH)
    for kept in (near_dedup.drop_near_copies(docs), pareto_mix.mixed_rows(docs)):
        assert kept.columns == docs.columns
        assert {tuple(r) for r in kept.collect()} <= {tuple(r) for r in docs.collect()}
    # Rows of one id and text are told apart by nothing and stay or go together; here all ids are their component's.
    assert near_dedup.drop_near_copies(docs).select("text").distinct().count() >= 100


def test_stages_of_an_empty_table(spark):
    docs = spark.createDataFrame([], CLASH)
    assert near_dedup.drop_near_copies(docs).count() == 0 and pareto_mix.mixed_rows(docs).count() == 0


def test_signatures_of_long_texts_stay_apart():
    rng = np.random.default_rng(7)
    factors = near_dedup.slot_factors()
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.uint64)) for n in (100, 5_000, 100_000, 100_000, 150_000, 150_000)]
    sigs = [near_dedup.signature(s, factors) for s in sets]
    apart = [int((a != b).sum()) for i, a in enumerate(sigs) for b in sigs[:i]]
    assert min(apart) >= near_dedup.SLOTS - 2
    # Equal parts still agree: sets that share 9 of 10 members.
    base = sets[3]
    other = np.unique(np.concatenate([base[: int(len(base) * 0.95)], rng.integers(0, 2**63, int(len(base) * 0.05), dtype=np.uint64)]))
    assert int((near_dedup.signature(base, factors) != near_dedup.signature(other, factors)).sum()) <= near_dedup.MAX_DISTANCE


def test_stages_set_small_batches_only_where_nothing_else_was_set(spark):
    from opsflow.llm.common import lean

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(name, "77")
    lean(spark)
    assert spark.conf.get(name) == "77"
    spark.conf.set(name, "10000")
    lean(spark)
    assert spark.conf.get(name) == "1000" and len(corpus_pipeline.STAGES) == 5
    spark.conf.set(name, "10000")
    assert spark.range(3).select(F.sum("id")).first()[0] == 3
