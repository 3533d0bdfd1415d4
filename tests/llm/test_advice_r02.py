
import random

import numpy as np

import corpus_pipeline
from opsflow.llm import near_dedup, winnow


def words(rng, n):
    return ["".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n)]


def test_pipeline_drops_near_copies_of_similarity_80(spark):
    rng = random.Random(8)
    rows = []
    for i in range(30):  # 200 shingles; each changed word takes five: 180 / 220 and 175 / 225
        base = words(rng, 204)
        for j, changed in enumerate(([], [20, 60, 100, 140], [21, 61, 101, 141, 181])):
            copy = list(base)
            for at in changed:
                copy[at] = "changed"
            rows.append((3 * i + j, " ".join(copy)))
    docs = spark.createDataFrame([r for r in rows if r[0] % 3 < 2], "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()} == {3 * i for i in range(30)}
    docs = spark.createDataFrame([r for r in rows if r[0] % 3 != 1], "doc_id long, text string")
    assert corpus_pipeline.near_dedup_stage(spark, docs, "").count() == 60


def test_chunks_follow_the_similarity():
    assert (near_dedup.chunks_for(85), near_dedup.chunks_for(80)) == (12, 16)
    assert near_dedup.miss(80, 16) < 1e-7
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (200, near_dedup.SLOTS)).astype(np.uint16)
    b = a.copy()
    for row in b:
        row[rng.choice(near_dedup.SLOTS, 31, replace=False)] ^= 1
    assert (near_dedup.signature_keys(a, 16) == near_dedup.signature_keys(b, 16)).any(axis=1).all()


def test_short_and_unspaced_texts_share_entries_with_their_edits(spark):
    rng = random.Random(3)
    texts = [" ".join(words(rng, n)) for n in (7, 9, 12, 20)] + ["".join(words(rng, n)) for n in (7, 60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    got = winnow.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and all(r.near_edited > 0 for r in got)
