"""Winnowed fingerprints of edited texts against plain Python over all rows."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsflow.llm import winnow

K, W = 12, 12


def chosen(hashes):
    """Entries (hash, position) of a text, given its runs' 64-bit hashes in order."""
    top = [x % (1 << 64) >> 24 for x in hashes]
    out = []
    for a in range(max(1, len(top) - W + 1) if top else 0):
        part = top[a:a + W]
        p = a + max(j for j, x in enumerate(part) if x == min(part))
        out += [(top[p], p)] if (top[p], p) not in out[-1:] else []
    return out


def jaccard(a, b):
    a, b = {x for x, _ in a}, {x for x, _ in b}
    return 1.0 if not a and not b else len(a & b) / len(a | b)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(21)
    text = lambda n: "".join(rng.choice("abcdé ñ\n😀") for _ in range(n))
    out = [(i, text(rng.choice([0, 1, 5, 11, 12, 22, 23, 24, 30, 44, 45, 46, 47, 60, 90, 200]))) for i in range(150)]
    out += [(200 + i, "x" * (10 + 7 * i)) for i in range(12)] + [(300, text(3000)), (301, None), (302, "")]
    out += [(None, text(rng.randrange(60))) for _ in range(60)] + [(7, text(50)) for _ in range(40)]  # without an id; one id for many
    return out


def test_edited_fingerprints_equal_those_of_the_whole_text(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, bucket string, n long").repartition(5)
    got = Counter(tuple(r) for r in winnow.fingerprints(docs, K, W).collect())
    hashed = {}

    def hashes_of(texts):
        new = sorted({t for t in texts if t not in hashed})
        df = spark.createDataFrame([(t,) for t in new], "t string").select("t", winnow.run_hashes(F.col("t"), K).alias("h"), F.xxhash64("t").alias("th"))
        hashed.update({r.t: (r.h, r.th) for r in df.collect()})

    texts = [(i, t or "") for i, t in rows]
    hashes_of([t for _, t in texts])
    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), hashed[r[1]][1]))
    edits = []
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edits.append((i, t, nxt, t[:len(t) - half] + nxt[:half]))
    hashes_of([e for *_, e in edits])
    want = Counter()
    for i, t, nxt, e in edits:
        fp, fp_next, fp_e = (chosen(hashed[x][0]) for x in (t, nxt, e))
        shown = lambda x: ",".join(f"{h:x}@{p}" for h, p in x)
        want[(i, len(t), hashlib.sha256(e.encode()).hexdigest(), shown(fp), shown(fp_e), jaccard(fp, fp_e), jaccard(fp, fp_next))] += 1
    assert got == want


def test_rows_without_an_id_spread(spark):
    docs = spark.range(4000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    dealt, _ = winnow.with_next_text(docs.repartition(4))
    sizes = [r["count"] for r in dealt.groupBy("bucket").count().collect()]
    assert sum(sizes) == 4000 + len(sizes) and max(sizes) < 4 * 4000 / len(sizes)
