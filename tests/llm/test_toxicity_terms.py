"""Search against plain cosines, scores against the whole method in plain Python, repeated ids, empty tables."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from opsflow.llm import toxicity


def sparse_examples(rng, n, size):
    """Counts over features from common to rare."""
    return [{f"f{int(size * rng.random() ** 3)}": rng.randrange(1, 5) for _ in range(rng.randrange(1, 40))} for _ in range(n)]


@pytest.mark.parametrize("n,k", [(700, 7), (700, 64), (70, 3), (5, 64)])
def test_search_equals_plain_cosines(n, k):
    rng = random.Random(n + k)
    size = 3000
    counts = sparse_examples(rng, n, size)
    counts[3] = dict(counts[1])  # ties
    names, idf = [f"f{i}" for i in range(size)], np.random.default_rng(1).random(size) * 4 + 0.3
    index = toxicity.build_index([(i, c, i % 2) for i, c in enumerate(counts)], names, idf, k)
    unit = [dict(zip(*(x.tolist() for x in index.vector(c)))) for c in counts]
    for c in sparse_examples(rng, 40, size) + counts[:5]:
        mine = dict(zip(*(x.tolist() for x in index.vector(c))))
        sims = sorted((round(sum(x * unit[d].get(f, 0.0) for f, x in mine.items()), 9) for d in index.doc_id.tolist()), reverse=True)
        near = index.nearest(*index.vector(c))
        assert [round(s, 9) for s, _ in near] == pytest.approx([s for s in sims[:k] if s > 0], abs=2e-9)
        for s, j in near:
            assert s == pytest.approx(sum(x * unit[int(index.doc_id[j])].get(f, 0.0) for f, x in mine.items()), abs=1e-9)
        assert near == sorted(near, key=lambda t: (-t[0], t[1]))
        skipped = index.nearest(*index.vector(c), skip=near[0][1]) if near else []
        assert near[0][1] not in [j for _, j in skipped] if near else True


def test_scores_by_brute_force(spark):
    """The whole query on a small table against vectors, cosines, votes and calibration computed plainly."""
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefghij") + rng.choice(["lpha", "rown,", "edar", "ust"]) + str(rng.randrange(6))
    texts = {i: " ".join(word() for _ in range(rng.randrange(3, 25))) + (" vile wretchedly" if i % 5 == 0 else "") for i in range(120)}
    texts |= {120: texts[7], 121: "", 122: None}
    toxic = {i: int(i % 5 == 0) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels, k=9).collect()}

    train = [i for i in toxic if not got[i].held_out]
    counts = {i: toxicity.features(t) for i, t in texts.items()}
    n1, n0 = sum(toxic[i] for i in train), sum(1 - toxic[i] for i in train)

    def told(f):
        """Three examples or more, G squared of 25 or more, odds that differ threefold."""
        a, b = (sum(f in counts[i] for i in train if toxic[i] == y) for y in (1, 0))
        cells = [(a, (a + b) * n1), (b, (a + b) * n0), (n1 - a, (n1 + n0 - a - b) * n1), (n0 - b, (n1 + n0 - a - b) * n0)]
        g2 = 2 * sum(x * math.log(x * (n1 + n0) / e) for x, e in cells if x)
        odds = abs(math.log((a + 0.5) * (n0 - b + 0.5) / ((b + 0.5) * (n1 - a + 0.5))))
        return a + b >= 3 and g2 >= 25 and odds >= math.log(3)

    known = {f for f in {f for i in train for f in counts[i]} if told(f)}
    assert known
    df = Counter(f for c in counts.values() for f in c)

    def unit(i):
        v = {f: (1 + math.log(n)) * math.log(1 + len(texts) / (1 + df[f])) for f, n in counts[i].items() if f in known}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {f: x / norm for f, x in v.items()}

    units = {i: unit(i) for i in texts}

    def vote(i, others):
        sims = sorted(((sum(x * units[j].get(f, 0.0) for f, x in units[i].items()), j) for j in others), reverse=True)
        sims = [s for s in sims if s[0] > 0]
        assert len(sims) <= 9 or sims[8][0] - sims[9][0] > 1e-9 or len({toxic[j] for s, j in sims if abs(s - sims[8][0]) < 1e-9}) == 1
        near = sims[:9]
        w = [1 / (1 - min(s, 1.0) + 0.1) for s, _ in near]
        return sum(x * toxic[j] for x, (_, j) in zip(w, near)) / sum(w) if near else None

    own = [(vote(i, [j for j in train if j != i]), toxic[i]) for i in train]
    fit = toxicity.isotonic(*(np.array(x) for x in zip(*[o for o in own if o[0] is not None])))
    alone = [y for v, y in own if v is None]
    for i in texts:
        v = vote(i, train)
        want = float(np.interp(v, *fit)) if v is not None else (sum(alone) + 0.5) / (len(alone) + 1)
        assert got[i].score == pytest.approx(want, abs=1e-6) and got[i].predicted == int(want >= 0.7)
    assert got[120].score == got[7].score and got[121].score == got[122].score


def test_one_example_per_id_and_empty_tables(spark):
    rows = [(3, f"text {i}") for i in range(50)] + [(i, "plain words") for i in range(100, 130)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(3, 1)] + [(i, 0) for i in range(100, 130)], "doc_id long, toxic int")
    examples = toxicity.pick_examples(docs, labels, 8).collect()
    assert len(examples) <= 8 and len({r.doc_id for r in examples}) == len(examples)
    assert toxicity.score_toxicity(docs, labels).count() == len(rows)
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.drop_toxic(docs.limit(0), labels.limit(0)).columns == docs.columns
