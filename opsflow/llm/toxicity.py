"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Examples. At most ``max_examples`` labelled ids whose crc32(doc_id as text)
mod 3 is not 1, those with the smallest id hashes, one text each (the least, if
rows share an id); the bound makes the index a broadcast of fixed size. A document with several labels is toxic if any says so.

Features are lower-case words stripped of punctuation and their 4- and
5-character beginnings. Of those, at most ``max_features`` are kept whose
presence among the examples depends on the label: G squared of at least
``min_g2`` and odds that differ ``min_odds`` times or more (which leaves out
common words of a language). Document frequencies are counted over the whole corpus. A vector is
(1 + log tf) * idf over the kept features, of length 1.

Index. Examples are ordered by their heaviest feature and cut into blocks; each
(feature, block) has its postings and their largest weight. A query sums the
block maxima into a bound per block, opens blocks from the largest bound down,
and stops when the next bound cannot beat the k-th best similarity: the k
nearest are exact.

Score. A neighbour votes with weight 1 / (distance + 0.1). The votes are
calibrated by an isotonic fit to the examples' own votes, each without itself;
texts without any neighbour get the rate of such examples. The evidence is the
nearest examples with similarity and label. labels, lang, source and doc_id are
no input of a score: equal texts have equal scores.

Defined cases: null is an empty text; null labels are ignored; without any
label all scores are 0.5; repeated rows are scored each; rows without an id are
never examples; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsflow.llm.common import trimmed, written

BLOCK = 64
STRIP = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¿¡«»“”„…"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(text: str | None) -> Counter:
    """Occurrences of words and of their beginnings."""
    out: Counter = Counter()
    for word, n in Counter((text or "").lower().split()).items():
        word = word.strip(STRIP)
        if word:
            out[word] += n
            if len(word) > 4:
                out[word[:4] + "*"] += n
            if len(word) > 5:
                out[word[:5] + "*"] += n
    return out


def pick_examples(docs: DataFrame, labels: DataFrame, max_examples: int) -> DataFrame:
    """doc_id, text, label of the sampled training ids, one row each."""
    known = (labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
             .agg(F.max("toxic").cast("int").alias("label")).filter(~held_out(F.col("doc_id"))))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_examples)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    one = rows.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return written(one.select("doc_id", "text", "label"), "examples")


def pick_features(examples: DataFrame, max_features: int, min_g2: float, min_odds: float) -> list[str]:
    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                names = list(features(text))
                yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "label": pa.array([label] * len(names), pa.int32())})

    total = examples.agg(F.count("*").alias("n"), F.coalesce(F.sum("label"), F.lit(0)).alias("toxic")).first()
    counts = (examples.select("text", "label").mapInArrow(trimmed(presence), "feature string, label int").groupBy("feature")
              .agg(F.sum("label").cast("double").alias("a"), F.sum(1 - F.col("label")).cast("double").alias("b")))
    n1, n0 = float(total.toxic), float(total.n - total.toxic)
    c, d = n1 - F.col("a"), n0 - F.col("b")
    n, with_it = n1 + n0, F.col("a") + F.col("b")
    term = lambda seen, expected: F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)
    if not n1 or not n0:
        return []
    g2 = 2 * (term(F.col("a"), with_it * n1 / n) + term(F.col("b"), with_it * n0 / n)
              + term(c, (n - with_it) * n1 / n) + term(d, (n - with_it) * n0 / n))
    odds = F.abs(F.log((F.col("a") + 0.5) * (d + 0.5) / ((F.col("b") + 0.5) * (c + 0.5))))
    best = counts.filter("a + b >= 3").withColumn("g2", g2).filter((F.col("g2") >= min_g2) & (odds >= math.log(min_odds)))
    return sorted(r.feature for r in best.orderBy(F.desc("g2"), "feature").limit(max_features).select("feature").collect())


def document_frequencies(docs: DataFrame, names: list[str]) -> tuple[int, np.ndarray]:
    """Documents, and documents with each feature, over the whole corpus."""
    place = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, df = place.value, np.zeros(len(place.value) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                df[[seen[f] for f in features(text.as_py()) if f in seen]] += 1
                df[-1] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df))), pa.array(df)], ["feature", "n"])

    rows = docs.select("text").mapInArrow(trimmed(count), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(names) + 1, np.int64)
    for r in rows:  # one number per feature
        df[r.feature] = r.n
    return int(df[-1]), df[:-1]


@dataclass
class Index:
    """Block-max inverted index of the examples, with the calibration; of bounded size."""

    place: dict[str, int]
    idf: np.ndarray
    doc_id: np.ndarray
    label: np.ndarray
    block_max: np.ndarray  # (features, blocks)
    starts: np.ndarray  # (features, blocks + 1): where a feature's postings of a block start
    posting_doc: np.ndarray
    posting_weight: np.ndarray
    k: int
    votes: np.ndarray | None = None  # calibration: scores at rising votes
    scores: np.ndarray | None = None
    no_neighbour: float = 0.5

    def vector(self, counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        found = sorted((self.place[f], n) for f, n in counts.items() if f in self.place)
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        at = np.array([i for i, _ in found])
        w = (1 + np.log([n for _, n in found])) * self.idf[at]
        norm = math.sqrt(float(w @ w))
        return (at, w / norm) if norm else (at[:0], w[:0])

    def nearest(self, at: np.ndarray, w: np.ndarray, skip: int = -1) -> list[tuple[float, int]]:
        """The k examples with the largest positive cosine, exact; ties by example number."""
        best: list[tuple[float, int]] = []
        if not len(at) or not self.block_max.shape[1]:
            return best
        bound = w @ self.block_max[at]
        for b in np.argsort(-bound, kind="stable"):
            if bound[b] <= 0 or len(best) == self.k and bound[b] < best[-1][0] - 1e-9:
                break
            sims = np.zeros(BLOCK)
            for i, x in zip(at, w):
                a, z = self.starts[i, b], self.starts[i, b + 1]
                if z > a:
                    sims[self.posting_doc[a:z] - b * BLOCK] += x * self.posting_weight[a:z]
            for j in np.nonzero(sims > 0)[0]:
                if b * BLOCK + j != skip:
                    best.append((round(float(sims[j]), 12), int(b * BLOCK + j)))
            best = sorted(best, key=lambda t: (-t[0], t[1]))[:self.k]
        return best

    def vote(self, near: list[tuple[float, int]]) -> float | None:
        if not near:
            return None
        weight = np.array([1 / (1 - min(s, 1.0) + 0.1) for s, _ in near])
        return float(weight @ self.label[[j for _, j in near]] / weight.sum())

    def calibrated(self, vote: float | None) -> float:
        if vote is None or self.votes is None or not len(self.votes):
            return self.no_neighbour
        return float(np.interp(vote, self.votes, self.scores))


def build_index(examples: list[tuple[int, Counter, int]], names: list[str], idf: np.ndarray, k: int) -> Index:
    empty = Index({f: i for i, f in enumerate(names)}, idf, np.empty(0), np.empty(0), np.zeros((len(names), 0)), np.zeros((len(names), 1)),
                  np.empty(0), np.empty(0), k)
    vectors = [(doc_id, label, *empty.vector(counts)) for doc_id, counts, label in examples]
    vectors = [v for v in vectors if len(v[2])]
    vectors.sort(key=lambda v: (int(v[2][np.argmax(v[3])]), v[1], v[0]))  # like examples share blocks: tighter bounds
    blocks = -(-len(vectors) // BLOCK)
    row = np.concatenate([np.full(len(v[2]), i) for i, v in enumerate(vectors)] or [np.empty(0, int)]).astype(np.int64)
    col = np.concatenate([v[2] for v in vectors] or [np.empty(0, int)]).astype(np.int64)
    weight = np.concatenate([v[3] for v in vectors] or [np.empty(0)])
    order = np.lexsort((row, col))
    row, col, weight = row[order], col[order], weight[order]
    block_max = np.zeros((len(names), blocks))
    np.maximum.at(block_max, (col, row // BLOCK), weight)
    cell = col * blocks + row // BLOCK
    edges = np.searchsorted(cell, np.arange(len(names) * blocks + 1)) if blocks else np.zeros(len(names) + 1, int)
    starts = np.stack([edges[i * blocks:(i + 1) * blocks + 1] for i in range(len(names))]) if blocks and names else np.zeros((len(names), 1), int)
    return Index(empty.place, idf, np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], float), block_max, starts, row, weight, k)


def isotonic(votes: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising step fit by pooling neighbours that fall; each pool's rate is smoothed by half a case of each label."""
    pools: list[list[float]] = []  # vote sum, cases, toxic
    for v, y in sorted(zip(votes.tolist(), labels.tolist())):
        pools.append([v, 1, y])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [x + z for x, z in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.maximum.accumulate([(p[2] + 0.5) / (p[1] + 1) for p in pools] or [0.5])


def calibrate(index: Index, examples: DataFrame) -> None:
    """Set the index's calibration from leave-one-out votes, which tasks compute."""
    spark = examples.sparkSession
    shared = spark.sparkContext.broadcast(vars(index))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = Index(**shared.value)
        own: dict[int, list[int]] = {}
        for i, doc_id in enumerate(x.doc_id.tolist()):
            own.setdefault(doc_id, []).append(i)
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                out.append(x.vote(x.nearest(*x.vector(features(text)), skip=own.get(doc_id, [-1])[0])))
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(out, pa.float64())], ["label", "vote"])

    rows = examples.select("doc_id", "text", "label").mapInArrow(trimmed(vote), "label int, vote double").collect()  # at most max_examples pairs
    alone = [r.label for r in rows if r.vote is None]
    index.no_neighbour = (sum(alone) + 0.5) / (len(alone) + 1)
    voted = [(r.vote, r.label) for r in rows if r.vote is not None]
    if voted:
        index.votes, index.scores = isotonic(np.array([v for v, _ in voted]), np.array([y for _, y in voted]))


def kept_counts(examples: DataFrame, names: list[str]) -> DataFrame:
    """doc_id, label, and the kept features with their counts."""
    shared = examples.sparkSession.sparkContext.broadcast(set(names))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{f: n for f, n in features(t).items() if f in shared.value} for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array([list(x) for x in found], pa.list_(pa.string())),
                 pa.array([list(x.values()) for x in found], pa.list_(pa.int64()))], ["doc_id", "label", "feature", "n"])

    return examples.select("doc_id", "text", "label").mapInArrow(trimmed(count), "doc_id long, label int, feature array<string>, n array<long>")


def fit(docs: DataFrame, labels: DataFrame, max_examples: int = 8192, max_features: int = 4096, min_g2: float = 25.0,
        min_odds: float = 3.0, k: int = 16) -> Index:
    examples = pick_examples(docs, labels, max_examples)
    names = pick_features(examples, max_features, min_g2, min_odds)
    n, df = document_frequencies(docs, names)
    idf = np.log(1 + n / (1 + df))

    rows = kept_counts(examples, names).collect()  # at most max_examples rows of kept features
    index = build_index([(r.doc_id, Counter(dict(zip(r.feature, r.n))), r.label) for r in rows], names, idf, k)
    calibrate(index, examples)
    return index


def scorer(docs: DataFrame, index: Index):
    """Column function: text -> struct(score, evidence)."""
    shared = docs.sparkSession.sparkContext.broadcast(vars(index))

    @F.pandas_udf("score double, evidence array<struct<doc_id:long,similarity:double,label:int>>")
    def score(text: pd.Series) -> pd.DataFrame:
        x, scores, evidence = Index(**shared.value), [], []
        for t in text:
            near = x.nearest(*x.vector(features(t)))
            scores.append(x.calibrated(x.vote(near)))
            evidence.append([{"doc_id": int(x.doc_id[j]), "similarity": s, "label": int(x.label[j])} for s, j in near[:3]])
        return pd.DataFrame({"score": scores, "evidence": evidence})

    return score


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence."""
    score = scorer(docs, fit(docs, labels, **settings))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score(F.col("text")).alias("s"))
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "s.score",
                       (F.col("s.score") >= threshold).cast("int").alias("predicted"), "s.evidence")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **settings) -> DataFrame:
    """The rows that are not predicted toxic, with all their columns."""
    score = scorer(docs, fit(docs, labels, **settings))
    return docs.filter(score(F.col("text"))["score"] < threshold)
