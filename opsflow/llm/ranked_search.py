r"""Ranked lexical search by the Best Position Algorithm over impact lists.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters of
the whole text, A-Z lower-cased. With N documents that have a term, L terms in
all, n terms in a document, df documents holding a term and tf occurrences:
weight w = floor(1000 ln((2N+2)/(2df+1))), length norm
m = 100 - 50 + ((50 n N) div L), impact = w ((10^9 tf) div (1000 tf + 20 m)); a
document's score for an item is the sum of the impacts of the item's terms.

Method. Items are the stated query set; they are taken in blocks of some
``block_terms`` (item, term) pairs, so that a block's vocabulary fits in a task, and
each block reads all documents:

1. One scan tokenises the whole texts and writes, for each document, n and its
   vocabulary terms with tf. N, L and df are sums over what was written.
2. Documents are dealt to shards of at most ``shard_postings`` postings. A shard
   keeps, for each term, its impact list: documents by falling impact.
3. For each item, sorted access goes down all of its lists together. Each newly seen
   document is completed by direct access, which also tells its *position* in every other
   list. A list's best position is the last one of its unbroken run of seen positions; it is
   never above the last position read, mostly well below, so the sum of the impacts at the
   best positions bounds every unseen document more tightly than the last-read
   positions do. An item stops once the bound is strictly below its k-th score:
   an unseen document might tie and have a smaller id otherwise.
4. A task carries an item's best k from shard to shard, so later shards stop
   sooner. What tasks found is ranked in two steps: per item and one of 64 slots, then per item.

Sorted access reads blocks of positions (doubling from ``FIRST_STEP``); the stopping
rule is checked after each, on exact bounds, so results don't depend on the step.

Defined cases: null, empty and blank texts have no terms and never match; an
item without terms, or with terms that no document has, gets no rows; every
row of the items table is an item of its own, so repeated rows repeat their
results; repeated rows of documents are documents of their own; ties go by ascending
id, null ids last; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsflow.llm.common import written

# The score's constants (saturation, length norm).
SCALE, TF_UNIT, NORM_UNIT, NORM_FLAT, NORM_LENGTH = 1_000_000_000, 1000, 20, 50, 50
FIRST_STEP = 16
PIECE_BYTES = 1 << 20
SLOTS = 64  # of the first ranking step
NO_ID = np.iinfo(np.int64).max  # null ids rank last; told apart from a real id by a flag

# Every byte outside a term becomes a blank, A-Z their lower-case letters; bytes of non-ASCII characters stay.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_counts(text: bytes) -> tuple[Counter, int]:
    """Occurrences of each term and their number, long texts in pieces cut between terms."""
    clean = text.translate(_TABLE)
    if len(clean) <= PIECE_BYTES:
        terms = clean.split()
        return Counter(terms), len(terms)
    found, n, at = Counter(), 0, 0
    while at < len(clean):
        end = clean.find(b" ", at + PIECE_BYTES)
        terms = clean[at:end if end >= 0 else len(clean)].split()
        found.update(terms)
        n += len(terms)
        at = end if end >= 0 else len(clean)
    return found, n


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per item row and distinct term: iid (a number of the row), item_id, term."""
    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            iids, ids, terms = [], [], []
            for iid, item, text in zip(*[b.column(k).to_pylist() for k in range(3)]):
                own = list(term_counts(text.encode())[0])
                iids += [iid] * len(own)
                ids += [item] * len(own)
                terms += own
            yield pa.record_batch([pa.array(iids, pa.int64()), pa.array(ids, pa.int64()), pa.array(terms, pa.binary())], ["iid", "item_id", "term"])

    numbered = rows.select(F.monotonically_increasing_id().alias("iid"), "item_id", "text")
    return written(numbered.mapInArrow(split, "iid long, item_id long, term binary"), "item-terms")


def doc_postings(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[bytes]) -> DataFrame:
    """One row per document with a term: doc_id, n, terms (numbers of vocabulary terms) and tfs; written."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    number = {t: i for i, t in enumerate(vocabulary)}
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ns, terms, tfs = [], [], [], []
            texts = b.column(1).cast(pa.binary())
            for doc, text in zip(b.column(0).to_pylist(), texts):
                if not text.is_valid:
                    continue
                found, n = term_counts(text.as_py())
                if n:
                    hits = number.keys() & found.keys()
                    ids.append(doc)
                    ns.append(n)
                    terms.append([number[t] for t in hits])
                    tfs.append([found[t] for t in hits])
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip((ids, ns, terms, tfs), schema)], schema=schema)

    return written(rows.mapInArrow(scan, "doc_id long, n long, terms array<int>, tfs array<long>"), "postings")


class Shard:
    """Impact lists of some documents: postings by document, and each term's in falling impact."""

    def __init__(self, start: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        self.start, self.term, self.impact = start, term, impact
        doc = np.repeat(np.arange(len(start) - 1), np.diff(start))
        order = np.lexsort((doc, -impact, term))
        self.first = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.list_doc, self.list_impact = doc[order], impact[order]
        self.position = np.empty(len(term), np.int64)
        self.position[order] = np.arange(len(term)) - self.first[term[order]]

    def best(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, by best positions, of all that may be among an item's k best; ``floor``: a k-th score known already."""
        terms = terms[self.first[terms + 1] > self.first[terms]]
        size = self.first[terms + 1] - self.first[terms]
        slot = np.full(len(self.first), -1)
        slot[terms] = np.arange(len(terms))
        base = np.concatenate(([0], np.cumsum(size)))  # of each list in ``hit``
        hit = np.zeros(base[-1], bool)
        seen = np.zeros(len(self.start) - 1, bool)
        best = np.zeros(len(terms), np.int64)  # seen positions without a gap, of each list
        docs, scores = [], []
        at, step, kth, n_found = 0, FIRST_STEP, floor, 0
        while len(terms):
            # Sorted access: the next positions of every list.
            reads = [self.list_doc[f + at:f + min(at + step, s)] for f, s in zip(self.first[terms], size) if s > at]
            if not reads:
                break
            new = np.unique(np.concatenate(reads))
            new = new[~seen[new]]
            if len(new):
                seen[new] = True
                # Direct access: all postings of the new documents, one after the other.
                count = self.start[new + 1] - self.start[new]
                row = np.repeat(self.start[new] - np.concatenate(([0], np.cumsum(count[:-1]))), count) + np.arange(count.sum())
                own = slot[self.term[row]]
                mine = own >= 0
                hit[base[own[mine]] + self.position[row[mine]]] = True
                scores.append(np.add.reduceat(np.where(mine, self.impact[row], 0), np.concatenate(([0], np.cumsum(count[:-1])))))
                docs.append(new)
                n_found += len(new)
            at, step = at + step, step * 2
            for i in range(len(terms)):
                if best[i] < size[i]:
                    rest = hit[base[i] + best[i]:base[i + 1]]
                    gap = int(rest.argmin())
                    best[i] += len(rest) if rest[gap] else gap
            # A list seen to its end has nothing unseen; others at most the impact at their best position.
            open_ = best < size
            bound = int(self.list_impact[self.first[terms[open_]] + np.maximum(best[open_] - 1, 0)].sum())
            if n_found >= k:
                found = np.concatenate(scores)
                kth = max(kth, int(np.partition(found, n_found - k)[n_found - k]))
            if bound < kth:
                break
        if not docs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        docs, scores = np.concatenate(docs), np.concatenate(scores)
        able = (scores >= kth) & (scores > 0)
        return docs[able], scores[able]


def merged(kept: tuple | None, ids: np.ndarray, null: np.ndarray, scores: np.ndarray, k: int) -> tuple:
    """The k best of what an item had and what a shard adds: score falling, id rising, null ids last."""
    if kept is not None:
        ids, null, scores = np.concatenate((kept[0], ids)), np.concatenate((kept[1], null)), np.concatenate((kept[2], scores))
    order = np.lexsort((ids, null, -scores))[:k]
    return ids[order], null[order], scores[order]


def search_block(postings: DataFrame, items: dict[int, tuple[int | None, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int,
                 k: int, shard_postings: int) -> DataFrame:
    """What each task finds for each item: iid, item_id, doc_id, score, slot; at most k rows for an item from one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, tuple] = {}
        held, n_held = [], 0

        def drain() -> None:
            cols = [np.concatenate(x) for x in zip(*held)]
            ids, null, n, count, term, tf = cols
            norm = NORM_FLAT + NORM_LENGTH * n * n_docs // n_terms
            impact = weights[term] * (SCALE * tf // (TF_UNIT * tf + NORM_UNIT * np.repeat(norm, count)))
            live = impact > 0
            upto = np.concatenate(([0], np.cumsum(live)))
            ends = np.cumsum(count)
            count = upto[ends] - upto[ends - count]
            some = count > 0  # documents without a posting can't match
            shard = Shard(np.concatenate(([0], np.cumsum(count[some]))), term[live], impact[live], len(weights))
            ids, null = ids[some], null[some]
            for iid, (_, terms) in items.items():
                had = kept.get(iid)
                floor = int(had[2][-1]) if had is not None and len(had[2]) == k else 0
                docs, scores = shard.best(terms, k, floor)
                if len(docs):
                    kept[iid] = merged(had, ids[docs], null[docs], scores, k)
            held.clear()

        for b in batches:
            doc, lists, tfs = b.column(0), b.column(2), b.column(3)
            count = np.diff(lists.offsets.to_numpy())
            parts = (doc.fill_null(NO_ID).to_numpy(), doc.is_null().to_numpy(zero_copy_only=False), b.column(1).to_numpy(), count,
                     lists.flatten().to_numpy().astype(np.int64), tfs.flatten().to_numpy())
            at = 0
            ends = np.cumsum(count)
            while at < len(count):
                # As many documents as the shard still takes, one at least.
                room = shard_postings - n_held + (ends[at - 1] if at else 0)
                to = max(at + 1, int(np.searchsorted(ends, room, "right")))
                lo, hi = (ends[at - 1] if at else 0), ends[to - 1]
                held.append((*[x[at:to] for x in parts[:4]], *[x[lo:hi] for x in parts[4:]]))
                n_held += hi - lo
                at = to
                if n_held >= shard_postings:
                    drain()
                    n_held = 0
        if held:
            drain()
        if kept:
            ids, null, scores = [np.concatenate(x) for x in zip(*kept.values())]
            iids = [iid for iid, x in kept.items() for _ in x[0]]
            slot = [TaskContext.get().partitionId() % SLOTS] * len(ids)
            yield pa.record_batch([pa.array(iids, pa.int64()), pa.array([items[i][0] for i in iids], pa.int64()), pa.array(ids, mask=null),
                                   pa.array(scores), pa.array(slot, pa.int32())], ["iid", "item_id", "doc_id", "score", "slot"])

    return postings.mapInArrow(run, "iid long, item_id long, doc_id long, score long, slot int")


def search(docs: DataFrame, items: DataFrame, k: int = 50, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text",
           block_terms: int = 1_000_000, shard_postings: int = 1_000_000) -> DataFrame:
    """The k best documents of each item: iid, item_id, rank, doc_id, score.

    Blocks hold some ``block_terms`` (item, term) pairs each, dealt by a hash of the item: what the driver and a task keep
    of the items at once (about 100 MB at the default), whatever their number.
    """
    spark = docs.sparkSession
    terms = item_terms(items, item_col, text_col)
    n_blocks = -(-terms.count() // block_terms)
    found = None
    for block in range(n_blocks):
        own = terms.filter(F.pmod(F.xxhash64("iid"), F.lit(n_blocks)) == block).toArrow()
        vocabulary = sorted(set(own.column("term").to_pylist()))
        number = {t: i for i, t in enumerate(vocabulary)}
        lists: dict[int, tuple] = {}
        for iid, item, term in zip(*[own.column(c).to_pylist() for c in ("iid", "item_id", "term")]):
            lists.setdefault(iid, (item, []))[1].append(number[term])
        lists = {iid: (item, np.array(sorted(t), np.int64)) for iid, (item, t) in sorted(lists.items())}
        postings = doc_postings(docs, id_col, text_col, vocabulary)
        n_docs, n_terms = postings.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        weights = np.zeros(len(vocabulary), np.int64)
        # One row per vocabulary term of the block.
        for term, df in postings.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        part = written(search_block(postings, lists, weights, n_docs, n_terms, k, shard_postings), "found")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], "iid long, item_id long, rank int, doc_id long, score long")
    ranked = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    for keys in (("iid", "slot"), ("iid",)):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked))).filter(F.col("rank") <= k)
    return found.select("iid", "item_id", "rank", "doc_id", "score")
