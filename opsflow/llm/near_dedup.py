"""MinHash near-dedup by a multi-index Hamming join.

A document's set holds its distinct ``k``-word shingles (64-bit hashes; A-Z
lower-cased; a text of fewer words is one shingle; no words, no set).
``SLOTS`` b-bit MinHash values (b = 16) form its signature; the distance of two
signatures is the number of slots that differ.

Multi-index. The slots are split into chunks. Two signatures at distance under
twice the chunks have, by pigeonhole, a chunk with at most one differing slot.
The allowed error is enumerated: each chunk gives one key per slot left out. So
any pair within ``reach(chunks) = 2 * chunks - 1`` of 64 slots shares a key.

The chunks follow from the least similarity asked for (``chunks_for``): at
similarity s a slot differs with probability 1 - s, and the fewest chunks, an
even number, are taken with which a pair of similarity s is out of reach at most
once in 10^5. At 0.85 that is 12 chunks, 23 slots, 8.8e-6 of such pairs missed;
at 0.80, the pipeline's, 16 chunks, 31 slots, 8.2e-8.

From keys to links, without listing all pairs of a key:

1. Documents with equal sets are one node, so copies cost nothing further.
2. Each key's least node is compared with its other nodes (as many pairs as
   rows); pairs within reach make first clusters.
3. Keys whose nodes all lie in one cluster are done. In the others, nodes are
   compared block by block, each block pair a small task, and only a spanning
   forest of what is found is returned. Clusters are then the components of the
   graph of all pairs within the distance.
4. Inside a cluster the full sets decide: blocks of at most ``SET_BLOCK``
   nodes are compared by one sparse product, exactly, and the links' spanning
   forest is returned. The links' components are the result.

Hot keys and large clusters are split into blocks, so no task holds one whole;
no bucket is capped.

Defined cases: null, empty and blank texts have no set: n_shingles 0, linked
with nothing, kept. Repeated rows are equal sets. component_id is the smallest
doc_id of the component (null ids are ignored unless all are null). An empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsflow.llm.bloom import member_filter
from opsflow.llm.common import components, give_back, join_stats, trimmed, written

SLOTS, MISS = 64, 1e-5
KEY_BLOCK, SET_BLOCK = 512, 256
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def reach(chunks: int) -> int:
    """The largest distance at which two signatures surely share a key."""
    return 2 * chunks - 1


def miss(percent: int, chunks: int) -> float:
    """How likely a pair of the given similarity is out of reach."""
    differ = 1 - percent / 100
    return sum(math.comb(SLOTS, i) * differ**i * (1 - differ) ** (SLOTS - i) for i in range(reach(chunks) + 1, SLOTS + 1))


def chunks_for(percent: int) -> int:
    return next(c for c in range(2, SLOTS // 2 + 1, 2) if c == SLOTS // 2 or miss(percent, c) <= MISS)


CHUNKS = chunks_for(85)
LEADS = 8  # leads that a node is compared with at first
MAX_DISTANCE = reach(CHUNKS)


def word_hashes(words: list[bytes], cache: dict[bytes, int]) -> np.ndarray:
    """64-bit word hashes; ``cache`` holds those of earlier words of the task and is emptied when large."""
    import xxhash

    if len(cache) > 100_000:  # some 12 MB
        cache.clear()
    out = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = cache.get(w)
        if h is None:
            h = cache[w] = xxhash.xxh64_intdigest(w)
        out[i] = h
    return out


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return (h ^ (h >> np.uint64(29))) * np.uint64(0x81DADEF4BC2DD44D)


def shingle_set(text: str | None, k: int, cache: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and the six blanks only
    if not words:
        return np.empty(0, np.uint64)
    h = word_hashes(words, cache)
    n = max(1, len(h) - k + 1)
    with np.errstate(over="ignore"):
        rolled = np.zeros(n, np.uint64)
        for j in range(min(k, len(h))):
            rolled = rolled * GOLDEN + h[j:j + n]
        return np.unique(mixed(rolled + np.uint64(min(k, len(h)))))


def slot_factors() -> np.ndarray:
    return np.random.default_rng(2024).integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signature(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 4096):
            np.minimum(least, (shingles[at:at + 4096, None] * factors).min(axis=0), out=least)
        # The least of many hashes is small, so its high bits say little; mixed, all bits do.
        return mixed(least).astype(np.uint16)


def signature_keys(sigs: np.ndarray, chunks: int = CHUNKS) -> np.ndarray:
    """(rows, SLOTS) keys: for every slot, the hash of the rest of its chunk."""
    keys = np.empty((len(sigs), SLOTS), np.uint64)
    edges = np.linspace(0, SLOTS, chunks + 1).astype(int)
    with np.errstate(over="ignore"):
        for a, b in zip(edges[:-1], edges[1:]):
            for left_out in range(a, b):
                h = np.full(len(sigs), left_out + 1, np.uint64)
                for slot in range(a, b):
                    if slot != left_out:
                        h = mixed(h * GOLDEN + sigs[:, slot])
                keys[:, left_out] = h
    return keys


def signed(docs: DataFrame, k: int) -> DataFrame:
    """rid, doc_id, text hash th, n_shingles, digest of the set, signature; digest and signature are null without a set."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, factors = {}, slot_factors()
        for batch in batches:
            n, digest, sig = [], [], []
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), k, cache)
                n.append(len(s))
                digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                sig.append(signature(s, factors).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())],
                ["doc_id", "th", "n_shingles", "digest", "sig"])

    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                          F.xxhash64("text").alias("th"))
    out = rows_in.mapInArrow(trimmed(rows), "doc_id long, th long, n_shingles long, digest binary, sig binary")
    return written(out.withColumn("rid", F.monotonically_increasing_id()), "signed")


def keyed(nodes: DataFrame, chunks: int) -> DataFrame:
    """key, node: each node's keys that some other node has too."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sigs = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(-1, SLOTS)
            keys = signature_keys(sigs, chunks).view(np.int64)
            node = np.repeat(batch.column("node").to_numpy(), SLOTS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], ["key", "node"])

    keys = written(nodes.select("node", "sig").mapInArrow(trimmed(rows), "key long, node long"), "keys")
    stats = keys.groupBy("key").agg(F.count("*").alias("size"), F.min("node").alias("lead")).filter("size > 1")
    stats = written(stats, "shared-keys")
    maybe = member_filter(stats.select("key"), stats.count())  # most keys are alone and needn't be shuffled again
    return written(join_stats(keys.filter(maybe("key")), stats, "key", "size", keys.count()).filter("size > 1"), "shared")


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def in_block_pairs(rows: DataFrame, group: str, size: str, block: int) -> DataFrame:
    """Rows dealt to block pairs (group, bi <= bj), each row with its own block's number."""
    blocks = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return (rows.withColumn("other", other).withColumn("bi", F.least("own", "other")).withColumn("bj", F.greatest("own", "other"))
            .drop("blocks", "other"))


def key_links(shared: DataFrame, nodes: DataFrame, labels: DataFrame, distance: int) -> DataFrame:
    """a, b: a spanning forest of the pairs within ``distance`` in keys whose nodes lie in several clusters."""
    lab = shared.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    lab = written(lab.select("key", "node", "size", "comp"), "labelled")
    mixed_keys = (lab.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key"))
    open_rows = lab.join(mixed_keys, "key", "left_semi").join(nodes.select("node", "sig"), "node")
    dealt = in_block_pairs(open_rows, "key", "size", KEY_BLOCK)
    dealt = written(dealt.select("key", "bi", "bj", "own", "node", "comp", "sig"), "dealt")
    groups = max(1, dealt.count() // 20_000)
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("key", "bi", "bj"), F.lit(groups)))

    def search(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["key", "bi", "bj", "node"], ignore_index=True)
        sigs = np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(-1, SLOTS)
        comps, comp = np.unique(part["comp"].to_numpy(), return_inverse=True)
        node, own, bi, bj = (part[c].to_numpy() for c in ("node", "own", "bi", "bj"))
        key = part["key"].to_numpy()
        forest, found = Forest(len(comps)), []
        ends = np.nonzero(np.r_[(key[1:] != key[:-1]) | (bi[1:] != bi[:-1]) | (bj[1:] != bj[:-1]), True])[0] + 1
        start = 0
        for end in ends:
            for i in range(start, end - 1):
                if len({forest.find(c) for c in set(comp[start:end].tolist())}) == 1:
                    break
                rest = np.arange(i + 1, end)
                if bi[i] != bj[i]:  # pairs of one block are met in that block's own group
                    rest = rest[own[i + 1:end] != own[i]]
                near = rest[(sigs[rest] != sigs[i]).sum(axis=1) <= distance]
                found += [(node[i], node[j]) for j in near.tolist() if forest.join(int(comp[i]), int(comp[j]))]
            start = end
        give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return dealt.groupBy("part").applyInPandas(search, "a long, b long")


def clusters(nodes: DataFrame, shared: DataFrame, within: int) -> DataFrame:
    """node, comp: components of the pairs at most ``within`` apart; nodes without a pair are left out."""
    # A node meets the leads that it shares the most keys with; pairs that this leaves open are found by ``key_links``.
    often = shared.filter("node <> lead").groupBy("node", "lead").agg(F.count("*").alias("n"))
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("n"), "lead"))
    star = often.withColumn("place", place).filter(F.col("place") <= LEADS).select(F.col("lead").alias("a"), F.col("node").alias("b"))
    sig = nodes.select("node", "sig")

    @F.pandas_udf("int")
    def distance(a: pd.Series, b: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(s), np.uint16).reshape(-1, SLOTS) for s in (a, b))
        return pd.Series((x != y).sum(axis=1).astype(np.int32))

    near = (star.join(sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b")
            .join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a")
            .filter(distance("sa", "sb") <= within).select("a", "b"))
    near = written(near, "near")
    more = written(key_links(shared, nodes, components(near), within), "more")
    return components(near.union(more))


def set_links(docs: DataFrame, rows: DataFrame, grouped: DataFrame, k: int, percent: int) -> DataFrame:
    """a, b: a spanning forest of the links inside each cluster, on full sets."""
    sizes = grouped.groupBy("comp").agg(F.count("*").alias("size"))
    members = written(join_stats(grouped, sizes, "comp", "size", grouped.count()), "members")
    named = rows.select("rid", "doc_id", "digest").join(members, rows.rid == members.node, "left_semi").select("doc_id", "digest")
    named = written(named, "named")
    wanted = member_filter(named.select(F.xxhash64("doc_id")), named.count())  # which documents' sets are needed at all

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for batch in batches:
            found = [shingle_set(t.as_py(), k, cache).tobytes() for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.blake2b(s, digest_size=16).digest() for s in found], pa.binary()), pa.array(found, pa.binary())],
                ["digest", "shingles"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = source.filter(wanted(F.xxhash64("doc_id"))).select("text").mapInArrow(trimmed(sets), "digest binary, shingles binary")
    reps = rows.select(F.col("rid").alias("node"), "digest", "n_shingles").join(members, "node")
    # One row per set: equal sets are equal bytes, combined before the shuffle.
    chosen = chosen.join(reps.select("digest"), "digest", "left_semi").groupBy("digest").agg(F.first("shingles").alias("shingles"))
    full = reps.join(chosen, "digest").select("node", "comp", "size", "shingles")
    dealt = in_block_pairs(full, "comp", "size", SET_BLOCK)
    dealt = written(dealt.select("comp", "bi", "bj", "own", "node", "shingles"), "sets")
    # Tasks of some 16 MB of sets, at most 1000 of them.
    total = dealt.agg(F.count("*"), F.sum(F.octet_length("shingles"))).first()
    groups = max(1, total[0] // 1000, (total[1] or 0) // (16 << 20))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("comp", "bi", "bj"), F.lit(groups)))

    def verify(part: pd.DataFrame) -> pd.DataFrame:
        found = []
        for (_, bi, bj), g in part.groupby(["comp", "bi", "bj"], sort=False):
            g = g.sort_values("node")
            found += links_of(g["node"].to_numpy(), [np.frombuffer(s, np.uint64) for s in g["shingles"]],
                              g["own"].to_numpy() if bi != bj else None, percent)
        give_back()
        return pd.DataFrame(found, columns=["a", "b"], dtype=np.int64)

    return dealt.groupBy("part").applyInPandas(verify, "a long, b long")


def links_of(node: np.ndarray, sets: list[np.ndarray], own: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs with 100 * intersection >= percent * union; with ``own``, of pairs across the two blocks."""
    n = len(sets)
    if n < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    flat, row = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, column, uses = np.unique(flat, return_inverse=True, return_counts=True)
    useful = uses[column] > 1
    row, column = row[useful], column[useful]
    both = np.zeros((n, n), np.float32)
    if len(column):
        _, column = np.unique(column, return_inverse=True)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for at in range(0, column[-1] + 1, 4096):  # exact: counts stay far below 2**24
            a, b = np.searchsorted(column, [at, at + 4096])
            m = np.zeros((n, 4096), np.float32)
            m[row[a:b], column[a:b] - at] = 1
            both += m @ m.T
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    if own is not None:
        linked &= own[:, None] != own[None, :]
    forest = Forest(n)
    return [(node[i], node[j]) for i, j in zip(*np.nonzero(np.triu(linked, 1))) if forest.join(int(i), int(j))]


def near_groups(docs: DataFrame, k: int = 5, percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text hash th."""
    rows = signed(docs, k)
    n = rows.count()
    classes = (rows.filter("digest IS NOT NULL").groupBy("digest")
               .agg(F.min("rid").alias("node"), F.min("doc_id").alias("least"), F.count("*").alias("size"), F.first("sig").alias("sig")))
    nodes = written(classes, "nodes")
    chunks = chunks_for(percent)
    grouped = clusters(nodes, keyed(nodes, chunks), reach(chunks))
    linked = components(written(set_links(docs, rows, grouped, k, percent), "links"))
    of_node = nodes.select("digest", "node", "least", "size").join(linked, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    firsts = of_node.groupBy("comp").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes"))
    named = written(join_stats(of_node, firsts, "comp", "nodes", n).select("digest", "size", "component_id"), "named-classes")
    thin = rows.select("doc_id", "th", "n_shingles", "digest")
    with_set = join_stats(thin.filter("digest IS NOT NULL"), named, "digest", "size", n)
    without = thin.filter("digest IS NULL").withColumn("component_id", F.col("doc_id"))
    cols = ["doc_id", "th", "n_shingles", "component_id"]
    out = with_set.select(*cols).unionByName(without.select(*cols))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 85) -> DataFrame:
    """The rows whose id is their component's, with all their columns; other rows are found by id and text."""
    gone = written(near_groups(docs, k, percent).filter("NOT kept").select(
        F.col("doc_id").alias("gone_id"), F.col("th").alias("gone_text")).distinct(), "gone")
    # The row travels in a struct, so its own columns can't clash with these.
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"))
    same = F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("th") == F.col("gone_text"))
    return rows.join(gone, same, "left_anti").select("row.*")
