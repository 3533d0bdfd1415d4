"""Token counts with overlap resynchronisation.

Texts of up to ``long_chars`` are counted whole, in batches: they are cut into the tokenizer's
own words, and every distinct word is encoded by the library once (``WordCounts``). A longer text is
cut into chunks that overlap, which are dealt to tasks one by one and encoded
with offsets, so the largest document is not one task's work.

Splicing. At a word boundary of the tokenizer's own pre-tokenization (where its
word number changes) encoding goes on without memory of what came before. So
where the earlier chunk and the later one both have a word boundary at the same
character, the whole text's encoding has one, and from there on equals the
later chunk's. Boundaries within ``GUARD`` characters of the earlier chunk's end
are not used: there its last word or a special string may be cut off. The count
is the sum of the chunks' tokens less, per seam, the earlier chunk's tokens
after the common boundary and the later chunk's before it.

Widening. If a seam has no common boundary (one very long word), the whole
document is done again with chunks and overlaps four times as long, until each
seam has one or the text is a single chunk.

Defined cases: null is an empty text of 0 tokens; repeated rows are counted
each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsflow.llm.common import written

GUARD = 64  # more than any special string plus the one character that pre-tokenization looks ahead
BATCH_CHARS = 1 << 18


def load(json_text: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task on every core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(json_text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def batches_of(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts with about BATCH_CHARS characters."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_CHARS:
            yield texts[start:i + 1]
            start, size = i + 1, 0
    yield texts[start:]


def word_starts(encoding) -> list[tuple[int, int]]:
    """(character, tokens before it) at each start of a pre-token."""
    words, offsets = encoding.word_ids, encoding.offsets
    return [(offsets[i][0], i) for i in range(1, len(words)) if words[i] != words[i - 1]]


def chunk_spans(n: int, chunk: int, overlap: int) -> list[tuple[int, int]]:
    if n <= chunk:
        return [(0, n)]
    step = chunk - overlap
    return [(s, min(n, s + chunk)) for s in range(0, n - overlap, step)]


class WordCounts:
    """Token counts of whole texts, every distinct word encoded once.

    Byte-level BPE splits a text into words by a fixed pattern and encodes each on its own, so a text's count is the sum
    of its words'. The pattern is applied here only to texts where that is sure to give the library's words: the
    tokenizer has that pattern and nothing before it, no special string is in the text, and for each of its characters
    the library itself was seen to put it into the same class (letter, number, white space, other) as the pattern does
    here. All other texts are encoded whole by the library.
    """

    # Fixed value: the byte-level pattern.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    MAX_WORDS, MAX_LETTERS = 300_000, 64  # words kept for later batches, some 40 MB

    def __init__(self, json_text: str):
        import json

        import regex

        spec = json.loads(json_text)
        self.tokenizer, self.known, self.alike = load(json_text), {}, {}
        before, model = spec.get("pre_tokenizer") or {}, spec.get("model") or {}
        self.usual = (before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
                      and spec.get("normalizer") is None and model.get("type") == "BPE" and not model.get("dropout"))
        self.special = [t["content"] for t in spec.get("added_tokens") or []]
        self.pattern = regex.compile(self.PATTERN)
        self.classes = [(k, regex.compile(p)) for k, p in (("letter", r"\p{L}"), ("number", r"\p{N}"), ("space", r"\s"))]

    def _same_class(self, c: str) -> bool:
        here = next((k for k, p in self.classes if p.match(c)), "other")
        one_piece = lambda x: len(self.tokenizer.pre_tokenizer.pre_tokenize_str(x + c)) == 1
        there = next((k for k, x in (("letter", "a"), ("number", "1"), ("other", "?")) if one_piece(x)), "space")
        return here == there

    def _plain(self, text: str) -> bool:
        if not self.usual or any(s in text for s in self.special):
            return False
        chars = set(text)
        for c in chars.difference(self.alike):
            self.alike[c] = self._same_class(c)
        return all(map(self.alike.__getitem__, chars))

    def counts(self, texts: list[str]) -> list[int]:
        plain = [self._plain(t) for t in texts]
        words = [self.pattern.findall(t) if p else None for t, p in zip(texts, plain)]
        used = set().union(*(w for w in words if w is not None))
        if len(self.known) + len(used) > self.MAX_WORDS:
            self.known = {}
        new = list(used.difference(self.known))
        self.known.update(zip(new, self._by_library(new)))
        whole = iter(self._by_library([t for t, p in zip(texts, plain) if not p]))
        out = [next(whole) if w is None else sum(map(self.known.__getitem__, w)) for w in words]
        for w in new:
            if len(w) > self.MAX_LETTERS:
                del self.known[w]
        return out

    def _by_library(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)] if texts else []


def count_whole(rows: DataFrame, tokenizer_json: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(tokenizer_json)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = WordCounts(shared.value)
        for batch in batches:
            n = [x for part in batches_of(batch.column("text").to_pylist()) for x in counter.counts(part)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())],
                                             ["doc_id", "n_bytes", "n_tokens"])

    return rows.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")


def chunked(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """rid, seq, start, stop, last and the piece of text, each to a task of its own."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rid, value in zip(batch.column("rid").to_pylist(), batch.column("text")):
                text = value.as_py()
                spans = chunk_spans(len(text), chunk, overlap)
                for k in range(0, len(spans), 64):
                    part = spans[k:k + 64]
                    yield pa.RecordBatch.from_pydict({
                        "rid": pa.array([rid] * len(part), pa.int64()), "seq": pa.array(range(k, k + len(part)), pa.int64()),
                        "start": pa.array([s for s, _ in part], pa.int64()), "last": pa.array([e == len(text) for _, e in part]),
                        "piece": pa.array([text[s:e] for s, e in part], pa.string())})

    pieces = rows.select("rid", "text").mapInArrow(cut, "rid long, seq long, start long, last boolean, piece string")
    return pieces.repartition("rid", "seq")


def seam_rows(pieces: DataFrame, tokenizer_json: str, overlap: int) -> DataFrame:
    """Per chunk its total, and per seam and side the word boundaries in the overlap with the tokens to drop there."""
    shared = pieces.sparkSession.sparkContext.broadcast(tokenizer_json)
    shape = "rid long, seam long, later boolean, total long, at array<long>, drop array<long>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load(shared.value)
        schema = pa.schema([("rid", pa.int64()), ("seam", pa.int64()), ("later", pa.bool_()), ("total", pa.int64()),
                            ("at", pa.list_(pa.int64())), ("drop", pa.list_(pa.int64()))])
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                e = tokenizer.encode(row["piece"], add_special_tokens=False)
                n, size, starts = len(e), len(row["piece"]), word_starts(e)
                head = [(row["start"] + p, k) for p, k in starts if p < overlap] if row["seq"] else []
                tail = [(row["start"] + p, n - k) for p, k in starts if size - overlap <= p <= size - GUARD] if not row["last"] else []
                for seam, later, total, found in ((row["seq"], False, n, tail), (row["seq"] - 1, True, 0, head)):
                    if seam >= 0 and not (later is False and row["last"] and not n):
                        out.append({"rid": row["rid"], "seam": seam if later or not row["last"] else None, "later": later,
                                    "total": total, "at": [p for p, _ in found], "drop": [k for _, k in found]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return pieces.mapInArrow(encode, shape)


def splice(seams: DataFrame) -> DataFrame:
    """rid, n_tokens (null where a seam has no common boundary)."""
    side = lambda later, c: F.max(F.when(F.col("later") == later, F.col(c)))
    totals = seams.groupBy("rid").agg(F.sum("total").alias("total"))
    joined = seams.filter("seam IS NOT NULL").groupBy("rid", "seam").agg(
        side(False, "at").alias("a"), side(False, "drop").alias("a_drop"), side(True, "at").alias("b"), side(True, "drop").alias("b_drop"))
    p = F.array_max(F.array_intersect("a", "b"))
    dropped = joined.withColumn("p", p).withColumn("over", F.when(
        F.col("p").isNotNull(), F.get("a_drop", F.array_position("a", F.col("p")).cast("int") - 1)
        + F.get("b_drop", F.array_position("b", F.col("p")).cast("int") - 1)))
    per_doc = dropped.groupBy("rid").agg(F.sum("over").alias("over"), F.count_if(F.col("over").isNull()).alias("failed"))
    return totals.join(per_doc, "rid", "left").select(
        "rid", F.when(F.coalesce("failed", F.lit(0)) == 0, F.col("total") - F.coalesce("over", F.lit(0))).alias("n_tokens"))


def count_long(rows: DataFrame, tokenizer_json: str, chunk: int, overlap: int) -> DataFrame:
    """rid and n_tokens of long texts (rid, text), widening until every seam holds."""
    done, pending = [], rows
    while not pending.isEmpty():
        # Written first, since splicing reads the seams twice and would encode every chunk twice.
        seams = written(seam_rows(chunked(pending, chunk, overlap), tokenizer_json, overlap), "seams")
        counted = written(splice(seams), "spliced")
        done.append(counted.filter("n_tokens IS NOT NULL"))
        failed = counted.filter("n_tokens IS NULL").select("rid")
        if failed.isEmpty():
            break
        pending, chunk, overlap = rows.join(failed, "rid", "left_semi"), chunk * 4, overlap * 4
    out = rows.sparkSession.createDataFrame([], "rid long, n_tokens long")
    for part in done:
        out = out.unionByName(part)
    return out


def token_counts(docs: DataFrame, tokenizer_json: str, limit: int = 1024, long_chars: int = 1 << 15,
                 chunk_chars: int = 1 << 14, overlap_chars: int = 1 << 10) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; ``tokenizer_json`` is the content of a tokenizer file."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                       F.octet_length(text).cast("long").alias("n_bytes"))
    is_long = F.length("text") > long_chars
    short = count_whole(rows.filter(~is_long), tokenizer_json)
    long_rows = written(rows.filter(is_long).withColumn("rid", F.monotonically_increasing_id()), "long-texts")
    counted = count_long(long_rows.select("rid", "text"), tokenizer_json, chunk_chars, overlap_chars)
    long_counts = long_rows.select("rid", "doc_id", "n_bytes").join(counted, "rid").select("doc_id", "n_bytes", "n_tokens")
    return short.unionByName(long_counts).withColumn("over_limit", F.col("n_tokens") > limit)
