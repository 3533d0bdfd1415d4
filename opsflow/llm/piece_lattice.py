"""SentencePiece encoding and decoding over a relational lattice.

Blanks become the word mark and one mark is put in front; the text is cut into
units wherever no piece has the two characters beside each other (so at every
word's start), since no merge or path can cross there. Each distinct unit is
encoded once:

* its substrings of 2 to the longest piece's length are exploded (no longer ones
  than a piece of the same first three characters has, by a table of hashes),
* equi-joined to the piece table (of the vocabulary's fixed size),
* grouped by unit into an array of edges (rank, start, length),
* and folded by Spark's higher-order ``aggregate`` into the unit's cuts.

The fold. Given a unigram model the best path is the one of the largest score
sum, and ``viterbi_cuts`` folds the edges by end position, keeping each
position's best score and last cut. The public model here is a BPE model, whose
segmentation is defined by merges and differs from the best score sum; so
``merge_cuts`` folds the same edges in rank order: an edge is taken if, at its
turn, it spans just two current symbols. An edge that only becomes possible
after its turn would still span two symbols at the end; such units (none in
300,000 tried) are merged again exactly, best rank first.

Assembly. Tasks pack some ``pack_chars`` of documents each, and for every pack
the distinct units by hash bucket, in order of first use. A bucket encodes its
units once and answers each pack with their ids in that order. A pack's
documents travel as numbers of its units, and are put together from the
answers. So no text is shuffled, and no unit or answer is ever collected.

Decoding joins the pieces' bytes, turns marks into blanks and drops the first;
every document's decoded text is compared with its text by SHA-256.

Defined cases: null and empty texts have no pieces; characters outside the
vocabulary become their UTF-8 byte pieces; a word mark in the text decodes to a
blank, as in the library (``round_trip`` compares with blanks in its place);
units of any length are windowed, so the lattice grows in proportion; repeated
rows are encoded each; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm.common import give_back, trimmed, written

MARK, LINE_END = "▁", "\n"
WINDOW = 256  # characters of a long unit that are exploded at a time
FOLD_CHARS = 512  # longer units are merged by a heap instead of the fold, whose state is copied at each step
START_BITS, LENGTH_BITS = 24, 8
REACH_BITS = 15


def piece_table(model_file: str) -> dict:
    """The model's pieces: ranked normal pieces (rank = place) with ids and scores, byte ids and the bytes of every id."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = sp.vocab_size()
    special = [sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
    normal = sorted((i for i in range(size) if not special[i]), key=lambda i: (-sp.get_score(i), i))
    bytes_of = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else sp.id_to_piece(i).encode()
                for i in range(size)]
    return {"pieces": [sp.id_to_piece(i) for i in normal], "ids": normal, "scores": [sp.get_score(i) for i in normal],
            "byte_ids": [next((i for i in range(size) if sp.is_byte(i) and bytes_of[i] == bytes([b])), sp.unk_id()) for b in range(256)],
            "bytes": bytes_of}


def neighbours(pieces: list[str]) -> tuple[str, bytes]:
    """The characters of all longer pieces, and a bit for each two of them: whether some piece has them in a row."""
    letters = "".join(sorted({c for p in pieces if len(p) > 1 for c in p} - {LINE_END}))
    place = {c: i + 1 for i, c in enumerate(letters)}  # 0 is any other character
    beside = np.zeros((len(letters) + 1, len(letters) + 1), bool)
    pairs = {(place[a], place[b]) for p in pieces for a, b in zip(p, p[1:]) if a != LINE_END != b}
    if pairs:
        beside[tuple(np.array(sorted(pairs)).T)] = True
    return letters, np.packbits(beside).tobytes()


def cut_finder(letters: str, bits: bytes) -> tuple[Callable[[str], np.ndarray], bool]:
    """A function that finds the places between any two characters that no piece has in a row; whether all words' starts are such.

    A word here starts at a mark that follows no mark.
    """
    width = len(letters) + 1
    beside = np.unpackbits(np.frombuffer(bits, np.uint8), count=width * width).astype(bool)
    place = np.zeros(0x110000, np.int32)
    place[np.array(list(map(ord, letters)), np.int64)] = np.arange(1, width)
    before_mark = np.flatnonzero(beside.reshape(width, width)[:, place[ord(MARK)]])

    def cuts_in(shown: str) -> np.ndarray:
        at = place[np.frombuffer(shown.encode("utf-32-le", "surrogatepass"), "<u4")]
        return np.flatnonzero(~beside[at[:-1] * width + at[1:]]) + 1

    return cuts_in, set(before_mark.tolist()) <= {int(place[ord(MARK)])}


def unit_cutter(letters: str, bits: bytes) -> Callable[[str], list[str]]:
    """A function that cuts a text into units, between any two characters that no piece has in a row."""
    cuts_in, _ = cut_finder(letters, bits)

    def units_of(text: str) -> list[str]:
        if not text:
            return []
        shown = MARK + text.replace(" ", MARK)
        cuts = cuts_in(shown).tolist()
        return [shown[a:b] for a, b in zip([0, *cuts], [*cuts, len(shown)])]

    return units_of


def reach_table(pieces: list[str]) -> list[int]:
    """By CRC-32 of three characters, an upper bound of the length of the pieces that begin with them (2: none do)."""
    reach = [2] * (1 << REACH_BITS)
    for p in pieces:
        if len(p) > 2:
            at = zlib.crc32(p[:3].encode()) % len(reach)
            reach[at] = max(reach[at], len(p))
    return reach


def lattice(units: DataFrame, pieces: list[str], keys: list[str]) -> DataFrame:
    """keys, unit, edges: each unit's substrings that are pieces, as sorted numbers rank | start | length.

    ``units`` is partitioned by ``keys`` already, and so is the result.
    """
    spark, longest = units.sparkSession, max(map(len, pieces))
    table = spark.createDataFrame([(p, r) for r, p in enumerate(pieces) if len(p) > 1], "piece string, rank long")
    n = F.length("unit")
    windows = units.withColumn("w", F.explode(F.sequence(F.lit(0), F.floor((n - 1) / WINDOW).cast("int"))))
    windows = windows.withColumn("win", F.substring(F.col("unit"), F.col("w") * WINDOW + 1, F.lit(WINDOW + longest - 1)))
    starts = windows.withColumn("s", F.explode(F.sequence(F.lit(0), F.least(F.lit(WINDOW), F.length("win")) - 1)))
    reach = F.split(F.lit(",".join(map(str, reach_table(pieces)))), ",").cast("array<int>")  # folded to a constant
    first = F.crc32(F.substring(F.col("win"), F.col("s") + 1, F.lit(3)).cast("binary"))
    most = F.least(F.get(reach, (first % (1 << REACH_BITS)).cast("int")), F.length("win") - F.col("s"))
    spans = starts.filter(F.length("win") - F.col("s") >= 2).withColumn("l", F.explode(F.sequence(F.lit(2), most)))
    spans = spans.select(*keys, "unit", (F.col("w") * WINDOW + F.col("s")).cast("long").alias("start"), "l",
                         F.substring(F.col("win"), F.col("s") + 1, F.col("l")).alias("piece"))
    edges = spans.join(F.broadcast(table), "piece")
    packed = F.shiftleft("rank", START_BITS + LENGTH_BITS).bitwiseOR(F.shiftleft("start", LENGTH_BITS)).bitwiseOR(F.col("l").cast("long"))
    return edges.groupBy(*keys, "unit").agg(F.sort_array(F.collect_list(packed)).alias("edges"))


def edge_start(e: Column) -> Column:
    return F.shiftright(e, LENGTH_BITS).bitwiseAND(F.lit((1 << START_BITS) - 1)).cast("int")


def edge_length(e: Column) -> Column:
    return e.bitwiseAND(F.lit((1 << LENGTH_BITS) - 1)).cast("int")


def merge_cuts(unit: Column, edges: Column) -> Column:
    """BPE: cuts of the unit (0 and its length included), edges taken in rank order where they span two symbols."""
    def take(cut: Column, e: Column) -> Column:
        at = F.array_position(cut, edge_start(e)).cast("int")  # 1-based, 0 if not a cut
        spans_two = (at > 0) & (F.get(cut, at + 1) == edge_start(e) + edge_length(e))
        return F.when(spans_two, F.array_remove(cut, F.get(cut, at))).otherwise(cut)

    return F.aggregate(edges, F.sequence(F.lit(0), F.length(unit)), take)


def viterbi_cuts(unit: Column, edges: Column) -> Column:
    """Unigram: cuts of the path with the largest score sum.

    ``edges`` are structs (stop, start, score) sorted by stop, and must hold an
    edge for every single character. The state is, per position, the best score
    and the cuts that lead to it; of equal scores the earlier edge stays.
    """
    state = "array<struct<score:double,cuts:array<int>>>"

    def extend(best: Column, e: Column) -> Column:
        before = F.get(best, e["start"])
        new = F.struct((before["score"] + e["score"]).alias("score"), F.concat(before["cuts"], F.array(e["stop"])).alias("cuts"))
        old = F.get(best, e["stop"])
        return F.when(old.isNull(), F.concat(best, F.array(new))).when(
            new["score"] > old["score"], F.concat(F.slice(best, F.lit(1), e["stop"]), F.array(new))).otherwise(best)

    first = F.array(F.struct(F.lit(0.0).alias("score"), F.array(F.lit(0)).alias("cuts"))).cast(state)
    return F.get(F.aggregate(edges, first, lambda a, e: extend(a, e).cast(state)), F.length(unit))["cuts"]


def merged_exactly(unit: str, rank: dict[str, int]) -> list[int]:
    """Cuts of a unit by merging the best-ranked adjacent pair, leftmost first, until none is a piece."""
    n = len(unit)
    stop, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []
    alive = [True] * n

    def offer(a: int) -> None:
        b = stop[a]
        if b < n:
            r = rank.get(unit[a:stop[b]])
            if r is not None:
                heapq.heappush(heap, (r, a, stop[b]))

    for a in range(n):
        offer(a)
    while heap:
        _, a, end = heapq.heappop(heap)
        if not alive[a] or stop[a] >= n or stop[stop[a]] != end or unit[a:end] not in rank:
            continue
        b = stop[a]
        alive[b], stop[a] = False, end
        if end < n:
            before[end] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    return [a for a in range(n) if alive[a]] + [n]


def ids_of(unit: str, cuts: list[int], table: dict, rank: dict[str, int]) -> list[int]:
    """Piece ids of a unit; bytes of characters outside the vocabulary. The cuts are checked: no pair left may be a piece."""
    for a, c in zip(cuts, cuts[2:]):
        if unit[a:c] in rank:
            cuts = merged_exactly(unit, rank)
            break
    out = []
    for a, b in zip(cuts, cuts[1:]):
        r = rank.get(unit[a:b])
        if r is not None:
            out.append(table["ids"][r])
        else:
            out += [table["byte_ids"][x] for x in unit[a:b].encode("utf-8", "surrogatepass")]
    return out


def shown_lengths(cuts: Column) -> Column:
    """Cuts as a string, one character per symbol's length (a symbol has at most the longest piece's characters)."""
    steps = F.zip_with(cuts, F.slice(cuts, F.lit(2), F.size(cuts) - 1), lambda a, b: F.char(F.lit(48) + b - a))
    return F.array_join(steps, "")


def cuts_of(lengths: str) -> list[int]:
    from itertools import accumulate

    return list(accumulate((x - 48 for x in lengths.encode()), initial=0))


def zipped(data: bytes, level: int = 3) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=level).compress(data)


def unzipped(data: bytes) -> bytes:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(data)


def words_of(text: str) -> list[str]:
    """The text's words with their marks, less the first mark of each: marks in a row belong to one word."""
    if not text:
        return []
    shown = text.replace(" ", MARK)
    if MARK * 2 in shown or shown[0] == MARK:
        return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", MARK + shown)]
    return shown.split(MARK)


def units_of_words(words: list[str], cuts_in: Callable[[str], np.ndarray]) -> tuple[dict[str, int], np.ndarray, np.ndarray]:
    """Units numbered in order of first use, the line end before all; numbers of the words' units in a row; how many each has."""
    shown = MARK + MARK.join(words) if words else ""
    starts = np.cumsum([0, *map(len, words)]) + np.arange(len(words) + 1)  # each word has its mark in front
    cut = np.zeros(len(shown) + 1, bool)
    cut[starts] = True
    if words:
        cut[cuts_in(shown)] = True
    places = np.flatnonzero(cut).tolist()
    numbers: defaultdict[str, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    numbers[LINE_END]
    used = np.fromiter((numbers[shown[a:b]] for a, b in zip(places, places[1:])), np.uint32, len(places) - 1)
    numbers.default_factory = None  # a method of the dict itself, and so a cycle, would hold it until Python next looks for cycles
    return numbers, used, np.diff(np.cumsum(cut)[starts])


def distinct_units(texts: list[str], finder: tuple[Callable[[str], np.ndarray], bool]) -> list[str]:
    """The distinct units in order of first use, the line end before all. Each distinct word is cut once."""
    cuts_in, by_word = finder
    words: dict[str, None] = {}
    for t in texts:
        words.update(dict.fromkeys(words_of(t) if by_word else [t.replace(" ", MARK)] if t else []))
    return list(units_of_words(list(words), cuts_in)[0])


def numbered_units(texts: list[str], finder: tuple[Callable[[str], np.ndarray], bool]) -> tuple[list[str], list[np.ndarray]]:
    """The distinct units as ``distinct_units`` has them, and each text's units as numbers of that list."""
    cuts_in, by_word = finder
    words: defaultdict[str, int] = defaultdict()
    words.default_factory = words.__len__
    of_text = [np.fromiter(map(words.__getitem__, words_of(t) if by_word else [t.replace(" ", MARK)] if t else []), np.uint32) for t in texts]
    words.default_factory = None  # no cycle, as above
    numbers, units, n_units = units_of_words(list(words), cuts_in)
    first = np.cumsum(n_units) - n_units
    used = []
    for ws in of_text:
        n = n_units[ws]
        used.append(units[np.arange(n.sum()) + np.repeat(first[ws] - (np.cumsum(n) - n), n)])
    return list(numbers), used


def dealt_to(units: list[str], buckets: int) -> np.ndarray:
    """Hash bucket of each unit."""
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(u.encode("utf-8", "surrogatepass")) % buckets for u in units], np.uint32)


def shown_numbers(numbers: np.ndarray) -> bytes:
    """Numbers of first use, compressed: 0 where a number is used first, else one more than it; bytes of equal weight together."""
    seen = np.maximum.accumulate(np.concatenate([np.zeros(1, np.uint32), numbers]))[:-1]
    codes = np.where(numbers > seen, 0, numbers + 1).astype("<u4")
    return zipped(codes.view(np.uint8).reshape(-1, 4).T.tobytes(), 6)


def numbers_of(data: bytes) -> np.ndarray:
    """The inverse of ``shown_numbers``."""
    codes = np.ascontiguousarray(np.frombuffer(unzipped(data), np.uint8).reshape(4, -1).T).view("<u4").ravel()
    first = codes == 0
    return np.where(first, np.cumsum(first), codes.astype(np.int64) - 1)


def packs(batches: Iterator[pa.RecordBatch], pack_chars: int) -> Iterator[tuple[int, list[int], list[str]]]:
    """(pack id, doc ids, texts): successive documents of about ``pack_chars`` characters; the id hashes them.

    The lists are emptied when the next pack is asked for, so the texts of one pack are held at a time.
    """
    import xxhash

    ids, texts, size, h = [], [], 0, xxhash.xxh3_64()
    for batch in batches:
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = value.as_py()
            ids.append(doc_id)
            texts.append(text)
            h.update(f"{doc_id}\0{len(text)}\0".encode() + text.encode("utf-8", "surrogatepass"))
            size += len(text) + 16
            if size >= pack_chars:
                yield h.intdigest() - (1 << 63), ids, texts
                ids.clear()
                texts.clear()
                ids, texts, size, h = [], [], 0, xxhash.xxh3_64()
    if ids:
        yield h.intdigest() - (1 << 63), ids, texts


def pack_units(docs: DataFrame, cutting: Broadcast, buckets: int, pack_chars: int) -> DataFrame:
    """bucket, pack, listing: each pack's distinct units by hash bucket in order of first use, divided by line ends."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = cut_finder(*cutting.value)

        def listed(pack: int, texts: list[str]) -> pa.RecordBatch:
            units = distinct_units(texts, finder)[1:]  # the line end is never a piece
            lists: dict[int, list[str]] = {}
            for u, b in zip(units, dealt_to(units, buckets).tolist()):
                lists.setdefault(b, []).append(u)
            return pa.RecordBatch.from_pydict({
                "bucket": pa.array(list(lists), pa.int64()), "pack": pa.array([pack] * len(lists), pa.int64()),
                "listing": pa.array([LINE_END.join(us) for us in lists.values()], pa.string())})

        for pack, _, texts in packs(batches, pack_chars):
            yield listed(pack, texts)

    return docs.mapInArrow(trimmed(scan), "bucket long, pack long, listing string")


def pack_numbers(docs: DataFrame, cutting: Broadcast, buckets: int, pack_chars: int) -> DataFrame:
    """pack, docs, numbers, dealt: the packs' documents as unit numbers, and the bucket of each unit but the line end."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        finder = cut_finder(*cutting.value)

        def numbered(pack: int, ids: list[int], texts: list[str]) -> pa.RecordBatch:
            units, used = numbered_units(texts, finder)
            digests = [hashlib.sha256(t.replace(MARK, " ").encode("utf-8", "surrogatepass")).digest() for t in texts]
            part = pa.table({"doc_id": pa.array(ids, pa.int64()), "n_units": pa.array(map(len, used), pa.int64()),
                             "sha256": pa.array(digests, pa.binary())})
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema) as w:
                w.write_table(part)
            return pa.RecordBatch.from_pydict({
                "pack": pa.array([pack], pa.int64()), "docs": pa.array([zipped(sink.getvalue().to_pybytes())], pa.binary()),
                "numbers": pa.array([shown_numbers(np.concatenate(used))], pa.binary()),
                "dealt": pa.array([zipped(dealt_to(units[1:], buckets).tobytes())], pa.binary())})

        for pack, ids, texts in packs(batches, pack_chars):
            yield numbered(pack, ids, texts)

    return docs.mapInArrow(trimmed(scan), "pack long, docs binary, numbers binary, dealt binary")


def answer_packs(docs: DataFrame, table: dict, cutting: Broadcast, buckets: int, pack_chars: int) -> DataFrame:
    """pack, bucket, ids: for each unit of a pack's bucket its number of ids and the ids; written to the shared folder."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(table)
    lists = pack_units(docs, cutting, buckets, pack_chars).repartition(buckets, "bucket")
    # Everything up to the answers stays in the partitions that the buckets were dealt to. Naming the pack
    # here keeps that column, so that both uses of the lists are one and the same exchange.
    listing = F.when(F.col("pack").isNotNull(), F.col("listing"))
    units = lists.select(F.col("bucket").alias("of_bucket"), F.explode(F.split(listing, LINE_END)).alias("unit")).distinct()
    folded = lattice(units.filter(F.length("unit") <= FOLD_CHARS), table["pieces"], ["of_bucket"])
    folded = folded.select("of_bucket", "unit", shown_lengths(merge_cuts(F.col("unit"), F.col("edges"))).alias("lengths"))
    number = np.uint16 if len(table["bytes"]) < 1 << 16 else np.uint32

    def answer(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        t = shared.value
        rank = {p: r for r, p in enumerate(t["pieces"])}
        lengths, out = dict(zip(right["unit"], right["lengths"])), []

        class Known(dict):
            def __missing__(self, u: str) -> bytes:
                shown = lengths.get(u)
                # A short unit without an edge is cut at every character.
                cuts = cuts_of(shown) if shown is not None else list(range(len(u) + 1)) if len(u) <= FOLD_CHARS else merged_exactly(u, rank)
                ids = self[u] = np.array(ids_of(u, cuts, t, rank), number).tobytes()
                return ids

        known = Known()
        for pack, bucket, listing in zip(left["pack"], left["bucket"], left["listing"]):
            found = [known[u] for u in listing.split(LINE_END)]
            counts = np.fromiter(map(len, found), np.uint32) // number().itemsize
            out.append((pack, bucket, zipped(counts.tobytes()), zipped(b"".join(found))))
        known.clear()
        lengths.clear()
        give_back()
        return pd.DataFrame(out, columns=["of_pack", "bucket", "counts", "ids"])

    answers = lists.groupBy("bucket").cogroup(folded.groupBy("of_bucket")).applyInPandas(
        answer, "of_pack long, bucket long, counts binary, ids binary")
    # Grouping the edges in a hash map: a task's units fit in memory many times over, and sorting them costs far more.
    setting = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, 1 << 20)
    try:
        return written(answers, "answers")
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)


def encode(docs: DataFrame, table: dict, buckets: int | None = None, pack_chars: int = 8 << 20) -> DataFrame:
    """One row per document: doc_id, n_pieces, piece_ids (blank-separated), decoded_sha256, round_trip."""
    spark: SparkSession = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    buckets = buckets or max(3 * int(spark.conf.get("spark.sql.shuffle.partitions")), rows.count() // 1024)
    cutting = spark.sparkContext.broadcast(neighbours(table["pieces"]))
    answers = answer_packs(rows, table, cutting, buckets, pack_chars)
    shared = spark.sparkContext.broadcast((table["bytes"], table["byte_ids"][ord(LINE_END)]))
    number = np.uint16 if len(table["bytes"]) < 1 << 16 else np.uint32
    shape = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("piece_ids", pa.string()),
                       ("decoded_sha256", pa.string()), ("round_trip", pa.bool_())])

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        import hashlib

        bytes_of, line_end = shared.value
        as_bytes, as_text = pa.array(bytes_of, pa.binary()), pa.array(map(str, range(len(bytes_of))), pa.string())
        given = {r["bucket"]: r for r in right.to_pylist()}
        answered = [given[b] for b in sorted(given)]  # the order of a stable sort by bucket
        counts = np.concatenate([np.frombuffer(unzipped(r["counts"]), np.uint32) for r in answered] + [np.zeros(0, np.uint32)]).astype(np.int64)
        ids = np.concatenate([np.frombuffer(unzipped(r["ids"]), number) for r in answered] + [np.array([line_end], number)]).astype(np.int32)
        out = []
        for row in left.to_pylist():
            order = np.argsort(np.frombuffer(unzipped(row["dealt"]), np.uint32), kind="stable") + 1
            if len(order) != len(counts):
                raise ValueError(f"pack {row['pack']}: {len(counts)} answers to {len(order)} units")
            count, start = np.ones(len(order) + 1, np.int64), np.full(len(order) + 1, len(ids) - 1, np.int64)
            count[order], start[order] = counts, np.cumsum(counts) - counts
            part = pa.ipc.open_stream(unzipped(row["docs"])).read_all()
            used = numbers_of(row["numbers"])
            ends = np.cumsum(np.append(0, count[used]))  # in pieces, by unit
            places = np.arange(ends[-1]) + np.repeat(start[used] - ends[:-1], count[used])
            taken = pa.array(ids[places])
            limits = ends[np.cumsum(np.append(0, part.column("n_units").to_numpy()))]  # in pieces, by document
            offsets = pa.array(limits, pa.int32())
            texts = pc.binary_join(pa.ListArray.from_arrays(offsets, as_bytes.take(taken)), b"").to_pylist()
            digests = [hashlib.sha256(t.decode("utf-8", "replace").replace(MARK, " ")[1:].encode()).digest() for t in texts]
            out.append(pa.table([
                part.column("doc_id"), pa.array(np.diff(limits)), pc.binary_join(pa.ListArray.from_arrays(offsets, as_text.take(taken)), " "),
                pa.array([d.hex() for d in digests], pa.string()),
                pa.array([d == w for d, w in zip(digests, part.column("sha256").to_pylist())], pa.bool_())], schema=shape))
        give_back()
        return pa.concat_tables(out) if out else shape.empty_table()

    return pack_numbers(rows, cutting, buckets, pack_chars).groupBy("pack").cogroup(answers.groupBy("of_pack")).applyInArrow(
        assemble, "doc_id long, n_pieces long, piece_ids string, decoded_sha256 string, round_trip boolean")
