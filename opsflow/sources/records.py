"""Records of delimited text files, read in byte ranges (A2).

A quoted field may hold line ends, so where a record starts in the middle of a
file depends on all the text before it. Spark reads files in ranges of whole lines;
here every range is told from two bits whether it starts inside a quoted field:

1. Tasks cut their ranges into records, each from the state that its first lines look like, and
   say with what state it began and ended. Per file these are chained in range order (one row per range); files of
   one range need no chain. Where every range began as the one before it ended, the cut stands.
2. Else each task maps both possible states at its range's start (outside, inside a
   quoted field) to the state at its end. For well-formed text that is the
   parity of its quotes; a stray quote inside an unquoted field, which is
   plain text, is respected too. These maps are chained alike, which gives
   each range's true start, and the ranges are cut once more from there.
3. A record that crosses a border
   leaves its parts in several ranges; only those parts are shuffled, by the
   range in which their record starts, and joined.

Records end at ``\\n``, ``\\r\\n`` or ``\\r`` outside quotes; empty ones are dropped. Fields follow the rules of
Python's csv module (doubled quotes, text after a closing quote kept); quotes left open end with the file, without its
last line end. Bytes that are not UTF-8 are flagged, never
replaced silently.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.csv as pacsv
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files, literal

RECORDS_DDL = "path string, block bigint, pos bigint, fields array<string>, valid boolean, width int"
MAP_DDL = "from_out boolean, from_in boolean, ends boolean"
# ``joined``: fields in one text with BETWEEN, which none of them holds, in place of ``fields``; it costs a third of the list to write.
CUT_DDL = RECORDS_DDL + ", joined string, part string, owner bigint, " + MAP_DDL
BETWEEN = "\x1f"
UNTOLD = -1  # owner of what begins a range that is taken to start inside a field
LOOK = 100  # lines at least, if a range has them, by which its start is judged
# Ranges that start inside a field are known to every task (some 100 bytes each); beyond this many, ranges are made larger.
MAX_STARTS = 500_000
TASK_BYTES = 32 << 20  # small ranges are read many to a task, one after the other
_BOM = b"\xef\xbb\xbf"


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """value (bytes up to the next line feed), path, block (offset of the range that holds the line's start), in file order."""
    text = spark.read.format("text").option("lineSep", "\n").load([literal(p) for p in paths])
    return text.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_block_start").alias("block"))


def ends_inside(text: str, inside: bool, sep: str) -> bool:
    """Whether ``text`` leaves a quoted field open, given whether it starts in one."""
    at = 0
    while True:
        quote = text.find('"', at)
        if quote < 0:
            return inside
        if inside:
            if text.startswith('"', quote + 1):
                at = quote + 2
                continue
            inside = False
        elif quote == at or text[quote - 1] == sep:  # ``at`` is always a field's start here
            inside, at = True, quote + 1
            continue
        # The rest of this field is plain text, quotes included.
        end = text.find(sep, quote + 1)
        if end < 0:
            return False
        at = end + 1


def pieces(line: bytes, first: bool) -> list[tuple[str, str, bool]]:
    """The line's parts between lone carriage returns: (text, what joins it to the next, is UTF-8)."""
    if first and line.startswith(_BOM):
        line = line[len(_BOM):]
    try:
        text, valid = line.decode(), True
    except UnicodeDecodeError:
        text, valid = line.decode(errors="replace"), False
    body, end = (text[:-1], "\r") if text.endswith("\r") else (text, "")  # a final carriage return belongs to the line end
    *parts, last = body.split("\r")
    return [(p, "\r", valid) for p in parts] + [(last + end, "\n", valid)]


def _by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Array, bool]]:
    """((path, block), lines, whether they are the range's first) of each stretch of one range in a batch.

    A range's first lines come LOOK at a time or more, if it has as many.
    """
    at, held = None, None
    for b in batches:
        if not b.num_rows:
            continue
        values, path, block = b.column(0), b.column(1), b.column(2)
        key = lambda i: (path[i].as_py(), block[i].as_py())
        borders = []
        if key(0) != key(len(values) - 1):
            other = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(block[1:], block[:-1]))
            borders = (np.flatnonzero(other.to_numpy(zero_copy_only=False)) + 1).tolist()
        for start, stop in zip([0, *borders], [*borders, len(values)]):
            now, lines_ = key(start), values[start:stop]
            if held is not None and now != at:
                yield at, held, True
                held = None
            first, at = held is not None or now != at, now
            if held is not None:
                lines_, held = pa.concat_arrays([held, lines_]), None
            if first and stop == len(values) and len(lines_) < LOOK:
                held = lines_
            else:
                yield at, lines_, first
    if held is not None:
        yield at, held, True


def joined(lines_: pa.Array) -> bytes:
    """The lines as one text, with a line feed after each."""
    if lines_.nbytes > 1 << 30:  # with the line feeds it may be more than one Arrow value holds
        return b"\n".join([*lines_.to_pylist(), b""])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(lines_)], pa.int32()), lines_), b"\n")[0].as_py() + b"\n"


def quotes_told(text: bytes, inside: bool, sep: int) -> np.ndarray | None:
    """Where the quotes of ``text``, from a line's start, are; None if counting them does not tell the state after each.

    Where every quote that opens a field is at a field's start or doubles the one before it, the state is their parity.
    """
    chars = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(chars == ord('"'))
    opening = quotes[int(inside)::2]
    before = chars[opening - 1]  # of a quote at the very start, whatever is last: see below
    fits = (before == sep) | (before == ord("\n")) | (before == ord("\r")) | (opening == 0)
    doubled = np.flatnonzero(~fits) * 2 + int(inside)
    if len(doubled) and (doubled[0] == 0 or (quotes[doubled] - quotes[doubled - 1] != 1).any()):
        return None
    return quotes


def state_after(text: bytes, inside: bool, sep: int) -> bool | None:
    """Whether ``text``, from a line's start, leaves a quoted field open; None if counting its quotes does not tell."""
    quotes = quotes_told(text, inside, sep)
    return None if quotes is None else inside ^ bool(len(quotes) % 2)


def looks_inside(lines_: pa.Array, sep: str) -> bool:
    """Whether the lines are well-formed only if they start inside a quoted field."""
    if not sep.isascii():
        return False
    text = joined(lines_)
    return quotes_told(text, False, ord(sep)) is None and quotes_told(text, True, ord(sep)) is not None


def _maps(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[list] = []
        for (path, block), lines_, first in _by_range(batches):
            if first:
                rows.append([path, block, False, True, False])
            row = rows[-1]
            for i in range(len(lines_)):
                if row[2] == row[3] and row[4] and sep.isascii():  # one state to follow, and a record's end was seen
                    state = state_after(joined(lines_[i:]), row[2], ord(sep))
                    if state is not None:
                        row[2] = row[3] = state
                        break
                    for line in lines_[i:].to_pylist():
                        _follow(row, line, False, sep)
                    break
                _follow(row, lines_[i].as_py(), first and i == 0 and block == 0, sep)
        yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*rows) if rows else [[]] * 5, (pa.string(), pa.int64(), *[pa.bool_()] * 3))],
                              ["path", "block", "from_out", "from_in", "ends"])
    return run


def _follow(row: list, line: bytes, first: bool, sep: str) -> None:
    """Take the states of ``row`` (path, block, from_out, from_in, ends) on by one line."""
    for text, _, _ in pieces(line, first):
        if '"' in text:
            same = row[2] == row[3]  # from then on there is one state to follow
            row[2] = ends_inside(text, row[2], sep)
            row[3] = row[2] if same else ends_inside(text, row[3], sep)
        row[4] |= not row[3]


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges that start inside a field, with their owners; of a file in which a range was cut from a wrong start, that range without one."""
    out: list[tuple] = []
    for b in batches:
        for path, ranges in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            inside, owner = False, None
            for r in ranges:
                after = r["from_in"] if inside else r["from_out"]
                if after is None:
                    out.append((path, r["block"], None))
                    break
                if inside:
                    out.append((path, r["block"], owner))
                before, inside = inside, after
                if not before or r["ends"]:
                    owner = r["block"]
    yield pa.record_batch([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 3, (pa.string(), pa.int64(), pa.int64()))],
                          ["path", "block", "owner"])


def chained(maps: DataFrame) -> DataFrame:
    """path, block, owner of the ranges of ``_chain``. ``maps``: path, block and what MAP_DDL names, a row a range."""
    ranges = maps.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("block", "from_out", "from_in", "ends"))).alias("ranges"))
    return ranges.mapInArrow(_chain, "path string, block bigint, owner bigint")


def inside_starts(spark: SparkSession, paths: list[str], sep: str, tasks: int) -> DataFrame:
    """Ranges that start inside a quoted field: path, block, and the block in which that record starts."""
    return chained(lines(spark, paths).coalesce(tasks).mapInArrow(_maps(sep), "path string, block bigint, " + MAP_DDL))


def whole_records(lines_: list[bytes], sep: str) -> tuple[list[list[str]], list[bool], int] | None:
    """Records of lines that begin with one: fields of each that ends there, whether it is UTF-8, how many lines they take.

    The csv module finds the records' ends itself; only the last is looked at again, since it may go on. None if the
    lines hold lone carriage returns, which end records too.
    """
    data = b"\n".join(lines_) + b"\n"
    bad: set[int] = set()
    try:
        text = data.decode()
    except UnicodeDecodeError:
        text = data.decode(errors="replace")
        bad = {i for i, line in enumerate(lines_) if not pieces(line, False)[0][2]}
    if "\r" in text and "\r" in text.replace("\r\n", "\n"):
        return None
    rows: list[list[str]] = []
    valid: list[bool] = []
    start = done = 0
    reader = csv.reader(io.StringIO(text, newline="\n"), delimiter=sep)
    for row in reader:
        start, done = done, reader.line_num
        if row:  # an empty line is no record
            rows.append(row)
            if bad:
                valid.append(bad.isdisjoint(range(start, done)))
    if ends_inside(b"\n".join(lines_[start:]).decode(errors="replace"), False, sep):
        rows.pop()
        del valid[len(rows):]
        done = start
    return rows, valid if bad else [True] * len(rows), done


def plain_records(lines_: pa.Array, sep: str) -> tuple[pa.StringArray, int, int] | None:
    """As ``whole_records``, by Arrow's reader: fields of each record with BETWEEN, their number, how many lines are taken; None if the text is not plain.

    Plain text is UTF-8, has quotes only around fields and doubled inside them, as many fields in every record, no
    lone carriage returns and no BETWEEN. Both readers cut such text alike.
    """
    if not sep.isascii():
        return None
    text, taken = joined(lines_), len(lines_)
    quotes = quotes_told(text, False, ord(sep))
    if quotes is None or text.startswith(_BOM) or BETWEEN.encode() in text or text.count(b"\r") != text.count(b"\r\n"):
        return None
    if len(quotes) % 2:  # the last record goes on
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == ord("\n"))
        outside = np.flatnonzero(np.searchsorted(quotes, ends) % 2 == 0)
        if not len(outside):
            return None
        taken = int(outside[-1]) + 1
        text = text[:ends[outside[-1]] + 1]
    try:
        width = len(next(filter(None, csv.reader((x.as_py().decode() + "\n" for x in lines_), delimiter=sep)), []))
        if width < 2:
            return None
        names = [str(i) for i in range(width)]
        table = pacsv.read_csv(
            pa.py_buffer(text), pacsv.ReadOptions(use_threads=False, block_size=len(text) + 1, column_names=names),
            pacsv.ParseOptions(delimiter=sep, newlines_in_values=True),
            pacsv.ConvertOptions(column_types={c: pa.string() for c in names}, strings_can_be_null=False))
    except (UnicodeDecodeError, pa.ArrowException):
        return None
    return pc.binary_join_element_wise(*[c.combine_chunks() for c in table.columns], BETWEEN), width, taken


def _cut(sep: str, starts: Broadcast | None):
    """Cut ranges into records; without ``starts`` (owners of the ranges that start inside a field) from the starts that they look to have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        names = ["path", "block", "pos", "fields", "valid", "width", "joined", "part", "owner", "from_out", "from_in", "ends"]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.int64(),
                 *[pa.bool_()] * 3)

        def one(*row) -> pa.RecordBatch:
            return pa.record_batch([pa.array([x], k) for x, k in zip(row, kinds)], names)

        def whole(at: tuple, n: int, fields: pa.Array, valid: pa.Array, width: pa.Array, joined_: pa.Array) -> pa.RecordBatch:
            pos, state["pos"] = state["pos"], state["pos"] + n
            return pa.record_batch([pa.repeat(pa.scalar(at[0], pa.string()), n), pa.repeat(pa.scalar(at[1], pa.int64()), n),
                                    pa.array(np.arange(pos, pos + n)), fields, valid, width, joined_, pa.nulls(n, pa.string()),
                                    pa.repeat(pa.scalar(at[1], pa.int64()), n), *[pa.nulls(n, pa.bool_())] * 3], names)

        def plain(at: tuple, texts: pa.Array, width: int) -> pa.RecordBatch:
            n = len(texts)
            return whole(at, n, pa.nulls(n, kinds[3]), pa.repeat(True, n), pa.repeat(pa.scalar(width, pa.int32()), n), texts)

        def listed(at: tuple, rows: list[list[str]], valid: list[bool]) -> pa.RecordBatch:
            ends = np.cumsum([0, *map(len, rows)])
            fields = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(list(chain.from_iterable(rows)), pa.string()))
            return whole(at, len(rows), fields, pa.array(valid, pa.bool_()), pc.list_value_length(fields), pa.nulls(len(rows), pa.string()))

        def part(at: tuple, pos: int, text: str) -> pa.RecordBatch:
            return one(*at, pos, None, state["valid"], None, None, text, state["owner"], None, None, None)

        def close(at: tuple) -> Iterator[pa.RecordBatch]:
            # What is open when a range ends goes on in the next one, or ends with the file.
            if state["open"]:
                yield part(at, state["pos"], "".join(state["open"]))
            if starts is None:
                began, after = state["began"], state["inside"]
                yield one(*at, *[None] * 7, None if began else after, after if began else None, state["owner"] == at[1])

        def by_line(at: tuple, lines_: Iterable[bytes], first: bool, until_whole: bool) -> Iterator[pa.RecordBatch]:
            """Take lines, up to the first that ends a record if ``until_whole``; ``state["taken"]`` says how many."""
            records: list[str] = []
            valid: list[bool] = []
            state["taken"] = 0
            for line in lines_:
                state["taken"] += 1
                for text, joint, ok in pieces(line, first):
                    state["inside"] = ends_inside(text, state["inside"], sep) if '"' in text else state["inside"]
                    state["open"].append(text)
                    state["valid"] &= ok
                    if state["inside"]:
                        state["open"].append(joint)
                        continue
                    record = "".join(state["open"]).removesuffix("\r")
                    if state["owner"] != at[1]:  # the end of an earlier range's record
                        yield part(at, 0, record)
                    elif record or not state["valid"]:
                        records.append(record)
                        valid.append(state["valid"])
                    state.update(open=[], valid=True, owner=at[1])
                first = False
                if until_whole and not state["open"]:
                    break
            if records:
                yield listed(at, list(csv.reader(records, delimiter=sep)), valid)

        csv.field_size_limit(2**31 - 1)
        last = None
        for at, lines_, first in _by_range(batches):
            if first:
                if last is not None:
                    yield from close(last)
                last = at
                if starts is not None:
                    owner = starts.value.get(at)
                else:
                    owner = UNTOLD if at[1] > 0 and looks_inside(lines_, sep) else None
                state = {"open": [], "began": owner is not None, "inside": owner is not None, "owner": at[1] if owner is None else owner,
                         "valid": True, "pos": 0}
            # The rest of an open record, or a file's first line, which may have a byte order mark; then whole records at once.
            head = first and at[1] == 0
            if head or state["inside"] or state["open"]:
                yield from by_line(at, (x.as_py() for x in lines_), head, True)
                lines_ = lines_[state["taken"]:]
            if not len(lines_):
                continue
            if told := plain_records(lines_, sep):
                texts, width, taken = told
                yield plain(at, texts, width)
                yield from by_line(at, lines_[taken:].to_pylist(), False, False)
                continue
            lines_ = lines_.to_pylist()
            found = whole_records(lines_, sep)
            if found is None:
                yield from by_line(at, lines_, False, False)
                continue
            rows, valid, taken = found
            if rows:
                yield listed(at, rows, valid)
            yield from by_line(at, lines_[taken:], False, False)
        if last is not None:
            yield from close(last)
    return run


def _joined(sep: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(2**31 - 1)
        for b in batches:
            # One reader each: the last record of a file may leave its quotes open. It then ends before the file's last line end.
            rows = [next(csv.reader([r.removesuffix("\n")], delimiter=sep), []) for r in b.column(4).to_pylist()]
            fields = pa.array(rows, pa.list_(pa.string()))
            yield pa.record_batch([*b.columns[:3], fields, b.column(3), pc.list_value_length(fields)],
                                  ["path", "block", "pos", "fields", "valid", "width"])
    return run


@contextmanager
def _fixed_ranges(spark: SparkSession, max_bytes: str) -> Iterator[None]:
    """Files are cut alike by every scan of the same files, even if executors come or go in between."""
    fixed = {"spark.sql.files.maxPartitionBytes": max_bytes, "spark.sql.files.minPartitionNum": str(spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k, None) for k in fixed}
    try:
        for k, v in fixed.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _one_range_each(spark: SparkSession, size: list[int], max_bytes: int) -> bool:
    """Whether Spark will read every file as one range (its rule for the size of a range, with the settings as they are)."""
    cost = _bytes(spark, spark.conf.get("spark.sql.files.openCostInBytes"))
    per_core = sum(x + cost for x in size) // max(1, int(spark.conf.get("spark.sql.files.minPartitionNum")))
    return max(size) <= min(max_bytes, max(cost, per_core))


def _bytes(spark: SparkSession, setting: str) -> int:
    return int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting))


def records(spark: SparkSession, paths: list[str], stage: str, sep: str = ",", range_bytes: int | None = None) -> DataFrame:
    """All records of ``paths``: path, block and pos (order within a file), fields, whether its bytes are UTF-8, number of fields.

    Runs at once and keeps the records as Parquet in the folder ``stage``, so raw text is read once (three times if a
    file is larger than a range and a range does not look like what it is). ``range_bytes``: the most bytes of a range, by default what the
    session says.
    """
    max_bytes = range_bytes or _bytes(spark, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = Files(spark, paths[0]).sizes(paths)
    # As many tasks as the text needs, however small its ranges; a task that already has more to read is left as it is.
    tasks = max(spark.sparkContext.defaultParallelism, -(-sum(size) // TASK_BYTES))

    def cut_from(starts: Broadcast | None) -> None:
        lines(spark, paths).coalesce(tasks).mapInArrow(_cut(sep, starts), CUT_DDL).write.mode("error" if starts is None else "overwrite").parquet(stage)

    cut = spark.read.schema(CUT_DDL).format("parquet")
    with _fixed_ranges(spark, f"{max_bytes}b"):
        cut_from(None)
        one_each = _one_range_each(spark, size, max_bytes)
    told = [] if one_each else chained(cut.load(literal(stage)).filter("ends IS NOT NULL").select("path", "block", "from_out", "from_in", "ends")
                                       ).limit(MAX_STARTS + 1).collect()
    if len(told) > MAX_STARTS or any(r.owner is None for r in told):
        told = []
        while True:
            with _fixed_ranges(spark, f"{max_bytes}b"):
                starts = inside_starts(spark, paths, sep, tasks).limit(MAX_STARTS + 1).collect()
                if len(starts) > MAX_STARTS:
                    max_bytes *= 4  # fewer ranges
                    continue
                # At most MAX_STARTS small entries, looked up once a range.
                cut_from(spark.sparkContext.broadcast({(r.path, r.block): r.owner for r in starts}))
                break
    staged = cut.load(literal(stage))
    fields = F.coalesce("fields", F.split("joined", BETWEEN)).alias("fields")
    within = staged.filter("part IS NULL AND ends IS NULL").select("path", "block", "pos", fields, "valid", "width")
    parts = staged.filter("part IS NOT NULL").select("path", "block", "pos", "valid", "part", "owner")
    if parts.isEmpty():
        return within
    if told:  # at most MAX_STARTS small rows
        known = spark.createDataFrame([(r.path, r.block, r.owner) for r in told], "_path string, _block bigint, _owner bigint")
        owner = F.when(F.col("owner") == UNTOLD, F.col("_owner")).otherwise(F.col("owner"))
        parts = parts.join(known, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block")), "left").withColumn("owner", owner)
    whole = (parts.groupBy("path", "owner").agg(
        F.min_by("pos", "block").alias("pos"), F.bool_and("valid").alias("valid"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "part"))), lambda x: x["part"]), "").alias("part"))
        .select("path", F.col("owner").alias("block"), "pos", "valid", "part"))
    return within.unionByName(whole.mapInArrow(_joined(sep), RECORDS_DDL))
