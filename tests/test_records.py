"""Records read in ranges against Python's csv module, with quoted line ends, stray quotes and bad bytes."""
import csv
import io
import os
import random

import pyarrow as pa
import pytest

from opsflow.sources import records as R

SIZES = ["128m", "57b", "23b"]


@pytest.fixture(params=SIZES)
def ranges(spark, request):
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "0" if request.param != "128m" else "4m")
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    spark.conf.set("spark.sql.files.openCostInBytes", "4m")


def write(folder, name, data):
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(data if isinstance(data, bytes) else data.encode())
    return path


def expected(text, sep=","):
    text = text.removesuffix("\n")  # ends no field, even one whose quotes are left open
    return [r for r in csv.reader(io.StringIO(text, newline=""), delimiter=sep) if r]


def records(spark, paths, **kw):
    return R.records(spark, paths, os.path.join(os.path.dirname(paths[0]), "_stage"), **kw)


def read(spark, paths, **kw):
    got = {}
    for r in sorted(records(spark, paths, **kw).collect(), key=lambda r: (r.path, r.block, r.pos)):
        got.setdefault(os.path.basename(r.path), []).append(r.fields)
    return got


TEXTS = {
    "plain.txt": "a,b,c\n1,2,3\n\n4,5,6",
    "crlf.txt": "a,b\r\n1,2\r\n\r\n3,4\r\n",
    "cr.txt": "a,b\r1,2\r\r\"x\ry\",4\r",
    "quoted.txt": 'a,b\n"line one\nline two",2\n"he said ""hi""\r\n\r\n, then, left",4\n5,"6"\n',
    "stray.txt": 'pipe 5",next\n7" and 8",z\n"closed"tail " more,q\n"a"",""b\nc",d\n x "y,z\n',
    "unfinished.txt": 'a,b\n1,"open\nto the\nend',
    "wide.txt": "k,v\n" + "".join(f'{i},"{"word " * 9}\n{"line " * 7}""{i}"""\n' for i in range(12)),
    "spanning.txt": 'k,v\n1,"' + "all of this is one field\n" * 20 + '"\n2,x\n',
}


def test_equals_the_csv_module(spark, scratch, ranges):
    paths = [write(scratch, n, t) for n, t in TEXTS.items()]
    assert read(spark, paths) == {n: expected(t) for n, t in TEXTS.items()}


def test_random_texts(spark, scratch, ranges):
    rng = random.Random(8)
    texts = {f"r{i}.txt": "".join(rng.choice(['a', ';', '"', '\n', 'b', ',', '\r', '""', '\r\n', 'é', ' ']) for _ in range(rng.randrange(1, 220)))
             for i in range(25)}
    paths = [write(scratch, n, t) for n, t in texts.items()]
    got = read(spark, paths, sep=";")
    assert got == {n: x for n, t in texts.items() if (x := expected(t, ";"))}


def test_bad_bytes_and_byte_order_mark(spark, scratch, ranges):
    good = write(scratch, "good.txt", b"\xef\xbb\xbfa,b\n\xc3\xa9,2\n")
    bad = write(scratch, "bad.txt", b"a,b\n1,2\n" + b"x\xe9y,2\n" + b'3,"4\n\xff"\n5,6\n')
    rows = records(spark, [good, bad]).collect()
    assert sorted(r.fields for r in rows if r.path.endswith("good.txt")) == [["a", "b"], ["é", "2"]]
    assert [r.valid for r in sorted(rows, key=lambda r: (r.path, r.block, r.pos)) if r.path.endswith("bad.txt")] == [True, True, False, False, True]
    assert all(r.valid for r in rows if r.path.endswith("good.txt"))


def test_state_of_a_line():
    assert [R.ends_inside(t, False, ",") for t in ('a', '"a', '"a"', 'a"', '"a""', '"a"",', 'x,"', 'x "y,"z')] == \
        [False, True, False, False, True, True, True, True]
    assert [R.ends_inside(t, True, ",") for t in ('a', 'a"', '"a"', '"",', '","')] == [True, False, False, True, True]


def test_ranges_grow_when_too_many_start_inside_a_field(spark, scratch, monkeypatch):
    monkeypatch.setattr(R, "MAX_STARTS", 3)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "23b")
    try:
        paths = [write(scratch, n, t) for n, t in TEXTS.items()]
        assert read(spark, paths) == {n: expected(t) for n, t in TEXTS.items()}
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "23b"
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")


def test_one_and_fifty_ranges_give_the_same(spark, scratch):
    rng = random.Random(2)
    text = "id,note\n" + "".join(f'{i},"{"x" * rng.randrange(30)}\n{"y" * rng.randrange(90)}, ""z"""\n' for i in range(400))
    got = []
    for size in (len(text) + 1, len(text) // 50):
        path = write(scratch, f"in{size}.txt", text)
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{size}b")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            rows = R.records(spark, [path], os.path.join(scratch, f"stage{size}")).collect()
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
            spark.conf.set("spark.sql.files.openCostInBytes", "4m")
        got.append([r.fields for r in sorted(rows, key=lambda r: (r.block, r.pos))])
        assert len({r.block for r in rows}) >= (40 if size < 5000 else 1)
    assert got[0] == got[1] == expected(text)


def test_small_ranges_share_tasks(spark, scratch):
    """The number of tasks follows the bytes, not the number of ranges (one task a range took longest at scale)."""
    text = "k,v\n" + "".join(f'{i},"one\ntwo ""{i}"""\n' for i in range(2000))
    path = write(scratch, "many.txt", text)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = sorted(records(spark, [path], range_bytes=100).collect(), key=lambda r: (r.block, r.pos))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert [r.fields for r in got] == expected(text)
    assert len({r.block for r in got}) > 100
    written = [n for n in os.listdir(os.path.join(scratch, "_stage")) if n.startswith("part-")]
    assert len(written) <= spark.sparkContext.defaultParallelism


def test_state_told_by_counting_is_that_of_reading():
    rng = random.Random(3)
    told = 0
    for _ in range(4000):
        text = "".join(rng.choice(["a", ",", '"', "\n", '"\n', '",', ',"', '\n"', '""', "\r", "\r\n", "é"]) for _ in range(rng.randrange(14))).encode()
        for inside in (False, True):
            row = ["p", 0, inside, inside, False]
            for line in text.split(b"\n"):
                R._follow(row, line, False, ",")
            got = R.state_after(text, inside, ord(","))
            assert got is None or got == row[2]
            told += got is not None
    assert told > 1000


def test_long_ranges_are_cut_whole(spark, scratch):
    """Whole batches at once: open records at a batch's end, blank lines, bad bytes and lone carriage returns in the middle."""
    text = "k,v\n" + "".join(f'{i},"a ""{i}""\nb"\n' + ("\n" if i % 7 == 0 else "") for i in range(9000))
    odd = "k,v\n" + "".join(f"{i},x\n" for i in range(6000)) + "6000,y\r6001,z\n" + "".join(f'{i},"x\ry"\r\n' for i in range(6002, 12000))
    bad = text.encode() + b'9000,"\xe9\n"\n' + b"9001,x\n"
    paths = [write(scratch, n, t) for n, t in (("a.txt", text), ("odd.txt", odd), ("bad.txt", bad))]
    rows = records(spark, paths, range_bytes=60_000).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.path, r.block, r.pos)):
        got.setdefault(os.path.basename(r.path), []).append(r.fields)
    assert got == {"a.txt": expected(text), "odd.txt": expected(odd), "bad.txt": expected(bad.decode(errors="replace"))}
    assert [r.fields[0] for r in rows if not r.valid] == ["9000"]


def test_arrow_cuts_plain_text_as_the_csv_module():
    rng = random.Random(4)
    bits = ["a", ",", ",", '"', "\n", '"\n', '",', ',"', '\n"', '""', "\r", "\r\n", "é", " ", "\x00", "\x85", "﻿", "NaN", "5"]
    told = 0
    for k in range(12000):
        text = "".join(rng.choice(bits) for _ in range(rng.randrange(30)))
        if k % 2:  # mostly well-formed
            text = "\n".join(",".join(rng.choice(['"x\ny"', '"a""b"', "", '""', " 5 ", '"c"d', "é"]) for _ in range(2)) for _ in range(4)) + rng.choice(["", "\n", '\n"', '\n1,"2\n\n3\n'])
        lines = text.encode().split(b"\n")
        got = R.plain_records(pa.array(lines, pa.binary()), ",")
        if got is not None:
            rows, valid, taken = R.whole_records(lines, ",")
            assert ([x.split(R.BETWEEN) for x in got[0].to_pylist()], got[2]) == (rows, taken) and all(valid), text
            assert {len(r) for r in rows} <= {got[1]}
            told += 1
    assert told > 2000


def test_bad_text_is_not_plain():
    for lines in ([b"a,b", b"x\xe9,1"], [b"a,b", b"1"], [b"a,b", b"1\r2,3"], [b'a,b "c" d,"e', b'f"'], [b""], [b"one"], [b"a,b", b"1\x1f,2"]):
        assert R.plain_records(pa.array(lines, pa.binary()), ",") is None
    assert R.plain_records(pa.array([b"a,b", b"1,2"], pa.binary()), "é") is None


@pytest.mark.parametrize("quoted", [True, False])
def test_well_formed_text_is_read_once(spark, scratch, monkeypatch, quoted):
    """Ranges are cut from the starts that they look to have; only where that does not fit is the text read again."""
    calls = []
    real = R.inside_starts
    monkeypatch.setattr(R, "inside_starts", lambda *a: calls.append(1) or real(*a))
    if quoted:
        text = "k,v,w\n" + "".join(f'"{i}","He said ""{i}"",\r\nthen\nwent","{i % 7}"\n' for i in range(9000))
    else:  # nothing tells that a range starts in the long field
        text = "k,v,w\n" + "".join(f"{i},x,y\n" for i in range(3000)) + '1,"' + "a line\n" * 9000 + '",z\n' + "".join(f"{i},x,y\n" for i in range(3000))
    path = write(scratch, "in.txt", text)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = sorted(records(spark, [path], range_bytes=9_000).collect(), key=lambda r: (r.block, r.pos))
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", "4m")
    assert [r.fields for r in rows] == expected(text) and {r.width for r in rows} == {3}
    assert (len(calls) == 0) == quoted


def test_fields_that_hold_the_mark_between_fields(spark, scratch):
    """Fields are kept in one text only where none holds the mark; empty ones at a record's end stay."""
    text = "a,b,c\n" + "".join(f'{i},"x\x1fy",\n' if i == 70_000 else f'{i},"é ""{i}""",\n' for i in range(80_000)) + ",,\n"
    path = write(scratch, "in.txt", text)
    rows = sorted(records(spark, [path], range_bytes=500_000).collect(), key=lambda r: (r.block, r.pos))
    assert [r.fields for r in rows] == expected(text) and {r.width for r in rows} == {3}
    kept = spark.read.schema(R.CUT_DDL).parquet(os.path.join(scratch, "_stage"))
    assert kept.filter("joined IS NOT NULL").count() > 40_000 and kept.filter("fields IS NOT NULL").count() > 0
