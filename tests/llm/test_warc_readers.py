"""Archives hold their members back to back, so other readers see every record."""

import gzip
import random
import subprocess
from pathlib import Path

from opsflow.llm import warc


def test_other_readers_see_every_record(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, f"http://a/{i}", "".join(rng.choice("abcdefgh \n") for _ in range(rng.choice([0, 50, 3000])))) for i in range(40)]
    path = str(tmp_path / "archives")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
    warc.write_archives(pages, path, records_per_archive=7)
    files = [f for f in sorted(Path(path).glob("part-*")) if f.stat().st_size]  # a task without records may leave an empty file
    assert len(files) >= 6
    for f in files:
        subprocess.run(["gzip", "-t"], stdin=f.open("rb"), check=True)
        content = f.read_bytes()
        members = list(warc.inflate_members(memoryview(content)))
        assert len(members) <= 7 and gzip.decompress(content) == b"".join(m for _, m in members)
    # Every record, read by another library, is what the own reader gives.
    seen = sum(gzip.decompress(f.read_bytes()).count(b"WARC/1.1\r\n") for f in files)
    got = {r.page_id: r for r in warc.read_archives(spark, path).collect()}
    assert seen == len(rows) == len(got)
    assert all(got[i].refers_to is not None or got[i].payload == bytearray(t.encode()) for i, _, t in rows)
    plain = subprocess.run(["zcat"], input=files[0].read_bytes(), stdout=subprocess.PIPE, check=True).stdout
    assert plain == gzip.decompress(files[0].read_bytes())


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, None, "".join(chr(rng.randrange(32, 20_000)) for _ in range(4000))) for i in range(12)] + [(99, None, "x" + "".join(
        chr(rng.randrange(32, 20_000)) for _ in range(60_000)))]
    path = str(tmp_path / "archives")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path, archive_bytes=40_000)
    sizes = [len(list(warc.inflate_members(memoryview(f.read_bytes())))) for f in Path(path).glob("part-*")]
    assert sum(sizes) == 13 and len(sizes) >= 4
    for f in Path(path).glob("part-*"):
        assert f.stat().st_size <= 40_000 or len(list(warc.inflate_members(memoryview(f.read_bytes())))) == 1
    assert warc.read_archives(spark, path).count() == 13


def test_a_member_that_does_not_end_in_zero():
    big = gzip.compress(b"a" * (17 << 20), mtime=0)
    assert big[-1] != 0
    content = warc.joined([big]) + b"\x00"
    assert [len(m) for _, m in warc.inflate_members(memoryview(content))] == [17 << 20]
    assert len(gzip.decompress(content)) == 17 << 20
    small = gzip.compress(b"b", mtime=0)
    assert warc.joined([small, small]) + b"\x00" == small + small
