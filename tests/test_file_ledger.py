"""File failures, the commit manifest and the stream's ledger."""
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow.plans import ingest
from opsflow.sources import delimited as S
from opsflow.streaming.ingest_stream import Ledger, start_ingest_stream

from test_ingest import HEADER, _rows, _write

AS_OF = datetime(2026, 3, 2, 14, 42)


class Crash(Exception):
    pass


@pytest.fixture()
def folder(scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    return src


def by_file(out):
    return {r.source_file: (r.parsed, r.inserted, r.skipped) for r in out["stats"].collect()}


def test_bad_bytes_fail_their_file_only(spark, scratch, folder):
    _write(folder, "sales_1.txt", [HEADER] + _rows("A", 3, 1))
    with open(os.path.join(folder, "sales_2.txt"), "wb") as f:
        f.write((HEADER + "\n" + "\n".join(_rows("B", 2, 1)) + "\n").replace("Client 1", "Andr\xe9").encode("latin-1"))
    out = ingest.run_etl(spark, folder, scratch + "/t", AS_OF, do_archive=False)
    assert [(os.path.basename(p), why) for p, why in out["failed"]] == [("sales_2.txt", "bytes that are not UTF-8")]
    assert by_file(out) == {"sales_1.txt": (3, 3, 0)} and spark.read.parquet(scratch + "/t").count() == 3


def test_reload_under_the_same_time_stamp_inserts_nothing(spark, scratch, folder):
    _write(folder, "sales_1.txt", [HEADER] + _rows("A", 3, 1))
    first = ingest.run_etl(spark, folder, scratch + "/t", AS_OF, do_archive=False)
    again = ingest.run_etl(spark, folder, scratch + "/t", AS_OF, do_archive=False)
    assert by_file(first) == {"sales_1.txt": (3, 3, 0)} and by_file(again) == {"sales_1.txt": (3, 0, 3)}
    seen = ingest.RunState(spark, scratch + "/t-runs").manifest().orderBy("run").collect()
    assert [(r.run, r.inserted) for r in seen] == [(1, 3), (2, 0)]
    # The digest tells the rows that the target holds of the file.
    held = spark.read.parquet(scratch + "/t").filter("source_file = 'sales_1.txt'").agg(ingest.row_digest()).first()[0]
    assert seen[0].digest == held and seen[1].digest == "0"


@pytest.mark.parametrize("where", ["before the commit", "before publishing", "after part of publishing"])
def test_crash_around_the_commit(spark, scratch, folder, monkeypatch, where):
    _write(folder, "sales_1.txt", [HEADER] + _rows("A", 6, 1))
    target, real = scratch + "/t", ingest._append

    def crash(df, *args):
        if where == "after part of publishing":
            real(df.filter("sale_id < 'A-002'"), *args)
        raise Crash

    with monkeypatch.context() as m:
        if where == "before the commit":
            m.setattr(ingest, "manifest_rows", crash)
        else:
            m.setattr(ingest, "_append", crash)
        with pytest.raises(Crash):
            ingest.run_etl(spark, folder, target, AS_OF, do_archive=False)
    os.rename(os.path.join(folder, "sales_1.txt"), os.path.join(folder, "sales_2.txt"))
    out = ingest.run_etl(spark, folder, target, AS_OF, do_archive=False)
    kept = spark.read.parquet(target)
    assert kept.count() == 6 == kept.select("sale_id").distinct().count()
    # A committed run is finished before new files are read; one without a commit never happened.
    assert by_file(out) == {"sales_2.txt": (6, 6, 0) if where == "before the commit" else (6, 0, 6)}
    stages = {n for n in os.listdir(f"{target}-runs/run={out['run']}") if not n.startswith((".", "_"))}
    assert stages == {"manifest", "verdicts"}


def test_header_names_and_positions(spark, scratch, folder):
    cols = HEADER.split(",")
    rows = _rows("A", 2, 1)
    _write(folder, "sales_1.txt", [", ".join(c.upper() for c in reversed(cols)) + ",note,note"]
           + [",".join(reversed(r.split(","))) + ",x,y" for r in rows], bom=True)
    _write(folder, "sales_2.txt", ["region," + HEADER] + ["wrong," + r.replace("A-", "B-") for r in rows])  # the last of a repeated name counts
    _write(folder, "sales_3.txt", ["", " , ", HEADER] + rows)
    _write(folder, "sales_4.txt", [HEADER.replace("region", "area")] + rows)
    out = ingest.run_etl(spark, folder, scratch + "/t", AS_OF, do_archive=False)
    assert by_file(out) == {"sales_1.txt": (2, 2, 0), "sales_2.txt": (2, 2, 0)}
    assert [why for _, why in out["failed"]] == ["file is empty or has no header row", "missing required columns [region]"]
    assert {r.region for r in spark.read.parquet(scratch + "/t").collect()} == {"Zone 0", "Zone 1"}


def test_files_are_not_opened_on_the_driver(spark, scratch, folder, monkeypatch):
    for i in range(3):
        _write(folder, f"sales_{i}.txt", [HEADER] + _rows(f"F{i}", 2, 1))
    monkeypatch.setattr(S, "first_line", lambda *a: pytest.fail("a file was opened on the driver"))
    assert len(by_file(ingest.run_etl(spark, folder, scratch + "/t", AS_OF, do_archive=False))) == 3


def run_stream(spark, folder, scratch, clock=lambda: AS_OF, **kw):
    q = start_ingest_stream(spark, folder, scratch + "/t", scratch + "/ckpt", clock=clock, **kw)
    q.awaitTermination(300)
    return q


def test_failed_file_loads_in_a_later_trigger(spark, scratch, folder):
    _write(folder, "sales_1.txt", [HEADER] + _rows("A", 2, 1))
    bad = _write(folder, "sales_2.txt", [HEADER, "short,row"])
    q = run_stream(spark, folder, scratch)
    state = {os.path.basename(r.path): (r.status, r.attempts) for r in q.ledger.state().collect()}
    assert state == {"sales_1.txt": ("loaded", 1), "sales_2.txt": ("failed", 1)} and spark.read.parquet(scratch + "/t").count() == 2
    # Mended in place: the file source knows the path and does not hand it out again, the ledger does.
    _write(folder, "sales_2.txt", [HEADER] + _rows("B", 4, 1))
    os.utime(bad, (1_600_000_000, 1_600_000_000))
    q = run_stream(spark, folder, scratch, clock=lambda: datetime(2026, 3, 3))
    state = {os.path.basename(r.path): (r.status, r.attempts, r.reason) for r in q.ledger.state().collect()}
    assert state["sales_2.txt"] == ("loaded", 2, None) and spark.read.parquet(scratch + "/t").count() == 6


def test_failed_file_is_tried_with_the_next_new_file_and_given_up(spark, scratch, folder):
    _write(folder, "sales_1.txt", [HEADER, "short,row"])
    for day in range(1, 5):
        q = run_stream(spark, folder, scratch, clock=lambda: datetime(2026, 3, day), max_attempts=3)
    row = q.ledger.state().first()
    assert (row.status, row.attempts) == ("failed", 3) and "malformed" in row.reason
    os.remove(os.path.join(folder, "sales_1.txt"))
    assert q.ledger.open_files(99) == []


def test_repeated_trigger_counts_one_attempt(spark, scratch):
    ledger = Ledger(spark, scratch + "/ledger")
    assert ledger.state().collect() == [] and ledger.open_files(3) == []
    for _ in range(2):
        ledger.note("000000000007", ["/a"], [("/b", "why")], AS_OF)
    assert {(r.path, r.status, r.attempts) for r in ledger.state().collect()} == {("/a", "loaded", 1), ("/b", "failed", 1)}


def test_stream_takes_a_separator_and_a_catalog_table(spark, scratch, folder):
    _write(folder, "sales_1.txt", [x.replace(",", ";") for x in [HEADER] + _rows("A", 3, 1)])
    name = "sales_stream_" + os.path.basename(scratch).replace("-", "_")
    try:
        q = start_ingest_stream(spark, folder, None, scratch + "/ckpt", clock=lambda: AS_OF, sep=";", target_table=name, buckets=2)
        q.awaitTermination(300)
        assert spark.table(name).agg(F.sum("quantity")).first()[0] == 2 + 3 + 4
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_load_order_is_sorted_by_columns(spark, scratch):
    """What the order derives is a column by the time of the sort; an expression is made anew for both rows of every comparison."""
    from opsflow.plans import driver_queries as Q

    rows = [(k % 50, k, k % 9, k % 7 + 1, 3.0, 1500.0, 0.1, 0.0, "RAN"[k % 3], "OF"[k % 2], datetime(1992 + k % 5, 1 + k % 12, 3)) for k in range(400)]
    spark.createDataFrame(rows, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz").write.parquet(f"{scratch}/lineitem.parquet")
    dealt = Q._sales_in_load_order(spark, scratch)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line]
    assert sorts and not any("concat" in line for line in sorts)
    parts = dealt.select(*Q.SALES_ORDER).rdd.glom().map(lambda p: [tuple(r) for r in p]).collect()
    assert [r for p in parts for r in p] == sorted(r for p in parts for r in p) and sum(map(len, parts)) == 400
