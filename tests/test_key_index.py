"""The key index never misses a key and leaves most files unread."""
import os
import random
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsflow.plans import ingest
from opsflow.sources import key_index as KI

from test_ingest import HEADER, _write


def keyed(spark, lo, hi):
    return spark.range(lo, hi).select(F.format_string("K%07d", F.col("id")).alias("sale_id"))


@pytest.fixture()
def target(spark, scratch):
    path = scratch + "/t"
    for lo in (0, 1_000, 2_000):  # three runs, each sorted over four files; the last two interleave
        step = 1 if lo == 0 else 2
        rows = keyed(spark, lo, lo + 1_000).filter(F.substring("sale_id", 2, 7).cast("int") % step == 0)
        rows.repartitionByRange(4, "sale_id").sortWithinPartitions("sale_id").write.mode("append").parquet(path)
    return path


def test_filter_has_no_false_negative():
    rng = np.random.default_rng(1)
    held, other = rng.integers(-2**63, 2**63 - 1, 5_000), rng.integers(-2**63, 2**63 - 1, 20_000)
    bits = KI.filter_of(held)
    assert KI.may_hold(bits, held).all() and KI.may_hold(bits, other).mean() < 0.02
    assert KI.may_hold(KI.filter_of(held[:1]), held[:1]).all()


@pytest.mark.parametrize("at_once", [KI.RANGES_AT_ONCE, 5])
def test_only_files_that_may_hold_a_key_are_read(spark, target, monkeypatch, at_once):
    monkeypatch.setattr(KI, "RANGES_AT_ONCE", at_once)
    index = KI.KeyIndex(spark, target, "sale_id")
    assert index.candidates(keyed(spark, 0, 3)) == []  # nothing is indexed yet
    assert index.refresh() == 12 and index.refresh() == 0
    names = {r.sale_id: r.f for r in spark.read.parquet(target).select("sale_id", F.col("_metadata.file_name").alias("f")).collect()}
    rng = random.Random(3)
    held = rng.sample(sorted(names), 4)
    absent = ["K0001001", "K9999999", "", "A", "K0000500x", None]
    batch = spark.createDataFrame([(k,) for k in held + held + absent], "sale_id string")
    got = set(index.candidates(batch))
    assert {names[k] for k in held} <= got and len(got) <= 6
    assert {r.sale_id for r in index.keys_that_may_match(batch).collect()} >= set(held)
    read = index.keys_that_may_match(batch).inputFiles()
    assert {os.path.basename(f) for f in read} == got
    assert index.candidates(spark.createDataFrame([("ZZZ",), (None,)], "sale_id string")) == []
    assert index.keys_that_may_match(batch.limit(0)).count() == 0


def test_ranges_that_lie_in_each_other(spark):
    ranges = sorted([("wide", "a", "z"), ("one", "b", "b"), ("mid", "c", "m"), ("late", "x", "y")], key=lambda r: (r[1], r[2], r[0]))
    keys = spark.createDataFrame([(k,) for k in ("b", "d", "n", "x", "z", "zz", "A")], "key string").withColumn("h", F.ascii("key").cast("bigint"))
    got = sorted(tuple(r) for r in keys.mapInArrow(KI._in_ranges(ranges), "file string, h bigint").collect())
    want = sorted((f, ord(k[0])) for k in ("b", "d", "n", "x", "z", "zz", "A") for f, lo, hi in ranges if lo <= k <= hi)
    assert got == want


def test_loads_with_the_index_equal_those_without(spark, scratch):
    rng = random.Random(9)
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    for day in range(3):
        rows = [f"K-{rng.randrange(400):03d},C,P,1,1.00,1.00,2026-02-01,R,day{day}row{i}" for i in range(150)]
        path = _write(src, f"sales_{day}.txt", [HEADER] + rows)
        for kind in (True, False):
            ingest.run_etl(spark, src, f"{scratch}/t{kind}", datetime(2026, 3, 1 + day), do_archive=False, files=[path], key_index=kind)
    a, b = [sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/t{k}").collect()) for k in (True, False)]
    assert a == b and len(a) == len({r[0] for r in a})
