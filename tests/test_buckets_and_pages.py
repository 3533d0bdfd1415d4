"""Dense ids, merges and differences by bucket, ordered text in pages."""
import os
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from opsflow.operators.pages import paged_text
from opsflow.plans import jobs, tasklog, triggers
from opsflow.plans.world import care_tables
from opsflow.schemas import LOG_DDL, NEW_TASK_DDL
from opsflow.sources import bucketed as B
from opsflow.sources.tables import Tables

SF = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 5, 6, 7, 8, 9)


@pytest.mark.parametrize("reuse,aqe", [("true", "true"), ("false", "true"), ("true", "false"), ("false", "false")])
def test_ids_are_dense_whatever_the_planner_does(spark, reuse, aqe):
    n = 300_000
    # Many equal rows, and far more rows than shuffle partitions.
    new = spark.range(n).select(F.concat(F.lit("P"), (F.col("id") % 7000).cast("string")).alias("patient_number"), F.lit("Pending").alias("status"))
    new = spark.createDataFrame([], NEW_TASK_DDL).unionByName(new, allowMissingColumns=True)
    log = spark.createDataFrame([(41,), (17,)], "taskid bigint")
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        ids = tasklog.assign_taskids(new, log)
        got = ids.agg(F.count("taskid"), F.countDistinct("taskid"), F.min("taskid"), F.max("taskid")).first()
        late = ids.groupBy("patient_number").agg(F.min("taskid").alias("lo"), F.max("taskid").alias("hi"), F.count("*").alias("c"))
        assert tuple(got) == (n, n, 42, 41 + n) and late.filter("hi - lo + 1 <> c").isEmpty()
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert tasklog.assign_taskids(new.limit(0), log).count() == 0


def files_by_bucket(root):
    return {os.path.join(d, f) for d, _, fs in os.walk(root) for f in fs if f.endswith(".parquet") and "bucket=" in d}


def test_merge_rewrites_touched_buckets_only(spark, scratch):
    table = B.BucketedTable(spark, scratch + "/t", "id", B.number_ranges("id", 100), "id bigint, v string")
    assert table.version() == 0 and table.read().count() == 0
    assert table.replace(spark.range(1000).select("id", F.lit("old").alias("v"))) == 1
    first = files_by_bucket(scratch)
    new = spark.createDataFrame([(5, "a"), (950, "b"), (1001, "c"), (951, None)], "id bigint, v string")
    assert table.upsert(new) == 2
    added = files_by_bucket(scratch) - first
    assert {os.path.basename(os.path.dirname(f)) for f in added} == {"bucket=0", "bucket=9", "bucket=10"}
    got = Counter(r.v for r in table.read().collect())
    assert got == {"old": 997, "a": 1, "b": 1, "c": 1, None: 1} and table.read(1).filter("v = 'old'").count() == 1000
    ver = {r.bucket: r.ver for r in table.commit().collect()}
    assert {b for b, v in ver.items() if v == 2} == {0, 9, 10} and sum(r.n_rows for r in table.commit().collect()) == 1001
    # Only the files of the buckets asked for are read.
    some = table.read(buckets=spark.createDataFrame([(3,), (9,)], "bucket bigint"))
    assert {f.split("/bucket=")[1].split("/")[0] for f in some.inputFiles()} == {"3", "9"} and some.count() == 200


def test_crash_before_the_commit_keeps_the_table(spark, scratch, monkeypatch):
    table = B.BucketedTable(spark, scratch + "/t", "id", B.hash_buckets("id", 8), "id bigint, v string")
    table.replace(spark.range(50).select("id", F.lit("x").alias("v")))
    with monkeypatch.context() as m:
        m.setattr(B.BucketedTable, "accept", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            table.upsert(spark.createDataFrame([(1, "y")], "id bigint, v string"))
    assert table.version() == 1 and table.read().filter("v = 'y'").count() == 0
    table.upsert(spark.createDataFrame([(2, "z")], "id bigint, v string"))
    assert Counter(r.v for r in table.read().collect()) == {"x": 49, "z": 1}


def test_unchanged_buckets_are_not_compared(spark, scratch):
    store = jobs.county_snapshot(spark, scratch + "/county", buckets=32)
    old = spark.range(500).select(F.col("id").cast("string").alias("patient_number"), F.lit("1").alias("residency_codes"),
                                  F.lit("X").alias("residency_desc"), F.lit("DENVER").alias("county"))
    new = old.withColumn("county", F.when(F.col("patient_number").isin("7", "123"), "NON-DENVER").otherwise(F.col("county")))
    a, b = store.replace(old), store.replace(new.repartition(7), accept=False)
    moved = B.changed_buckets(store, a, b)
    want = {r[0] for r in new.filter("county <> 'DENVER'").select(store.bucket).collect()}
    assert {r.bucket for r in moved.collect()} == want and store.version() == a
    read = store.read(a, moved)
    assert {int(f.split("/bucket=")[1].split("/")[0]) for f in read.inputFiles()} == want
    assert B.changed_buckets(store, a, a).count() == 0
    store.accept(b)
    assert store.version() == b


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
def test_jobs_on_bucketed_state_equal_those_on_versions(spark, scratch):
    from opsflow.sources.versioned import VersionedTable
    c = care_tables(Tables.from_parquet_dir(spark, SF))
    as_of = datetime(1998, 6, 18, 9, 30)
    send = lambda p: p.join(c["responses"], "taskid").select("taskid", "response")
    logs = []
    for kind in ("versions", "buckets"):
        root = f"{scratch}/{kind}"
        if kind == "versions":
            log, snap = VersionedTable(spark, root + "/log"), VersionedTable(spark, root + "/snap")
            log.write_next(c["task_log"])
            snap.write_next(c["prev_county"])
        else:
            log, snap = jobs.task_log(spark, root + "/log", 500), jobs.county_snapshot(spark, root + "/snap", 16)
            log.replace(c["task_log"])
            snap.replace(c["prev_county"])
        queue = VersionedTable(spark, root + "/queue")
        jobs.run_rules(c, log, snap, as_of)
        jobs.run_manager(c, log, queue, as_of, send, entries=c["vendor_entries"], waves=2)
        logs.append(sorted(map(repr, log.read().collect())))
        assert snap.read().count() == triggers.next_county_snapshot(c).count()
    assert logs[0] == logs[1]


def test_pages(spark):
    rows = [(g, i, "é" * (i % 11) + f"-{i}" if i % 13 else None) for g, n in (("a", 900), ("b", 3), (None, 40)) for i in range(n)]
    df = spark.createDataFrame(rows, "g string, i int, line string").repartition(5)
    got = {}
    for r in paged_text(df, ["g"], ["i"], "line", "; ", 200).collect():
        got[(r.g, r.page)] = (r.n_lines, r.text)
    want, at = {}, Counter()
    for g, i, line in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        if line is not None:
            want.setdefault((g, at[g] // 200), []).append(line)
            at[g] += len(line.encode()) + 2
    assert got == {k: (len(v), "; ".join(v)) for k, v in want.items()}
    assert all(len(text.encode()) <= 200 + 30 for _, text in got.values())
    assert paged_text(df.limit(0), ["g"], ["i"], "line").count() == 0


def test_empty_log_merges(spark, scratch):
    log = jobs.task_log(spark, scratch + "/log")
    log.replace(spark.createDataFrame([], LOG_DDL))
    assert log.version() == 1 and log.read().count() == 0 and log.commit().count() == 0


def test_reads_of_many_buckets_start_few_tasks(spark, scratch):
    """Folders are listed many to a task, and versions of which little is current are still read by name."""
    table = B.BucketedTable(spark, scratch + "/many", "id", B.number_ranges("id", 10), "id bigint, x bigint")
    table.replace(spark.range(2000).select("id", F.col("id").alias("x")))
    table.upsert(spark.range(0, 2000, 400).select("id", F.lit(-1).cast("bigint").alias("x")))
    group = "list-buckets"
    spark.sparkContext.setJobGroup(group, group)
    try:
        first, now = table.read(1), table.read()
        tracker = spark.sparkContext.statusTracker()
        stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        assert max((s.numTasks for s in stages if s), default=0) < 100
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert sorted((r.id, r.x) for r in first.collect()) == [(i, i) for i in range(2000)]
    assert sorted((r.id, r.x) for r in now.collect()) == [(i, i if i % 400 else -1) for i in range(2000)]
