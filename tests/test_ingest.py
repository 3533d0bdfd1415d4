import os
from datetime import datetime

from pyspark.sql import functions as F

from opsflow.plans import ingest
from opsflow.sources import delimited as S

HEADER = "sale_id,customer_name,product,quantity,unit_price,total_amount,sale_date,region,salesperson"


def _rows(prefix, n, start_day):
    out = []
    for i in range(n):
        q, p = i + 2, 10.5 + i
        out.append(f"{prefix}-{i:03d},Client {i},Item {i % 3},{q},{p:.2f},{q * p:.2f},2026-03-{start_day + i:02d},"
                   f"Zone {i % 4},Seller {i % 2}")
    return out


def _write(d, name, lines, bom=False):
    path = os.path.join(d, name)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8", newline="") as fh:
        fh.write("\n".join(lines) + ("\n" if lines else ""))
    return path


def test_golden_two_files(spark, scratch):
    src, arch, tgt = os.path.join(scratch, "in"), os.path.join(scratch, "in", "archived"), os.path.join(scratch, "t")
    os.makedirs(src)
    _write(src, "sales_0301.txt", [HEADER] + _rows("A", 10, 1))
    _write(src, "sales_0302.txt", [HEADER] + _rows("B", 10, 11))
    run = datetime(2026, 3, 2, 14, 42)
    out = ingest.run_etl(spark, src, tgt, run, archive_dir=arch)
    stats = {r.source_file: r for r in out["stats"].collect()}
    assert set(stats) == {"sales_0301.txt", "sales_0302.txt"}
    for r in stats.values():
        assert (r.parsed, r.inserted, r.skipped, r.errors, r.mismatches) == (10, 10, 0, 0, 0)
    tot = ingest.run_totals(out["stats"]).first()
    assert (tot.files, tot.parsed, tot.inserted, tot.skipped, tot.errors) == (2, 20, 20, 0, 0)
    assert out["failed"] == []
    assert sorted(os.listdir(arch)) == ["sales_0301.txt", "sales_0302.txt"]
    loaded = spark.read.parquet(tgt)
    assert loaded.count() == 20
    assert loaded.agg(F.sum("quantity")).first()[0] == 2 * sum(range(2, 12))
    # second run: nothing left to discover
    assert ingest.run_etl(spark, src, tgt, run, archive_dir=arch)["stats"] is None


def test_edge_cases(spark, scratch):
    src, arch, tgt = os.path.join(scratch, "in"), os.path.join(scratch, "in", "archived"), os.path.join(scratch, "t")
    os.makedirs(arch)
    _write(arch, "sales_a.txt", ["old"])  # archive name collision
    reordered = "REGION, Sale_ID ,customer_name,product,quantity,unit_price,total_amount,sale_date,salesperson,extra"
    _write(src, "sales_a.txt", [
        reordered,
        'North,X-1,"Acme, Inc",Bolt,3,1.10,3.30,2026-02-01,Kim,e',
        "North,X-2,Beta,Bolt,5.0,1.00,5.00,2026-02-01,Kim,e",          # '5.0' quantity -> bad
        "South,X-3,Gamma,Nut,2,\"1,234.50\",2469.00,2/3/2026,Lee,e",      # thousands comma, m/d/Y
        "South,X-4,Delta,Nut,2,1.00,2.00,2026-02-30,Lee,e",             # invalid day -> bad
        "",                                                             # blank line skipped
        "East,X-5,Eps,Nut,2,NaN,2.00,2026-02-01,Lee,e",                  # NaN -> bad (Q20)
        "East,X-1,Dup,Nut,9,1.00,9.00,03-02-2026,Lee,e",                 # duplicate key in file -> skipped
        "West,X-6,Zeta,Nut,3,0.125,0.37,2026-02-01,Lee,e",               # expected 0.38: mismatch, still loaded
        "West,X-7,Eta,Nut,1,0.125,0.12,2026-02-01,Lee,e",                # 0.125 -> 0.12 half-even: no mismatch
    ], bom=True)
    _write(src, "sales_b.txt", ["sale_id,customer_name,product,quantity,unit_price,total_amount,sale_date,salesperson",
                                "Y-1,A,B,1,1.00,1.00,2026-02-01,Kim"])            # missing region -> file fails
    _write(src, "sales_c.txt", [HEADER, "Z-1,A,B,1,1.00,1.00,2026-02-01,N,Kim", "Z-2,A,B,1"])  # short row -> fails
    _write(src, "sales_d.txt", [])                                                            # empty -> fails
    _write(src, "sales_e.txt", [HEADER, "X-3,Again,B,1,1.00,1.00,2026-02-01,N,Kim",
                                "W-1,New,B,1,1.00,1.00,2026-02-01,N,Kim"])
    _write(src, "other.txt", [HEADER])                                                        # not matched
    run = datetime(2026, 3, 2, 14, 42, 5)
    out = ingest.run_etl(spark, src, tgt, run, archive_dir=arch)
    failed = {os.path.basename(p): why for p, why in out["failed"]}
    assert set(failed) == {"sales_b.txt", "sales_c.txt", "sales_d.txt"}
    assert "region" in failed["sales_b.txt"] and "empty" in failed["sales_d.txt"]
    stats = {r.source_file: r for r in out["stats"].collect()}
    a, e = stats["sales_a.txt"], stats["sales_e.txt"]
    assert (a.parsed, a.inserted, a.skipped, a.errors, a.mismatches) == (5, 4, 1, 3, 1)
    assert (e.parsed, e.inserted, e.skipped, e.errors) == (2, 1, 1, 0)
    rows = {r.sale_id: r for r in spark.read.parquet(tgt).collect()}
    assert sorted(rows) == ["W-1", "X-1", "X-3", "X-6", "X-7"]
    assert rows["X-1"].customer_name == "Acme, Inc" and rows["X-1"].region == "North"
    assert rows["X-3"].unit_price == 1234.5 and str(rows["X-3"].sale_date) == "2026-02-03"
    names = sorted(os.listdir(arch))
    assert "sales_a_20260302_144205.txt" in names and "sales_e.txt" in names and "sales_b.txt" not in names


def test_header_check_and_discovery(spark, scratch):
    os.makedirs(os.path.join(scratch, "archived2"))
    _write(scratch, "sales9.txt", [HEADER.upper()])
    _write(os.path.join(scratch, "archived2"), "sales8.txt", [HEADER])
    files = S.discover(spark, scratch, "sales*.txt", os.path.join(scratch, "archived"))
    assert [os.path.basename(f) for f in files] == ["sales9.txt"]
    assert S.check_header(spark, files[0]).error is None


def test_split_reads_keep_first_wins_order(spark, scratch):
    """multiline=False splits a large file across tasks; row order still holds."""
    src, tgt = os.path.join(scratch, "in"), os.path.join(scratch, "t")
    os.makedirs(src)
    lines = [HEADER] + [f"K-{i % 500},C,P,1,1.00,1.00,2026-02-01,R,S{i}" for i in range(20000)]
    _write(src, "sales_0301.txt", lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        out = ingest.run_etl(spark, src, tgt, datetime(2026, 3, 2), do_archive=False, multiline=False)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    r = out["stats"].first()
    assert (r.parsed, r.inserted, r.skipped) == (20000, 500, 19500)
    first = {row.sale_id: row.salesperson for row in spark.read.parquet(tgt).collect()}
    assert all(first[f"K-{k}"] == f"S{k}" for k in range(500))


def test_archive_failure_keeps_rows_and_reports(spark, scratch):
    src, tgt = os.path.join(scratch, "in"), os.path.join(scratch, "t")
    os.makedirs(src)
    _write(src, "sales_x.txt", [HEADER] + _rows("Q", 3, 1))
    blocker = os.path.join(scratch, "not_a_dir")
    with open(blocker, "w") as fh:   # archive target is a file: the move must fail
        fh.write("x")
    out = ingest.run_etl(spark, src, tgt, datetime(2026, 3, 2), archive_dir=blocker)
    assert spark.read.parquet(tgt).count() == 3
    assert any("loaded_not_archived" in why for _, why in out["failed"])


def test_reject_reasons_match_source_messages(spark):
    from opsflow.sources.delimited import REQUIRED_COLUMNS
    rows = [
        ("S1", " 5.0 ", "1.00", "5.00", "2026-02-01"),
        ("S2", "2", "abc", "2.00", "2026-02-01"),
        ("S3", "2", "1.00", "", "2026-02-01"),
        ("S4", "2", "1.00", "2.00", "2026-02-30"),
        ("S5", "2", "1,000.00", "2000", " 02/03/2026 "),
    ]
    data = [{**dict.fromkeys(REQUIRED_COLUMNS, "x"), "sale_id": sid, "quantity": q, "unit_price": up,
             "total_amount": ta, "sale_date": sd} for sid, q, up, ta, sd in rows]
    raw = spark.createDataFrame(data, ", ".join(f"{c} string" for c in REQUIRED_COLUMNS))
    got = {r.sale_id: (r.reason, r.total_mismatch) for r in ingest.validate_sales(raw, datetime(2026, 3, 2)).collect()}
    assert got == {
        "S1": ("Invalid integer for 'quantity': '5.0'", False),
        "S2": ("Invalid decimal for 'unit_price': 'abc'", False),
        "S3": ("Invalid decimal for 'total_amount': ''", False),
        "S4": ("Unrecognised date format for 'sale_date': '2026-02-30'", False),
        "S5": (None, False),
    }


def test_bucketed_target_is_not_shuffled(spark, scratch):
    src = os.path.join(scratch, "in")
    os.makedirs(src)
    _write(src, "sales_1.txt", [HEADER] + _rows("B", 6, 1))
    name = "sales_bucketed_" + os.path.basename(scratch).replace("-", "_")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle-join path
    try:
        ingest.run_etl(spark, src, None, datetime(2026, 3, 1), do_archive=False, target_table=name, buckets=4)
        _write(src, "sales_2.txt", [HEADER] + _rows("B", 3, 1) + _rows("C", 2, 1))
        out = ingest.run_etl(spark, src, None, datetime(2026, 3, 2), do_archive=False, target_table=name,
                             buckets=4, files=[os.path.join(src, "sales_2.txt")])
        r = out["stats"].first()
        assert (r.parsed, r.inserted, r.skipped) == (5, 2, 3)
        assert spark.table(name).count() == 8
        # the anti-join plan: the bucketed target side reaches the join without an exchange
        from opsflow.operators.core import insert_ignore
        batch = spark.createDataFrame([("B-000", 1)], "sale_id string, pos int")
        plan = insert_ignore(spark.table(name).select("sale_id"), batch, "sale_id", ["pos"]) \
            ._jdf.queryExecution().executedPlan().toString()
        scan = [ln for ln in plan.splitlines() if "FileScan parquet" in ln][0]
        assert "SelectedBucketsCount" in scan            # read as a bucketed scan
        join_pos = plan.index("SortMergeJoin")
        exchanges_after_join = plan[join_pos:].count("Exchange hashpartitioning")
        assert exchanges_after_join == 1                  # only the batch side is shuffled
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "32m")
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_header_only_long_row_and_quoted_newline(spark, scratch):
    src, tgt = os.path.join(scratch, "in"), os.path.join(scratch, "t")
    os.makedirs(src)
    _write(src, "sales_h.txt", [HEADER])                                                    # header only
    _write(src, "sales_l.txt", [HEADER, "L-1,A,B,1,1.00,1.00,2026-02-01,N,Kim,EXTRA"])     # long row -> fails
    _write(src, "sales_q.txt", [HEADER, 'Q-1,"Line one', 'line two",B,2,1.50,3.00,2026-02-01,N,Kim'])  # quoted newline
    out = ingest.run_etl(spark, src, tgt, datetime(2026, 3, 2), do_archive=False)
    failed = {os.path.basename(p) for p, _ in out["failed"]}
    assert failed == {"sales_l.txt"}
    stats = {r.source_file: (r.parsed, r.inserted) for r in out["stats"].collect()}
    assert stats == {"sales_h.txt": (0, 0), "sales_q.txt": (1, 1)}
    row = spark.read.parquet(tgt).first()
    assert row.customer_name == "Line one\nline two" and row.total_amount == 3.0


def test_quoted_header_names(spark, scratch):
    path = _write(scratch, "sales_q.txt", ['"sale_id","customer_name","product","quantity","unit_price",'
                                           '"total_amount","sale_date","region","salesperson","a,b"'])
    check = S.check_header(spark, path)
    assert check.error is None and check.header[-1] == "a,b" and len(check.header) == 10


def test_first_wins_survives_a_failed_scan_task(spark, scratch):
    """A lost scan task is re-run; row positions, hence first-wins, are unchanged."""
    from pyspark import TaskContext

    src = os.path.join(scratch, "in")
    os.makedirs(src)
    lines = [HEADER] + [f"K-{i % 300},C,P,1,1.00,1.00,2026-02-01,R,S{i}" for i in range(6000)]
    path = _write(src, "sales_big.txt", lines)
    checks = [S.check_header(spark, S.qualify(spark, path))]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32768")
    try:
        raw = S.read_sales_files(spark, checks, multiline=False).withColumn("_file_rank", F.lit(0))

        def flaky(batches):
            ctx = TaskContext.get()
            if ctx.partitionId() == 2 and ctx.attemptNumber() == 0:
                raise RuntimeError("injected task loss")
            yield from batches

        order = ["_file_rank", "_block", "_row_pos"]
        target = spark.createDataFrame([], "sale_id string")

        def winners(df):
            v = ingest.validate_sales(df.drop(S.CORRUPT_COL, "_guard"), datetime(2026, 3, 2))
            return {r.sale_id: r.salesperson for r in ingest.load_sales(v, target, order).collect()}

        clean = winners(raw)
        retried = winners(raw.mapInPandas(flaky, raw.schema))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert retried == clean and clean == {f"K-{k}": f"S{k}" for k in range(300)}
