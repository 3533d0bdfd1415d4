"""File names, overflow, repeated answers and crash windows."""

import os
from datetime import datetime

import pytest

from opsflow.plans import ingest
from opsflow.sources.versioned import VersionedTable

AS_OF = datetime(2024, 5, 6, 7, 8, 9)
HEADER = "sale_id,customer_name,product,quantity,unit_price,total_amount,sale_date,region,salesperson"


@pytest.mark.parametrize("names", [["sales 1.txt", "sales%41.txt", "sales[1].txt", "sales1.txt", "sales#é.txt"]])
def test_every_file_name_loads_in_full(spark, scratch, names):
    for k, name in enumerate(names):
        with open(os.path.join(scratch, name), "w", encoding="utf-8") as f:
            f.write(f"{HEADER}\nid{k},c,p,2,1.50,3.00,2024-01-02,r,s\n")
    out = ingest.run_etl(spark, scratch, scratch + "/target", AS_OF, do_archive=False)
    assert not out["failed"]
    got = {r.source_file: (r.parsed, r.inserted) for r in out["stats"].collect()}
    assert got == {n: (1, 1) for n in names}
    assert spark.read.parquet(scratch + "/target").count() == len(names)


def test_large_numbers_and_repeated_extra_headers(spark, scratch):
    with open(os.path.join(scratch, "sales1.txt"), "w") as f:
        f.write(f"{HEADER},note,note\na,c,p,12345678901,1.00,12345678901.00,2024-01-02,r,s,x,y\n"
                "b,c,p,1,12345678901234567890.25,12345678901234567890.25,2024-01-02,r,s,x,y\n")
    out = ingest.run_etl(spark, scratch, scratch + "/target", AS_OF, do_archive=False)
    row = out["stats"].first()
    assert not out["failed"] and (row.inserted, row.errors, row.mismatches) == (2, 0, 0)


def test_unreadable_target_is_an_error(spark, scratch):
    with open(os.path.join(scratch, "sales1.txt"), "w") as f:
        f.write(f"{HEADER}\na,c,p,1,1,1,2024-01-02,r,s\n")
    os.makedirs(scratch + "/target")
    with open(scratch + "/target/part-0.parquet", "wb") as f:
        f.write(b"no parquet")
    with pytest.raises(Exception):
        ingest.run_etl(spark, scratch, scratch + "/target", AS_OF, do_archive=False)


def test_uncommitted_version_is_ignored_and_replaced(spark, scratch):
    table = VersionedTable(spark, scratch + "/t")
    assert table.current_version() is None
    assert table.write_next(spark.range(3)) == 1
    os.makedirs(scratch + "/t/v=2")  # what a crash before the commit leaves
    with open(scratch + "/t/v=2/part-0.parquet", "wb") as f:
        f.write(b"half")
    assert table.current_version() == 1 and table.read().count() == 3
    assert table.write_next(spark.range(5)) == 2 and table.read().count() == 5
