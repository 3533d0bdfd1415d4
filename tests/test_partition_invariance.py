"""Results do not depend on how Spark partitions the work."""
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
NAMES = ["compliance_check", "insert_ignore", "append_tasks", "daily_run", "task_actions", "fallback_due",
         "weekly_overtime", "over_util_notes"]


def _rows(df):
    return sorted(tuple("\0" if v is None else str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_any_partitioning(spark, name):
    prev = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        results = []
        for parts in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            results.append(_rows(E.queries()[name](spark, SF)))
        assert results[0] == results[1]
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
