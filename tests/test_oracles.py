"""Every registered query against its DuckDB oracle on the sf0.001 tables."""
import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, Decimal):
        return str(v.normalize())
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("region nation customer supplier part orders lineitem events documents embeddings pages "
              "benchmark labels conversations").split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


# Queries that SQL cannot express, and the tests that hold them against brute force instead.
NO_SQL = {
    "op1_pareto_mix": "tests/llm/test_llm_operators.py::test_mix_targets_and_copies",
    "op2_token_counts": "tests/llm/test_llm_operators.py::test_token_counts_match_the_library",
    "op3_toxicity": "tests/llm/test_llm_operators.py::test_toxicity_scores_and_defined_cases",
    "op4_content_chunks": "tests/llm/test_llm_operators.py",
    "op5_secret_scan": "tests/llm/test_llm_operators.py",
    "op6_winnowing": "tests/llm/test_llm_operators.py",
    "op9_near_dedup": "tests/llm/test_llm_operators.py",
    "op10_piece_lattice": "tests/llm/test_llm_operators.py",
    "op13_conversation_repair": "tests/llm/test_quality_search_repair.py::test_repair",
    "pipeline": "tests/llm",
}


def test_queries_without_sql_are_named():
    assert set(E.queries()) - set(E.oracle_sql()) <= set(NO_SQL)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for name in set(E.queries()) & set(NO_SQL):
        assert os.path.exists(os.path.join(root, NO_SQL[name].split("::")[0]))


@pytest.mark.parametrize("name", sorted(set(E.queries()) & set(E.oracle_sql())))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["patient_name", "patient_number", "admission_number"]
    assert df.count() >= 0
