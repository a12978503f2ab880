"""Queries with SQL against DuckDB; all queries on edge cases and empty tables; no Python in native plans."""

import duckdb
import pytest

from annuity.llm.queries import QUERIES, oracle_queries
from annuity.verify import compare as verify

SQL = oracle_queries()
NATIVE = ("op6_license_scans", "op10_quality_rules")


def tables(folder, single):
    con = duckdb.connect()
    for name in ("documents", "embeddings", "labels", "benchmark"):
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet{'' if single else '/*.parquet'}')")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
@pytest.mark.parametrize("which", ["sf0.001", "edge"])
def test_query_matches_sql(spark, sf_small, edge_dirs, name, which):
    folder = sf_small if which == "sf0.001" else edge_dirs[0]
    result = verify.compare(spark, tables(folder, which == "sf0.001"), name, QUERIES[name], SQL[name], folder)
    assert result["columns_match"] and result["values_match"], result


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, edge_dirs, name):
    df = QUERIES[name](spark, edge_dirs[1])
    assert df.columns and df.count() == 0


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL) - {"op1_best_fit_packing"}))
def test_one_row_per_document(spark, edge_dirs, edge_docs, name):
    df = QUERIES[name](spark, edge_dirs[0])
    got = sorted(str(r["doc_id"]) for r in df.collect())
    assert got == sorted(str(r["doc_id"]) for r in edge_docs.collect())


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_hold_no_python(spark, sf_small, name):
    plan = QUERIES[name](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
