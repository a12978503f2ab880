"""Every registered query equals its DuckDB oracle on the sf0.001 tables."""

import pytest

from annuity.plans.queries import QUERIES, TEST_CONFIG, TEST_CONFIG_MONTHLY
from annuity.verify.compare import compare, duck
from annuity.verify.oracle_sql import oracle_queries

SQL = oracle_queries(TEST_CONFIG, TEST_CONFIG_MONTHLY)


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)


@pytest.fixture(scope="module")
def con(sf_small):
    return duck(sf_small)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, sf_small, name):
    result = compare(spark, con, name, QUERIES[name], SQL[name], sf_small)
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["values_match"], result


def test_entry_runs(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["record"]
    assert df.count() > 0
