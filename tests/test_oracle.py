"""Every registered query equals its DuckDB oracle at sf0.01 (order-insensitive)."""

import pytest

import __spark_entry__ as E
from conftest import SF01
from oracle_check import compare, duck
from sluice.queries.registry import oracle_queries, registered_queries

QUERIES = registered_queries()
ORACLE = oracle_queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    n, problems = compare(spark, con, name, QUERIES[name], ORACLE[name], SF01)
    assert not problems, problems


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                          "o_orderdate", "o_orderpriority"]
