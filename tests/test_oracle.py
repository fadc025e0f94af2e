"""Every registered query that has DuckDB SQL against it on sf0.001 (the driver does sf0.01).  The library's own
queries all have SQL; training-data queries that SQL cannot express are tested in ``tests/llm``."""

import pytest

import __spark_entry__ as E
from lakecheck.plans.queries import QUERIES as CORE
from oracle_compare import compare, duck

from conftest import SF_SMALL

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(CORE) <= set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL, con)
    assert r["match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1 and set(df.columns) >= {"run_id", "overall_status", "total_mismatches"}
