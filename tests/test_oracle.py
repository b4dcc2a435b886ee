"""Every registered query against its DuckDB oracle on the driver tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck
from rivulet.plans.catalog import BATCH_QUERIES
from rivulet.plans.oracle import SQL
from rivulet.streaming.catalog import STREAM_QUERIES

QUERIES = {**BATCH_QUERIES, **STREAM_QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_oracle():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(BATCH_QUERIES))
def test_batch_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["hash_match"], r


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(BATCH_QUERIES)))
def test_stream_query_matches_oracle(spark, con, name):
    r = compare(QUERIES[name](spark, SF_SMALL), con, SQL[name])
    assert r["hash_match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["industry", "ranking"]
    assert len(rows) > 0
