"""Every catalog query with an oracle matches DuckDB on the smallest driver tables."""

import pytest

from conftest import SF_SMALL
from tools.oracle_check import compare, duck

import __spark_entry__ as entry

ORACLES = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["book_id", "title", "closest", "closest_title", "sim"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF_SMALL)
    assert r["ok"], r["note"]
