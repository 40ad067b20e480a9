"""Every query with an oracle, value for value; the others return rows."""

import pytest
from compare import SMALL, connect, differences

import __spark_entry__ as entry_point

QUERIES = entry_point.queries()
ORACLES = entry_point.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, sf_dir, con, name):
    errors, _ = differences(QUERIES[name](spark, sf_dir), con, ORACLES[name])
    assert not errors


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    rows = entry_point.entry(spark).collect()
    assert sum(row["engines"] for row in rows) == 26
