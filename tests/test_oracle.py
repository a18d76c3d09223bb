"""Every registered query with a SQL equivalent gives the same rows as that SQL."""

import pytest

import __spark_entry__ as entry_point
import oracle

ORACLES = entry_point.oracle_sql()
QUERIES = entry_point.queries()


@pytest.fixture(scope="module")
def con(sf):
    return oracle.connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, con, name):
    assert oracle.compare(QUERIES[name](spark, sf), con, ORACLES[name]) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1
