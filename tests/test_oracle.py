"""Every query with SQL gives the rows of its SQL; fitted models are tested on planted input elsewhere."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    assert differences(spark, con, QUERIES[name], ORACLES[name], FOLDER) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"source", "rank", "term", "weight"}
