"""Every named query against DuckDB on the same tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as contract
from pulselog.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), duck, ORACLES[name]) is None


def test_every_query_has_a_check():
    assert set(QUERIES) == set(ORACLES)
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_word_count_is_ordered(spark, sf_dir):
    counts = [row["count"] for row in QUERIES["word_count"](spark, sf_dir).collect()]
    assert counts == sorted(counts, reverse=True)
