"""Queries that SQL can express, against DuckDB."""

import pytest
from compare import connect, differences

from pulselog.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLES[name]) is None
