"""The operators that SQL can express, against DuckDB on the same files."""

import pytest
from livegauge.llm.queries import ORACLES, QUERIES

from tests.oracle import connect, difference

MEDIUM = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(QUERIES[name](spark, MEDIUM), connect(MEDIUM), ORACLES[name]) is None
