"""Every registered query against DuckDB on the same files."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from queries import ORACLES, QUERIES
from tests.conftest import SMALL
from tests.oracle import connect, difference


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.fixture(scope="module")
def wider(tmp_path_factory):
    """The same files with events before and after the month that the given ones cover, some of them after the run time."""
    folder = tmp_path_factory.mktemp("wider")
    for file in Path(SMALL).glob("*.parquet"):
        if file.name != "events.parquet":
            (folder / file.name).symlink_to(file)
    given, early, late = f"{SMALL}/events.parquet", "TIMESTAMP '2023-12-20 01:02:03'", "TIMESTAMP '2024-03-05 04:05:06'"
    moved = " UNION ALL ".join(
        f"(SELECT * REPLACE (event_id + {shift} AS event_id, CAST({when} + INTERVAL 7 MINUTE * (event_id % 9) AS TIMESTAMP) AS ts) "
        f"FROM '{given}' ORDER BY event_id LIMIT 40)"
        for shift, when in ((10_000_000, early), (20_000_000, late), (30_000_000, "TIMESTAMP '2024-01-31 00:03:00'"))
    )
    duckdb.sql(f"SELECT * FROM '{given}' UNION ALL {moved}").write_parquet(str(folder / "events.parquet"))
    return str(folder)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    result = QUERIES[name](spark, SMALL)
    assert difference(result, con, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql_on_other_times(spark, wider, name):
    result = QUERIES[name](spark, wider)
    assert difference(result, connect(wider), ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
