import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from livegauge import schemas  # noqa: E402
from livegauge.session import session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture
def make(spark):
    """Small tables of a library schema."""

    def build(schema_name, rows):
        return spark.createDataFrame(rows, getattr(schemas, schema_name))

    return build


def at(text: str) -> datetime:
    """A time of January 2024, as 'day hour:minute:second'."""
    return datetime.strptime(f"2024-01-{text}", "%Y-%m-%d %H:%M:%S")


def tuples(df, *columns):
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
