"""Stored tables and queries over them."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livegauge.batches import Mark, live

BATCH_COLUMNS = (("obs_date", T.DateType()), ("batch_id", T.LongType()))


def read_table(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """A stored table with its fixed schema; no inference pass over the files."""
    return spark.read.schema(schema).format(fmt).load(path)


def read_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    first: date | None = None,
    last: date | None = None,
    days: Iterable[date] | None = None,
) -> DataFrame:
    """A table written batch by batch (see ``sinks.tables``), with its date and batch as columns; every batch as a whole or not at all.

    With ``first`` and ``last``, or with ``days``, only the folders of those dates are listed: a job that runs every ten
    minutes must not list years of batches.
    """
    if days is None and first is not None and last is not None:
        days = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    return read_marked(spark, path, schema, live(spark, path, days))


def read_marked(spark: SparkSession, path: str, schema: T.StructType, marks: list[Mark]) -> DataFrame:
    """The rows that some marks of a table stand for."""
    full = T.StructType(schema.fields + [T.StructField(n, t, True) for n, t in BATCH_COLUMNS])
    if not marks:
        return spark.createDataFrame([], full)
    reader = spark.read.schema(T.StructType([*full.fields, T.StructField("attempt", T.StringType(), True)]))
    return reader.option("basePath", path).parquet(*[mark.folder(path) for mark in marks]).select(*full.names)


def read_query(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL text; ``{name}`` in it stands for the DataFrame passed under that name."""
    return spark.sql(query, **tables)


def jdbc_options(
    url: str,
    query: str,
    split_column: str,
    lower: str,
    upper: str,
    partitions: int,
    **connection: str,
) -> dict[str, str]:
    """Options that read a database query in parallel ranges of one column instead of in one task.

    Rows outside ``lower``..``upper`` are still read, by the first and last task.
    """
    return {
        **connection,
        "url": url,
        "dbtable": f"({query}) AS source",
        "partitionColumn": split_column,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, **options: str) -> DataFrame:
    """A database query; build the options with :func:`jdbc_options`."""
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def between_dates(df: DataFrame, first, last, date_column: str = "obs_date") -> DataFrame:
    """Keep the date partitions ``first``..``last`` of a partitioned table; others pass unchanged."""
    if date_column not in df.columns:
        return df
    return df.filter(F.col(date_column).between(first, last))
