"""Batch appends to tables partitioned by date.

A batch that is run again replaces all its own rows and no others, those too on dates that the new result has no rows for; a failed
write raises. Readers see a batch, of however many dates, as a whole or not at all (see ``livegauge.batches``).
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livegauge.batches import Attempt, live
from livegauge.functions.clock import AsOf, as_of_column, day_of
from livegauge.schemas import REPORTS
from livegauge.sources.tables import read_batches, read_marked


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` by name and type, with empty text as NULL."""
    columns = []
    for field in schema.fields:
        value = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            value = F.nullif(value, F.lit(""))
        columns.append(value.cast(field.dataType).alias(field.name))
    return df.select(*columns)


def _write(df: DataFrame, folder: str, schema: T.StructType, ts: str) -> None:
    """Write rows by date. The rebalance hint lets adaptive execution even out file sizes: it merges small dates and splits a date
    that holds most of the rows.
    """
    (
        conform(df, schema)
        .withColumn("obs_date", day_of(F.col(ts)))
        .hint("rebalance", "obs_date")
        .write.partitionBy("obs_date")
        .parquet(folder)
    )


def append_batch(
    df: DataFrame, path: str, schema: T.StructType, batch_id: int, ts: str = "datetime"
) -> None:
    """Write one batch, partitioned by the date of ``ts``, in place of all that was written under its number. ``df`` may read the batch it replaces."""
    attempt = Attempt(df.sparkSession, path, batch_id)
    _write(df, attempt.folder, schema, ts)
    attempt.publish()


def replace_days(df: DataFrame, path: str, schema: T.StructType, days: list[date], ts: str = "datetime") -> None:
    """Write rows of some dates in place of all that the table holds of them, on all of them at once: a table that is kept by date, not by batch."""
    attempt = Attempt(df.sparkSession, path, 0)
    _write(df, attempt.folder, schema, ts)
    attempt.publish(only=days)


def compact(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    day: date,
    ts: str = "datetime",
    merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Rewrite the batches of one past day as few files, under the number of the newest of them. None of them can be repeated afterwards.

    One mark replaces all of theirs, so a reader sees every row once at any moment, and a run that was stopped is simply repeated. ``merge`` may
    combine rows, where readers would combine them anyway.
    """
    replaced = live(spark, path, [day])
    if len(replaced) < 2:
        return
    attempt = Attempt(spark, path, max(mark.batch for mark in replaced))
    found = read_marked(spark, path, schema, replaced)
    _write(merge(found.select(*schema.names)), attempt.folder, schema, ts)
    attempt.publish_merged(day, replaced)


def log_report(message: DataFrame, path: str, as_of: AsOf, batch_id: int) -> None:
    """Append a report, as yet without the id that the chat gives it when it is sent."""
    row = message.select(as_of_column(as_of).alias("datetime"), F.lit(None).cast("string").alias("chat_message_id"), "message")
    append_batch(row, path, REPORTS, batch_id)


def log_sent(spark: SparkSession, path: str, chat_message_id: str, as_of: datetime, batch_id: int) -> None:
    """Add the chat's id to the report logged under ``batch_id``, which is not computed again."""
    logged = read_batches(spark, path, REPORTS, as_of.date(), as_of.date()).filter(F.col("batch_id") == batch_id)
    append_batch(logged.select(*REPORTS.names).withColumn("chat_message_id", F.lit(chat_message_id)), path, REPORTS, batch_id)
