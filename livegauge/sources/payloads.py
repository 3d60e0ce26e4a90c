"""Landed pages and API replies."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.functions.clock import AsOf, as_of_column, minutes_later
from livegauge.schemas import LANDED_PAGES, LANDED_REPLIES, PAGES, REPLIES
from livegauge.sources.tables import read_batches, read_table


def landed_in(df: DataFrame, as_of: AsOf, minutes: int) -> DataFrame:
    """Payloads that landed in the ``minutes`` up to and with ``as_of``: those of one run. Reaches the scan as a range."""
    now = as_of_column(as_of)
    return df.filter((F.col("landed") > minutes_later(now, -minutes)) & (F.col("landed") <= now))


def landed_pages(spark: SparkSession, path: str, as_of: datetime, minutes: int) -> DataFrame:
    """The pages that one run takes from a landing table (``sinks.tables.append_batch`` by ``landed``). Only the folders of its
    dates are listed; a page that could not be fetched has no text and is left out."""
    dates = (as_of - timedelta(minutes=minutes)).date(), as_of.date()
    found = landed_in(read_batches(spark, path, LANDED_PAGES, *dates), as_of, minutes)
    return found.filter(F.col("html").isNotNull()).select(*PAGES.names)


def landed_replies(spark: SparkSession, path: str, as_of: datetime, minutes: int) -> DataFrame:
    """The replies that one run takes from a landing table."""
    dates = (as_of - timedelta(minutes=minutes)).date(), as_of.date()
    return landed_in(read_batches(spark, path, LANDED_REPLIES, *dates), as_of, minutes).select(*REPLIES.names)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Landed pages; a page that could not be fetched has no text and is left out."""
    return read_table(spark, path, PAGES, fmt).filter(F.col("html").isNotNull())


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """One page per UTF-8 text file; the file name without extension is the channel name."""
    files = spark.read.text(path, wholetext=True).withColumn("url", F.input_file_name())
    name = F.regexp_extract("url", r"([^/]+?)(?:\.[^./]*)?$", 1)
    return files.select(F.url_decode(name).alias("name"), "url", F.col("value").alias("html"))


def read_replies(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, REPLIES, fmt)
