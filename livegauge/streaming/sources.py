"""Streams of landed observations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from livegauge.schemas import OBSERVATIONS

def stream_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of the same application with settings for streams.

    Micro-batches are small beside batch jobs, so their shuffles have a number of partitions of their own: by default one per core. The
    jobs keep no state in Spark; batches without rows are skipped, since they write nothing.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    own.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    return own


def observation_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = OBSERVATIONS,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a landing folder, oldest first."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)
