"""Time buckets: maxima per bucket, bucket ranks and the newest snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livegauge.functions.clock import bucket_start, day_of
from livegauge.operators.channels import with_platform


def with_bucket(df: DataFrame, minutes: int = 10, ts: str = "datetime") -> DataFrame:
    return df.withColumn("bucket", bucket_start(F.col(ts), minutes))


def bucket_max(observations: DataFrame, minutes: int = 10) -> DataFrame:
    """Largest count per name, link and bucket; repeats within a bucket collapse.

    The platform follows from the link, so it is added after the aggregate instead of being shuffled. Counts
    are combined before the shuffle: a name or bucket with most of the rows sends one row per task and cell.
    """
    cells = (
        with_bucket(observations.select("name", "link", "online", "datetime"), minutes)
        .groupBy("name", "link", "bucket")
        .agg(F.max("online").alias("online"))
    )
    return with_platform(cells).select("name", "link", "platform", "bucket", "online")


def distinct_buckets(observations: DataFrame, minutes: int = 10) -> DataFrame:
    """The buckets that hold at least one row; reads the time column alone."""
    return with_bucket(observations.select("datetime"), minutes).select("bucket").distinct()


def rank_buckets(observations: DataFrame, minutes: int = 10) -> DataFrame:
    """Observations with the dense rank of their bucket, newest first.

    Only the distinct buckets are ranked, at most one row per bucket width of time covered, never the rows. The join
    carries no hint: adaptive execution broadcasts the bucket table once it has seen that it is small.
    """
    newest_first = Window.orderBy(F.desc("bucket"))
    ranks = distinct_buckets(observations, minutes).withColumn(
        "bucket_rank", F.row_number().over(newest_first)
    )
    return with_bucket(observations, minutes).join(ranks, "bucket")


def with_previous_bucket(cells: DataFrame, buckets: DataFrame) -> DataFrame:
    """Cells with the latest earlier bucket that holds any row."""
    previous = buckets.withColumn("previous", F.lag("bucket").over(Window.orderBy("bucket")))
    return cells.join(previous, "bucket")


def newest_buckets(observations: DataFrame, minutes: int = 10, count: int = 2) -> DataFrame:
    return distinct_buckets(observations, minutes).orderBy(F.desc("bucket")).limit(count)


def newest_time(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """One row with the newest time as ``newest``; of a table partitioned by date, only its last date is read."""
    if "obs_date" in df.columns:
        df = df.filter(F.col("obs_date") == df.agg(F.max("obs_date")).scalar())
    return df.agg(F.max(ts).alias("newest"))


def newest_batch(df: DataFrame, ts: str = "datetime") -> DataFrame:
    """All rows of the newest time: rank 1 without ranking."""
    newest = newest_time(df, ts).scalar()
    if "obs_date" in df.columns:
        df = df.filter(F.col("obs_date") == day_of(newest))
    return df.filter(F.col(ts) == newest)


def from_day(df: DataFrame, ts: Column) -> DataFrame:
    """Skip the date partitions before ``ts`` of a table that has them."""
    return df.filter(F.col("obs_date") >= day_of(ts)) if "obs_date" in df.columns else df


def newest_two_snapshots(observations: DataFrame, minutes: int = 10) -> DataFrame:
    """Bucket maxima of the newest non-empty bucket (``snapshot`` 1) and the one before it (2).

    The starts of the two buckets come first, from the time column alone, and reach the scans of the rows as
    time ranges. The two starts are separate subqueries of different shape: Spark would merge like ones into a
    struct, and a struct field is not pushed down.
    """
    newest = observations.agg(F.max("datetime").alias("newest"))
    newest = newest.select(bucket_start(F.col("newest"), minutes)).scalar()
    older = newest_buckets(observations, minutes).agg(F.min("bucket")).scalar()
    ts = F.col("datetime")
    current = from_day(observations, newest).filter(ts >= newest)
    previous = from_day(observations, older).filter((ts >= older) & (ts < newest))
    return (
        bucket_max(current, minutes)
        .withColumn("snapshot", F.lit(1))
        .unionByName(bucket_max(previous, minutes).withColumn("snapshot", F.lit(2)))
    )
