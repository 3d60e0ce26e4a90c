"""Differences between consecutive snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.functions.clock import AsOf, minutes_later
from livegauge.functions.stats import diff_or_zero
from livegauge.operators.buckets import (
    bucket_max,
    distinct_buckets,
    newest_two_snapshots,
    with_previous_bucket,
)
from livegauge.operators.extract import stamp_batch
from livegauge.operators.lookback import calendar_lookback
from livegauge.operators.rates import snapshot_join
from livegauge.schemas import DIFFS
from livegauge.settings import DEFAULTS, Settings


def snapshot_diff(observations: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS) -> DataFrame:
    """The newest snapshot within the look-back against the non-empty one before it, stamped ``as_of``.

    ``bucket`` tells the true age of the rows.
    """
    recent = calendar_lookback(observations, as_of, settings.lookback_days)
    cells = newest_two_snapshots(recent, settings.bucket_minutes)
    current = cells.filter(F.col("snapshot") == 1).drop("snapshot")
    previous = cells.filter(F.col("snapshot") == 2)
    stamped = stamp_batch(snapshot_join(current, previous), as_of)
    return stamped.select(*DIFFS.names, "bucket")


def diff_backfill(observations: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Differences of every bucket against the non-empty bucket before it, stamped with the bucket's end.

    The previous bucket is looked up on the distinct buckets; the self-join then runs on (link, bucket), which
    spreads a link with most of the rows over its buckets. Both sides read one shuffled aggregate.
    """
    minutes = settings.bucket_minutes
    cells = bucket_max(observations, minutes)
    current = with_previous_bucket(cells, distinct_buckets(observations, minutes))
    # NULL links find nothing, so they are told apart by side. With keys that are never NULL Spark infers no
    # filter for either side, and both read the same shuffled aggregate.
    earlier = cells.select(
        F.coalesce("link", F.lit("")).alias("_link"),
        F.when(F.col("link").isNull(), 2).otherwise(0).alias("_side"),
        F.col("bucket").alias("_bucket"),
        F.col("online").alias("previous_online"),
    )
    same_link = (
        (F.coalesce("link", F.lit("")) == F.col("_link"))
        & (F.when(F.col("link").isNull(), 1).otherwise(0) == F.col("_side"))
        & (F.col("previous") == F.col("_bucket"))
    )
    joined = current.join(earlier, same_link, "left")
    gap = diff_or_zero(F.col("online"), F.col("previous_online"))
    return joined.select(
        "name",
        "online",
        gap.alias("online_diff"),
        "link",
        "platform",
        minutes_later(F.col("bucket"), minutes).alias("datetime"),
        "bucket",
    )
