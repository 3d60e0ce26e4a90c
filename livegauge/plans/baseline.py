"""Rolling statistics per channel and the verdict on the newest batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livegauge.functions.clock import AsOf, as_of_column, day_of, days_before
from livegauge.functions.stats import (
    above_bound,
    margin_of_error,
    position_in_interval,
    rate_vs_mean,
    rate_vs_upper,
    sample_deviation,
)
from livegauge.operators.buckets import newest_batch
from livegauge.operators.lookback import calendar_lookback, rolling_lookback
from livegauge.operators.rates import join_baseline
from livegauge.settings import DEFAULTS, Settings


def moments(observations: DataFrame, *keys: str | Column) -> DataFrame:
    """Row count, value count, mean and population variance per key, combined before the shuffle."""
    return observations.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.count("online").alias("n_online"),
        F.avg("online").alias("mean"),
        F.var_pop("online").alias("variance"),
    )


def listings(channels: DataFrame, dedupe: bool = False) -> DataFrame:
    """How often each (name, platform) is listed."""
    copies = F.lit(1).cast("bigint") if dedupe else F.count("*")
    return channels.groupBy("name", "platform").agg(copies.alias("copies"))


def stats_from_moments(
    per_name: DataFrame, channels: DataFrame, settings: Settings = DEFAULTS
) -> DataFrame:
    """Mean, deviation, margin and interval per (name, platform).

    A name listed k times on a platform counts its history k times. Repeating values leaves mean and
    population variance as they are and only multiplies the counts, so one row per name is joined instead of
    its history. Names that are not listed have a NULL platform.
    """
    joined = per_name.join(listings(channels, settings.dedupe_channels), "name", "left")
    copies = F.coalesce(F.col("copies"), F.lit(1).cast("bigint"))
    counted = joined.select(
        "name",
        "platform",
        (F.col("n") * copies).alias("n"),
        F.col("mean").alias("avg_online"),
        sample_deviation(F.col("variance"), F.col("n_online") * copies).alias("stddev_online"),
    )
    margin = margin_of_error(F.col("stddev_online"), F.col("n"), settings.z)
    return (
        counted.withColumn("margin_of_error", margin)
        .withColumn("ci_lower_bound", F.col("avg_online") - F.col("margin_of_error"))
        .withColumn("ci_upper_bound", F.col("avg_online") + F.col("margin_of_error"))
    )


def baseline_stats(
    observations: DataFrame, channels: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS
) -> DataFrame:
    """Statistics of the rolling window that ends at ``as_of``."""
    history = rolling_lookback(observations, as_of, settings.window_days)
    return stats_from_moments(moments(history, "name"), channels, settings)


def daily_moments(observations: DataFrame) -> DataFrame:
    """Moments per name and day: a table to keep, so that a run need not read the whole window again."""
    return moments(observations, "name", day_of(F.col("datetime")).alias("day"))


def kept_day(observations: DataFrame, day: date) -> DataFrame:
    """The moments of one whole day as a table to keep, with a row of no name and no count that says the day is kept."""
    mark = observations.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("name"), F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("n_online"),
        F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("variance"), F.lit(day).alias("day"),
    )
    return daily_moments(observations.filter(day_of(F.col("datetime")) == F.lit(day))).unionByName(mark)


def merge_moments(parts: DataFrame) -> DataFrame:
    """One row per name from the moments of disjoint parts of its history.

    The window sees one row per name and day, so no group exceeds the days of the window by more than two.
    """
    name = Window.partitionBy("name")
    weight = F.col("n_online")
    mean = F.try_divide(F.sum(F.col("mean") * weight).over(name), F.sum(weight).over(name))
    centred = parts.withColumn("_mean", mean)
    spread = weight * (F.col("variance") + F.pow(F.col("mean") - F.col("_mean"), F.lit(2)))
    return centred.groupBy("name").agg(
        F.sum("n").alias("n"),
        F.sum("n_online").alias("n_online"),
        F.max("_mean").alias("mean"),
        F.try_divide(F.sum(spread), F.sum("n_online")).alias("variance"),
    )


def baseline_from_daily(
    daily: DataFrame,
    observations: DataFrame,
    channels: DataFrame,
    as_of: AsOf,
    settings: Settings = DEFAULTS,
) -> DataFrame:
    """:func:`baseline_stats` from kept daily moments.

    Only the first and the last day, which the window cuts, and days that were not kept are read from the
    observations. A kept day without rows is a day with a row of no name (:func:`kept_day`).
    """
    now = as_of_column(as_of)
    first, last = day_of(days_before(now, settings.window_days)), day_of(now)
    whole = daily.filter((F.col("day") > first) & (F.col("day") < last))
    day = day_of(F.col("datetime"))
    history = rolling_lookback(observations, as_of, settings.window_days)
    # At most the days of the window.
    kept = F.broadcast(whole.select(F.col("day").alias("_kept")).distinct())
    cut = history.join(kept, day == F.col("_kept"), "left_anti")
    whole = whole.filter(F.col("n") > 0)
    parts = whole.unionByName(daily_moments(cut)).drop("day")
    return stats_from_moments(merge_moments(parts), channels, settings)


def live_counts(diffs: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS) -> DataFrame:
    """Distinct names and counts of the newest batch within the look-back.

    A left join to the channels would only repeat rows that the distinct result takes out again.
    """
    recent = calendar_lookback(diffs, as_of, settings.lookback_days)
    return newest_batch(recent).select("name", "online").distinct()


def baseline_verdict(
    diffs: DataFrame, stats: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS
) -> DataFrame:
    """The newest batch against its statistics: gap to the mean, to the upper bound, and above-bound flag."""
    online, upper = F.col("online"), F.col("ci_upper_bound")
    joined = join_baseline(live_counts(diffs, as_of, settings), stats)
    return joined.select(
        "name",
        "online",
        "avg_online",
        rate_vs_mean(F.col("avg_online"), online).alias("rate_online"),
        above_bound(upper, online).alias("flg_top_online"),
        "margin_of_error",
        "ci_lower_bound",
        "ci_upper_bound",
        rate_vs_upper(upper, online).alias("rate_online_ci"),
    ).distinct()


def ci_position(verdict: DataFrame) -> DataFrame:
    """Where each count lies relative to its interval."""
    return verdict.withColumn(
        "ci_position",
        position_in_interval(F.col("online"), F.col("ci_lower_bound"), F.col("ci_upper_bound")),
    )
