"""Joins of snapshots and report rows to their comparison values, and report filters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.functions.labels import sections_of
from livegauge.functions.stats import diff_or_zero, fill_rate
from livegauge.settings import DEFAULTS, Settings


def snapshot_join(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Current rows left join previous counts on link alone. NULL links find nothing; names that share a
    link each meet every previous row of it."""
    earlier = previous.select("link", F.col("online").alias("previous_online"))
    return current.join(earlier, "link", "left").withColumn(
        "online_diff", diff_or_zero(F.col("online"), F.col("previous_online"))
    )


def join_baseline(live: DataFrame, stats: DataFrame) -> DataFrame:
    """Live rows left join statistics on name, so a name with two platforms meets both."""
    return live.join(stats, "name", "left")


def join_rates(rows: DataFrame, verdict: DataFrame, missing: int = DEFAULTS.missing_rate) -> DataFrame:
    """Report rows left join rates on name: a name with several rates takes each of them on every row."""
    rates = verdict.select(F.col("name").alias("_name"), "rate_online_ci")
    joined = rows.join(rates, F.col("name").eqNullSafe(F.col("_name")), "left").drop("_name")
    return joined.withColumn("rate_online_ci", fill_rate(F.col("rate_online_ci"), missing))


def join_rates_by_value(
    rows: DataFrame, verdict: DataFrame, missing: int = DEFAULTS.missing_rate
) -> DataFrame:
    """Report rows left join the rates of their own count, on name and online."""
    rates = verdict.select(
        F.col("name").alias("_name"), F.col("online").alias("_online"), "rate_online_ci"
    ).distinct()
    same = F.col("name").eqNullSafe(F.col("_name")) & F.col("online").eqNullSafe(F.col("_online"))
    joined = rows.join(rates, same, "left").drop("_name", "_online")
    return joined.withColumn("rate_online_ci", fill_rate(F.col("rate_online_ci"), missing))


def report_thresholds(rows: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    return rows.filter(
        (F.col("online") > settings.min_online) & (F.col("rate_online_ci") > settings.min_rate)
    )


def split_by_platform(rows: DataFrame) -> DataFrame:
    """Rows with the ``section`` their link belongs to, in one pass: a link that fits both sections appears in
    both, one that fits none in neither."""
    return rows.withColumn("section", F.explode(sections_of(F.col("link"))))
