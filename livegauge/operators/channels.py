"""The channel dimension and the joins to it.

No join here carries a broadcast hint: the dimension grows with the number of channels, so Spark broadcasts it
only under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with adaptive skew splitting for
names that hold many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.functions.labels import platform_of


def on_platform(channels: DataFrame, platform: str) -> DataFrame:
    return channels.filter(F.col("platform") == platform)


def fill_flag(channels: DataFrame, column: str = "big_stream", default: str = "no") -> DataFrame:
    return channels.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def active(channels: DataFrame) -> DataFrame:
    return channels.filter(F.col("actual") == "yes")


def youtube_channels(channels: DataFrame) -> DataFrame:
    """Active youtube channels with the flag filled."""
    return active(fill_flag(on_platform(channels, "youtube"))).select("name", "link", "big_stream")


def twitch_channels(channels: DataFrame) -> DataFrame:
    """Twitch channels, active or not; ``big_stream`` holds their login."""
    return on_platform(channels, "twitch").select("name", "link", F.col("big_stream").alias("login"))


def join_login(counts: DataFrame, twitch: DataFrame) -> DataFrame:
    """Counts left join channels on login; repeated logins multiply. A NULL login names no channel and finds none."""
    listed = twitch.withColumnRenamed("login", "_login")
    return counts.join(listed, F.col("login") == F.col("_login"), "left").drop("_login")


def join_channel_history(observations: DataFrame, channels: DataFrame) -> DataFrame:
    """Observations left join channels on name: a name listed twice repeats its whole history.

    :func:`livegauge.plans.baseline.baseline_stats` gives the statistics over the joined rows without repeating any row.
    """
    listed = channels.select(
        F.col("name").alias("_name"), "platform", F.col("link").alias("channel_link")
    )
    return observations.join(listed, F.col("name") == F.col("_name"), "left").drop("_name")


def with_platform(df: DataFrame) -> DataFrame:
    return df.withColumn("platform", platform_of(F.col("link")))
