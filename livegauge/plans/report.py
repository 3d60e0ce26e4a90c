"""The graded report and its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livegauge.functions import labels
from livegauge.functions.clock import AsOf, age_minutes, as_of_column
from livegauge.operators.buckets import newest_batch, newest_time
from livegauge.operators.lookback import calendar_lookback
from livegauge.operators.ordering import join_lines, report_order, with_position
from livegauge.operators.rates import join_rates, join_rates_by_value, report_thresholds, split_by_platform
from livegauge.settings import DEFAULTS, Settings

TIES = ("online_diff", "rate_online_ci", "section")


def report_rows(diffs: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS) -> DataFrame:
    """The newest batch among the rows above the ranking threshold, within the look-back."""
    recent = calendar_lookback(diffs, as_of, settings.lookback_days)
    ranked = newest_batch(recent.filter(F.col("online") > settings.min_rank_online))
    return ranked.select("name", "online", "online_diff", "link", "platform")


def graded_report(
    diffs: DataFrame, verdict: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS
) -> DataFrame:
    """Report rows with section, rate, grade and trend."""
    join = join_rates_by_value if settings.rates_by_value else join_rates
    rated = join(report_rows(diffs, as_of, settings), verdict, settings.missing_rate)
    shown = split_by_platform(report_thresholds(rated, settings))
    return shown.withColumn("grade", labels.grade(F.col("rate_online_ci"), settings)).withColumn(
        "trend", labels.trend(F.col("online_diff"))
    )


def freshness_flag(diffs: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS) -> DataFrame:
    """One row: 1 if the newest time up to ``as_of`` is less than ten minutes old, else or if there is none 0.

    Rows after ``as_of`` do not count, here as in the look-back: a run never sees what came later.
    """
    seen = diffs.filter(F.col("datetime") <= as_of_column(as_of))
    fresh = age_minutes(F.col("newest"), as_of) < settings.fresh_minutes
    return newest_time(seen).select(F.when(fresh, 1).otherwise(0).alias("flag"))


def rendered_line() -> Column:
    columns = ("name", "link", "online", "online_diff", "grade", "trend")
    return labels.line(*[F.col(column) for column in columns])


def report_lines(report: DataFrame, path: str | None = None) -> DataFrame:
    """Section, position and text of every line of the report; any length, over all tasks. ``path``: see :func:`with_position`."""
    placed = with_position(report, report_order(*TIES), path)
    return placed.select("section", "position", rendered_line().alias("line"))


def report_message(
    report: DataFrame, diffs: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS
) -> DataFrame:
    """The report as one text, in one row."""
    return message_of_lines(report_lines(report), diffs, as_of, settings)


def message_of_lines(lines: DataFrame, diffs: DataFrame, as_of: AsOf, settings: Settings = DEFAULTS) -> DataFrame:
    """The one text of lines that are stored already. A chat message is one value; the lines are the table of any length."""
    blocks = join_lines(lines).agg(
        *[
            F.max(F.when(F.col("section") == name, F.col("lines"))).alias(name)
            for name in labels.SECTIONS
        ]
    )
    flag = freshness_flag(diffs, as_of, settings).scalar()
    return blocks.select(
        as_of_column(as_of).alias("datetime"),
        labels.message(flag, F.col("youtube"), F.col("twitch")).alias("message"),
    )


def latest_report(reports: DataFrame) -> DataFrame:
    """The message id of the newest report that was sent, or no row."""
    distinct = reports.filter(F.col("chat_message_id").isNotNull()).select("datetime", "chat_message_id").distinct()
    return distinct.orderBy(F.desc("datetime"), F.desc("chat_message_id")).limit(1)
