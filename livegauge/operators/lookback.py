"""Time filters. Both reach the Parquet scan as ranges, and as partition filters where the table has dates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.functions.clock import (
    AsOf,
    as_of_column,
    day_of,
    days_before,
    in_calendar_lookback,
    in_rolling_window,
)
from livegauge.sources.tables import between_dates


def calendar_lookback(df: DataFrame, as_of: AsOf, days: int = 2, ts: str = "datetime") -> DataFrame:
    """Rows of the day of ``as_of`` and the ``days`` calendar days before it, up to ``as_of``."""
    today = day_of(as_of_column(as_of))
    dated = between_dates(df, F.date_sub(today, days), today)
    return dated.filter(in_calendar_lookback(F.col(ts), as_of, days))


def rolling_lookback(df: DataFrame, as_of: AsOf, days: int = 15, ts: str = "datetime") -> DataFrame:
    """Rows from exactly ``days`` days before ``as_of`` up to it."""
    now = as_of_column(as_of)
    dated = between_dates(df, day_of(days_before(now, days)), day_of(now))
    return dated.filter(in_rolling_window(F.col(ts), as_of, days))
