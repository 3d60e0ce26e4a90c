"""Time functions on TIMESTAMP_NTZ.

None reads the wall clock and none depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

AsOf = datetime | str | Column

_MICROS_PER_SECOND = 1_000_000


def as_of_column(as_of: AsOf) -> Column:
    """A fixed time as a column; a Column (for example a scalar subquery) passes through."""
    if isinstance(as_of, Column):
        return as_of
    text = as_of.isoformat(sep=" ") if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp_ntz")


def bucket_start(ts: Column, minutes: int) -> Column:
    """Start of the fixed-width bucket that holds ``ts``; widths that divide a day start over at midnight."""
    return F.window(ts, f"{minutes} minutes")["start"]


def hour_start(ts: Column) -> Column:
    # date_trunc would go through the session time zone and return a zoned TIMESTAMP.
    return bucket_start(ts, 60)


def minute_of_hour(ts: Column) -> Column:
    return F.minute(ts).cast("bigint")


def minutes_later(ts: Column, minutes: int | Column) -> Column:
    count = minutes if isinstance(minutes, Column) else F.lit(minutes)
    return ts + F.make_dt_interval(mins=count.cast("int"))


def run_end(ts: Column, minutes: int) -> Column:
    """The time of the periodic run that takes what came at ``ts``: the end of the interval that excludes its start."""
    return minutes_later(bucket_start(ts - F.make_dt_interval(secs=F.lit(0.000001)), minutes), minutes)


def days_before(ts: Column, days: int) -> Column:
    """The instant exactly ``days`` times 24 hours before ``ts``."""
    return ts - F.make_dt_interval(days=F.lit(days))


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def age_minutes(ts: Column, as_of: AsOf) -> Column:
    """Minutes from ``ts`` to ``as_of``; negative for future times."""
    gap = as_of_column(as_of) - ts
    return gap.cast("interval second").cast("decimal(20,6)").cast("double") / F.lit(60.0)


def in_calendar_lookback(ts: Column, as_of: AsOf, days: int) -> Column:
    """On the day of ``as_of`` or one of the ``days`` calendar days before it, and not after ``as_of``."""
    now = as_of_column(as_of)
    return (day_of(ts) >= F.date_sub(day_of(now), days)) & (ts <= now)


def in_rolling_window(ts: Column, as_of: AsOf, days: int) -> Column:
    """Within ``days`` times 24 hours up to ``as_of``, both ends included."""
    now = as_of_column(as_of)
    return ts.between(days_before(now, days), now)


def as_instant(ts: Column) -> Column:
    """NTZ read as UTC, as the zoned TIMESTAMP that event-time watermarks need."""
    days = F.unix_date(day_of(ts)).cast("bigint")
    second_of_day = F.hour(ts) * F.lit(3600) + F.minute(ts) * F.lit(60)
    micros = (F.extract(F.lit("SECOND"), ts) * F.lit(_MICROS_PER_SECOND)).cast("bigint")
    return F.timestamp_micros(
        (days * F.lit(86_400) + second_of_day) * F.lit(_MICROS_PER_SECOND) + micros
    )


def from_instant(instant: Column) -> Column:
    """Zoned TIMESTAMP back to NTZ in UTC."""
    micros = F.unix_micros(instant).cast("decimal(20,0)")
    seconds = (micros / F.lit(_MICROS_PER_SECOND)).cast("decimal(18,6)")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=seconds)
