"""The back-fill kept up to date: late rows make only the dates be computed again whose differences they can change.

A late row changes its own bucket and, through the value it leaves there or by being the first in it, the next bucket that holds any row. The table is kept by date, so the dates of both
are computed again, from their own rows and those of the date with rows before each. No other date is listed.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.batches import live, marks, neighbour, written_days
from livegauge.functions.clock import day_of
from livegauge.operators.buckets import with_bucket
from livegauge.plans.snapshot import diff_backfill
from livegauge.schemas import BACKFILL, OBSERVATIONS
from livegauge.settings import DEFAULTS, Settings
from livegauge.sinks.tables import replace_days
from livegauge.sources.tables import read_batches, read_marked


def _last_buckets(rows: DataFrame, minutes: int) -> dict[date, object]:
    """The last bucket of each date that has rows: one row per date, from the time column alone."""
    buckets = with_bucket(rows.select("datetime"), minutes).where(F.col("bucket").isNotNull())
    found = buckets.groupBy(day_of(F.col("bucket")).alias("day")).agg(F.max("bucket").alias("last"))
    return {row["day"]: row["last"] for row in found.collect()}


def changed_days(spark: SparkSession, observations_path: str, batches: Iterable[int], settings: Settings = DEFAULTS) -> list[date]:
    """The dates whose differences the rows of these batches can have changed, in order.

    They are the dates of the batches, and the next date with rows after one whose last bucket a batch has rows in. A batch that replaced an earlier attempt may
    have taken rows away, so the dates of all its attempts count, each with the next.
    """
    found, touches_next = set(), set()
    for batch in batches:
        days = {date.fromisoformat(day) for day in written_days(spark, observations_path, batch)}
        own = [m for m in marks(spark, observations_path, None, batch) if m.day[0].isdigit()]
        days |= {date.fromisoformat(m.day) for m in own}
        found |= days
        if any(not m.attempt.startswith("000001") for m in own) or not own:
            touches_next |= days
            continue
        of_days = live(spark, observations_path, days)
        late, whole = (
            _last_buckets(read_marked(spark, observations_path, OBSERVATIONS, chosen), settings.bucket_minutes)
            for chosen in ([m for m in of_days if m.batch == batch], of_days)
        )
        touches_next |= {day for day in days if late.get(day) == whole.get(day)}
    return sorted(found | {after for day in touches_next if (after := neighbour(spark, observations_path, day, 1))})


def sources_of(spark: SparkSession, observations_path: str, days: list[date]) -> list[date]:
    """The dates to read for the differences of ``days``: these and the date with rows before each."""
    before = {first for day in days if (first := neighbour(spark, observations_path, day, -1))}
    return sorted(before | set(days))


def differences_of(spark: SparkSession, observations_path: str, days: list[date], settings: Settings = DEFAULTS) -> DataFrame:
    """The back-fill's rows of some dates."""
    rows = read_batches(spark, observations_path, OBSERVATIONS, days=sources_of(spark, observations_path, days))
    return diff_backfill(rows, settings).filter(day_of(F.col("bucket")).isin(days)).select(*BACKFILL.names)


def refresh_backfill(
    spark: SparkSession,
    observations_path: str,
    backfill_path: str,
    batches: Iterable[int] | None = None,
    settings: Settings = DEFAULTS,
) -> list[date]:
    """Bring the stored back-fill up to date after some batches of observations were written, or make it whole without ``batches``.

    The dates are replaced all at once. May be repeated; returns the dates computed."""
    if batches is None:
        days = sorted({date.fromisoformat(m.day) for m in live(spark, observations_path) if m.day[0].isdigit()})
    else:
        days = changed_days(spark, observations_path, batches, settings)
    if days:
        replace_days(differences_of(spark, observations_path, days, settings), backfill_path, BACKFILL, days, ts="bucket")
    return days
