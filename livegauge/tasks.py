"""The periodic tasks over stored tables, for a scheduler to call.

    spark-submit livegauge/tasks.py youtube --root ROOT --landed PAGES   --as-of '2024-01-31 00:00:00'
    spark-submit livegauge/tasks.py twitch  --root ROOT --landed REPLIES --as-of ...
    spark-submit livegauge/tasks.py diff    --root ROOT --as-of ...
    spark-submit livegauge/tasks.py report  --root ROOT --as-of ...
    spark-submit livegauge/tasks.py latest  --root ROOT --as-of ...      (prints the id of the message to replace)
    spark-submit livegauge/tasks.py sent    --root ROOT --as-of ... --message-id ID
    spark-submit livegauge/tasks.py daily   --root ROOT --as-of ...      (once a day, for the day before)
    spark-submit livegauge/tasks.py backfill --root ROOT --as-of ... [--batches N,N]   (differences of all history, or what these late batches change)
    spark-submit livegauge/tasks.py compact --root ROOT --as-of ...      (once a day, for the day before the look-back)

PAGES and REPLIES are landing tables with the time each payload was fetched; a run takes the payloads of its own interval, the
ten minutes up to ``as_of``. Each task reads its tables, appends one batch and may be repeated: the same ``as_of`` replaces the
same batch. A day is compacted once its batches are not repeated any more. Of each task one run at a time is let through.
"""

from __future__ import annotations

import argparse
import os
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from livegauge import schemas
from livegauge.batches import vacuum
from livegauge.counts import Counts
from livegauge.functions.payload import reply_count
from livegauge.plans.backfill import refresh_backfill
from livegauge.plans.baseline import (
    baseline_from_daily,
    baseline_stats,
    baseline_verdict,
    kept_day,
)
from livegauge.operators.extract import page_fields, stamp_batch
from livegauge.plans.ingest import accepted, observations_from_json, page_outcomes, rejected
from livegauge.plans.report import graded_report, latest_report, message_of_lines, report_lines
from livegauge.plans.snapshot import snapshot_diff
from livegauge.session import session
from livegauge.settings import DEFAULTS, Settings
from livegauge.sinks.tables import append_batch, compact, log_report, log_sent
from livegauge.sources.payloads import landed_pages, landed_replies
from livegauge.sources.tables import read_batches, read_table
from livegauge.storage import create, freeze, hours_old, matching, remove, rename, temporary

_OBSERVATION_TASKS = ("youtube", "twitch")
_COMPACTED = {
    "observations": schemas.OBSERVATIONS,
    "rejected": schemas.REJECTS,
    "diffs": schemas.DIFFS,
    "lines": schemas.LINES,
    "reports": schemas.REPORTS,
}


@dataclass(frozen=True)
class Tables:
    """The folders of one installation."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def channels(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.path("channels"), schemas.CHANNELS)

    def observations(self, spark: SparkSession, *dates: date) -> DataFrame:
        return read_batches(spark, self.path("observations"), schemas.OBSERVATIONS, *dates)

    def rejected(self, spark: SparkSession, *dates: date) -> DataFrame:
        return read_batches(spark, self.path("rejected"), schemas.REJECTS, *dates)

    def diffs(self, spark: SparkSession, *dates: date) -> DataFrame:
        return read_batches(spark, self.path("diffs"), schemas.DIFFS, *dates)

    def daily(self, spark: SparkSession, days: list[str]) -> DataFrame:
        """The kept moments of the given days; only their folders are listed."""
        if not days:
            return spark.createDataFrame([], schemas.DAILY)
        reader = spark.read.schema(schemas.DAILY).option("basePath", self.path("daily"))
        return reader.parquet(*[f"{self.path('daily')}/day={day}" for day in days])

    def lines(self, spark: SparkSession, *dates: date) -> DataFrame:
        return read_batches(spark, self.path("lines"), schemas.LINES, *dates)

    def reports(self, spark: SparkSession, *dates: date) -> DataFrame:
        return read_batches(spark, self.path("reports"), schemas.REPORTS, *dates)


def days_back(as_of: datetime, days: int) -> tuple[date, date]:
    """The date ``days`` before ``as_of``, and its own."""
    return (as_of - timedelta(days=days)).date(), as_of.date()


def batch_number(as_of: datetime, source: int = 0) -> int:
    """Seconds of ``as_of`` since 1970, with a digit for the source: one number per task and run."""
    return int(as_of.replace(tzinfo=timezone.utc).timestamp()) * 10 + source


def ingest(
    spark: SparkSession, tables: Tables, platform: str, landed: str, as_of: datetime, settings: Settings = DEFAULTS
) -> dict[str, int]:
    """Append the observations of the payloads of one platform that landed in the run's own interval, and return the run's counts.

    Pages are read once: what became of every live page is written aside, small, and both tables are made from it. Live pages that
    gave no observation go to ``rejected`` with the reason, under the same batch number. Counts: ``read`` payloads, ``live`` ones among
    them, ``written`` observations, and for pages ``rejected``.
    """
    channels, minutes, counts = tables.channels(spark), settings.bucket_minutes, Counts()
    number = batch_number(as_of, _OBSERVATION_TASKS.index(platform))
    if platform == "twitch":
        replies = counts.of(landed_replies(spark, landed, as_of, minutes), read=None, live=reply_count(F.col("body")) > 0)
        rows = counts.of(observations_from_json(replies, channels, as_of), written=None)
        append_batch(rows, tables.path("observations"), schemas.OBSERVATIONS, number)
        return counts.get()
    pages = counts.of(landed_pages(spark, landed, as_of, minutes), read=None)
    outcomes = page_outcomes(channels, counts.of(page_fields(pages), live=None), as_of)
    refused = F.col("reason").isNotNull()
    with temporary(spark, "outcomes") as aside:
        outcomes = freeze(counts.of(outcomes, written=~refused, rejected=refused), aside)
        append_batch(accepted(outcomes), tables.path("observations"), schemas.OBSERVATIONS, number)
        append_batch(rejected(outcomes), tables.path("rejected"), schemas.REJECTS, number)
    return counts.get()


def diff(spark: SparkSession, tables: Tables, as_of: datetime, settings: Settings = DEFAULTS) -> None:
    """Append the differences of the newest snapshot."""
    recent = tables.observations(spark, *days_back(as_of, settings.lookback_days))
    rows = snapshot_diff(recent, as_of, settings)
    append_batch(rows, tables.path("diffs"), schemas.DIFFS, batch_number(as_of))


def daily(spark: SparkSession, tables: Tables, as_of: datetime) -> None:
    """Keep the moments of the day before ``as_of``; repeat it for a day that got late rows."""
    day, _ = days_back(as_of, 1)
    path = f"{tables.path('daily')}/day={day.isoformat()}"
    kept_day(tables.observations(spark, day, day), day).drop("day").write.mode("overwrite").parquet(path)


def _stats(spark: SparkSession, tables: Tables, as_of: datetime, settings: Settings, use_daily: bool) -> DataFrame:
    channels = tables.channels(spark)
    first, last = days_back(as_of, settings.window_days)
    if not use_daily:
        return baseline_stats(tables.observations(spark, first, last), channels, as_of, settings)
    window = [first + timedelta(days=n) for n in range((last - first).days + 1)]
    kept = {folder.rpartition("day=")[2] for folder in matching(spark, f"{tables.path('daily')}/day=*")}
    # The two days the window cuts, and those that no daily run has kept.
    listed = [day for day in window if day in (first, last) or day.isoformat() not in kept]
    whole = sorted(kept & {day.isoformat() for day in window} - {day.isoformat() for day in listed})
    observations = read_batches(spark, tables.path("observations"), schemas.OBSERVATIONS, days=listed)
    daily = tables.daily(spark, whole)
    return baseline_from_daily(daily, observations, channels, as_of, settings)


def report(
    spark: SparkSession,
    tables: Tables,
    as_of: datetime,
    settings: Settings = DEFAULTS,
    use_daily: bool = False,
) -> DataFrame:
    """Store the lines of the newest batch's report, log its text, and return the logged row."""
    diffs = tables.diffs(spark, *days_back(as_of, settings.lookback_days))
    verdict = baseline_verdict(diffs, _stats(spark, tables, as_of, settings, use_daily), as_of, settings)
    graded, number = graded_report(diffs, verdict, as_of, settings), batch_number(as_of)
    with temporary(spark, "positions") as aside:
        lines = stamp_batch(report_lines(graded, aside), as_of)
        append_batch(lines, tables.path("lines"), schemas.LINES, number)
    stored = tables.lines(spark, as_of.date(), as_of.date()).filter(F.col("batch_id") == number)
    log_report(message_of_lines(stored, diffs, as_of, settings), tables.path("reports"), as_of, number)
    logged = tables.reports(spark, as_of.date(), as_of.date())
    return logged.filter(F.col("batch_id") == number).select(*schemas.REPORTS.names)


def sent(spark: SparkSession, tables: Tables, as_of: datetime, chat_message_id: str) -> None:
    """Add the id that the chat gave the report of ``as_of``, which is stored already."""
    log_sent(spark, tables.path("reports"), chat_message_id, as_of, batch_number(as_of))


def latest(spark: SparkSession, tables: Tables, as_of: datetime, settings: Settings = DEFAULTS) -> str | None:
    """The id of the newest report sent within the look-back: the message that the next one replaces."""
    rows = latest_report(tables.reports(spark, *days_back(as_of, settings.lookback_days))).take(1)
    return rows[0]["chat_message_id"] if rows else None


@contextmanager
def exclusive(spark: SparkSession, tables: Tables, task: str, stale_hours: float = 6) -> Iterator[None]:
    """One run of a task at a time: a marker that is created only if absent, and removed at the end.

    A second run raises. The marker of a run that died counts no more after ``stale_hours``; of the runs that find it, the one that renames it away goes on.
    """
    marker = tables.path(f"_running/{task}")
    if not create(spark, marker):
        if hours_old(spark, marker) < stale_hours:
            raise RuntimeError(f"{task} is running already; remove {marker} if it is not")
        aside = tables.path(f"_running/.{uuid.uuid4().hex}")
        rename(spark, marker, aside)
        remove(spark, aside)
        if not create(spark, marker):
            raise RuntimeError(f"{task} is running already")
    try:
        yield
    finally:
        remove(spark, marker)


def compact_day(spark: SparkSession, tables: Tables, as_of: datetime, settings: Settings = DEFAULTS) -> None:
    """Merge the batches of the day before the look-back, two files a day and platform becoming few, and remove files that no longer count."""
    day, _ = days_back(as_of, settings.lookback_days + 1)
    for name, schema in _COMPACTED.items():
        compact(spark, tables.path(name), schema, day)
        vacuum(spark, tables.path(name))


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Run one task of the live-audience job.")
    parser.add_argument("task", choices=[*_OBSERVATION_TASKS, "diff", "report", "latest", "sent", "daily", "backfill", "compact"])
    parser.add_argument("--root", required=True, help="folder of the stored tables")
    parser.add_argument("--as-of", required=True, type=datetime.fromisoformat, help="run time in UTC")
    parser.add_argument("--landed", help="landed pages or replies (youtube, twitch)")
    parser.add_argument("--message-id", help="id the chat gave the report (sent)")
    parser.add_argument("--batches", help="numbers of late batches, comma-separated (backfill)")
    parser.add_argument("--use-daily", action="store_true", help="take whole days from kept moments (report)")
    chosen = parser.parse_args(arguments)
    if chosen.task in _OBSERVATION_TASKS and not chosen.landed:
        parser.error(f"{chosen.task} needs --landed")
    if chosen.task == "sent" and not chosen.message_id:
        parser.error("sent needs --message-id")

    spark, tables = session(f"livegauge-{chosen.task}"), Tables(chosen.root)
    if chosen.task == "latest":
        print(latest(spark, tables, chosen.as_of) or "")
        return
    with exclusive(spark, tables, chosen.task):
        _run(spark, tables, chosen)


def _run(spark: SparkSession, tables: Tables, chosen: argparse.Namespace) -> None:
    if chosen.task in _OBSERVATION_TASKS:
        counts = ingest(spark, tables, chosen.task, chosen.landed, chosen.as_of)
        print(" ".join(f"{name}={n}" for name, n in counts.items()))
    elif chosen.task == "diff":
        diff(spark, tables, chosen.as_of)
    elif chosen.task == "daily":
        daily(spark, tables, chosen.as_of)
    elif chosen.task == "backfill":
        numbers = [int(n) for n in chosen.batches.split(",")] if chosen.batches else None
        days = refresh_backfill(spark, tables.path("observations"), tables.path("backfill"), numbers)
        print(" ".join(day.isoformat() for day in days))
    elif chosen.task == "compact":
        compact_day(spark, tables, chosen.as_of)
    elif chosen.task == "sent":
        sent(spark, tables, chosen.as_of, chosen.message_id)
    else:
        rows = report(spark, tables, chosen.as_of, use_daily=chosen.use_daily)
        print("\n".join(row.message for row in rows.take(1)))


if __name__ == "__main__":
    main()
