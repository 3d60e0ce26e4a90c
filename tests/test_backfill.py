"""The back-fill kept up to date, against one made whole."""

import random
from datetime import timedelta

import pytest

from livegauge import batches
from livegauge.plans import backfill
from livegauge.plans.snapshot import diff_backfill
from livegauge.schemas import BACKFILL, OBSERVATIONS
from livegauge.settings import Settings
from livegauge.sinks.tables import append_batch, replace_days
from livegauge.sources.tables import read_batches
from tests.conftest import at, tuples
from tests.test_streaming import rows_between

SIX_HOURS = Settings(bucket_minutes=360)


def stored(spark, path):
    return sorted(tuples(read_batches(spark, path, BACKFILL), *BACKFILL.names), key=str)


def whole(spark, path):
    return sorted(tuples(diff_backfill(read_batches(spark, path, OBSERVATIONS), SIX_HOURS), *BACKFILL.names), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_late_rows(spark, make, tmp_path, seed):
    """Late rows on any date, on dates without rows, a batch repeated with other rows and one taken away."""
    observations, table, pick = str(tmp_path / "observations"), str(tmp_path / "backfill"), random.Random(seed)
    for number, day in enumerate((2, 3, 5, 9, 10, 14)):
        append_batch(make("OBSERVATIONS", rows_between(at(f"{day:02} 00:00:00"), at(f"{day:02} 23:00:00"), day, 12)), observations, OBSERVATIONS, number)
    assert len(backfill.refresh_backfill(spark, observations, table, settings=SIX_HOURS)) == 6
    assert stored(spark, table) == whole(spark, observations)
    for turn in range(7):
        number = pick.choice([100 + turn, pick.randrange(6)])
        first = at(f"{pick.randint(1, 15):02} 00:00:00") + timedelta(hours=pick.randrange(24))
        rows = rows_between(first, first + timedelta(hours=pick.choice([1, 30])), 50 + turn, pick.choice([0, 1, 9]))
        append_batch(make("OBSERVATIONS", rows), observations, OBSERVATIONS, number)
        backfill.refresh_backfill(spark, observations, table, [number], SIX_HOURS)
        if turn % 3 == 2:
            batches.vacuum(spark, observations, hours=0)
            batches.vacuum(spark, table, hours=0)
        assert stored(spark, table) == whole(spark, observations)


def test_only_the_dates_concerned_are_listed(spark, make, tmp_path):
    observations, table = str(tmp_path / "observations"), str(tmp_path / "backfill")
    for day in (2, 4, 6, 8, 10):
        rows = [("a", day, "x", at(f"{day:02} {hour:02}:00:00")) for hour in (3, 9, 15)]
        append_batch(make("OBSERVATIONS", rows), observations, OBSERVATIONS, day)
    backfill.refresh_backfill(spark, observations, table, settings=SIX_HOURS)
    cases = [
        (20, "06 04:00:00", [6], [4, 6]),  # not its last bucket
        (21, "06 16:00:00", [6, 8], [4, 6, 8]),  # its last bucket: the next date with rows too
        (22, "07 01:00:00", [7, 8], [6, 7, 8]),  # a date without rows so far
        (23, "12 01:00:00", [12], [10, 12]),  # after all others
    ]
    for number, when, days, read in cases:
        append_batch(make("OBSERVATIONS", [("b", 1, "x", at(when))]), observations, OBSERVATIONS, number)
        assert [d.day for d in backfill.changed_days(spark, observations, [number], SIX_HOURS)] == days
        df = backfill.differences_of(spark, observations, backfill.changed_days(spark, observations, [number], SIX_HOURS), SIX_HOURS)
        assert sorted({int(f.rsplit("/", 2)[1][-2:]) for f in df.inputFiles()}) == read
        assert [d.day for d in backfill.refresh_backfill(spark, observations, table, [number], SIX_HOURS)] == days
        assert stored(spark, table) == whole(spark, observations)
    assert backfill.refresh_backfill(spark, observations, table, [99], SIX_HOURS) == []


def test_replaced_days_leave_others(spark, make, tmp_path):
    path = str(tmp_path / "t")
    rows = {day: [(f"n{day}", day, "x", at(f"{day:02} 01:00:00"))] for day in (1, 2, 3)}
    write = lambda days, kept: replace_days(
        make("OBSERVATIONS", [r for d in kept for r in rows[d]]), path, OBSERVATIONS, [at(f"{d:02} 00:00:00").date() for d in days]
    )
    names = lambda: sorted(r.name for r in read_batches(spark, path, OBSERVATIONS).collect())
    write((1, 2, 3), (1, 2, 3))
    write((2,), (2,))
    assert names() == ["n1", "n2", "n3"]
    write((1, 2), (1,))
    assert names() == ["n1", "n3"]
    batches.vacuum(spark, path, hours=0)
    assert names() == ["n1", "n3"]
    write((1, 2, 3), ())
    assert names() == []
    with pytest.raises(ValueError, match="other dates"):
        write((1,), (2,))
