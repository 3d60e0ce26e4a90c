"""Every batch as a whole or not at all: writes and compactions stopped at every step."""

from datetime import timedelta

import pytest

from livegauge import batches, storage, tasks
from livegauge.schemas import DIFFS
from livegauge.sinks.tables import append_batch, compact
from livegauge.sources.tables import read_batches
from tests.conftest import at, tuples

DAY = at("30 00:00:00")


class Stopped(Exception):
    pass


@pytest.fixture
def stop(monkeypatch):
    """Let a given number of changes to the store through, and stop at the next; with None all go through."""
    left = [None]

    def bounded(change):
        def run(*arguments):
            if left[0] is not None:
                if left[0] == 0:
                    raise Stopped
                left[0] -= 1
            return change(*arguments)

        return run

    for name in ("put", "rename", "remove"):
        monkeypatch.setattr(storage, name, bounded(getattr(storage, name)))

    def after(steps):
        left[0] = steps

    return after


def diff_rows(prefix, days, n=3):
    return [(f"{prefix}{day}{i}", i, 0, "https://youtu.be/v", "youtube", DAY - timedelta(days=day)) for day in days for i in range(n)]


def names(spark, path, *dates):
    return sorted(row.name for row in read_batches(spark, path, DIFFS, *dates).collect())


def expected(*parts):
    return sorted(row[0] for part in parts for row in part)


@pytest.mark.parametrize("days", [(0,), (0, 1), (1, 2), ()])
def test_a_write_stopped_anywhere_is_seen_whole_or_not_at_all(spark, make, tmp_path, stop, days):
    other, old, new = diff_rows("other", (0, 1)), diff_rows("old", (0, 1)), diff_rows("new", days)
    outcomes = []
    for steps in range(40):
        path = str(tmp_path / f"t{steps}")
        append_batch(make("DIFFS", other), path, DIFFS, 2)
        append_batch(make("DIFFS", old), path, DIFFS, 1)
        stop(steps)
        try:
            append_batch(make("DIFFS", new), path, DIFFS, 1)
            stopped = False
        except Stopped:
            stopped = True
        stop(None)
        found = names(spark, path)
        assert found in (expected(other, old), expected(other, new))
        assert names(spark, path, DAY.date(), DAY.date()) == sorted(n for n in found if n.rstrip("0123456789")[-1] and n[-2] == "0")
        outcomes.append(found)
        append_batch(make("DIFFS", new), path, DIFFS, 1)  # the run is repeated
        assert names(spark, path) == expected(other, new)
        batches.vacuum(spark, path, hours=0)
        assert names(spark, path) == expected(other, new)
        left = storage.matching(spark, f"{path}/batch_id=*/attempt=*/obs_date=*")
        assert len(left) == 2 + len(days) and not storage.matching(spark, f"{path}/_done/commits/*")
        if not stopped:
            break
    assert not stopped and outcomes[0] == expected(other, old)


def test_a_compaction_stopped_anywhere_shows_every_row_once(spark, make, tmp_path, stop):
    rows = [diff_rows(f"b{n}_", (0, 1)) for n in range(3)]
    late = diff_rows("late", (0,))
    for steps in range(30):
        path = str(tmp_path / f"t{steps}")
        for number, part in enumerate(rows):
            append_batch(make("DIFFS", part), path, DIFFS, number)
        stop(steps)
        try:
            compact(spark, path, DIFFS, DAY.date())
            stopped = False
        except Stopped:
            stopped = True
        stop(None)
        assert names(spark, path) == expected(*rows)
        append_batch(make("DIFFS", late), path, DIFFS, 9)
        assert names(spark, path) == expected(*rows, late)
        compact(spark, path, DIFFS, DAY.date())
        assert names(spark, path) == expected(*rows, late)
        assert len(read_batches(spark, path, DIFFS, DAY.date(), DAY.date()).inputFiles()) == 1
        batches.vacuum(spark, path, hours=0)
        assert names(spark, path) == expected(*rows, late)
        assert len(storage.matching(spark, f"{path}/batch_id=*/attempt=*/obs_date=*")) == 1 + len(rows)
        if not stopped:
            break
    assert not stopped


def test_a_vacuum_may_stop_anywhere(spark, make, tmp_path, stop):
    path, old, new = str(tmp_path / "t"), diff_rows("old", (0, 1)), diff_rows("new", (1, 2))
    append_batch(make("DIFFS", old), path, DIFFS, 1)
    stop(4)  # after three marks and the commit
    with pytest.raises(Stopped):
        append_batch(make("DIFFS", new), path, DIFFS, 1)
    for steps in range(20):
        stop(steps)
        try:
            batches.vacuum(spark, path, hours=0)
            break
        except Stopped:
            stop(None)
            assert names(spark, path) == expected(new)
    stop(None)
    assert names(spark, path) == expected(new)
    assert batches.vacuum(spark, path, hours=0) == 0


def test_a_reader_keeps_its_files_while_a_batch_is_replaced(spark, make, tmp_path):
    path, old, new = str(tmp_path / "t"), diff_rows("old", (0, 1)), diff_rows("new", (0,))
    append_batch(make("DIFFS", old), path, DIFFS, 1)
    before = read_batches(spark, path, DIFFS)
    append_batch(make("DIFFS", new), path, DIFFS, 1)
    batches.vacuum(spark, path)  # too young to be removed
    assert sorted(r.name for r in before.collect()) == expected(old)
    assert names(spark, path) == expected(new)


def test_files_of_a_failed_write_do_not_count(spark, make, tmp_path):
    path, rows = str(tmp_path / "t"), diff_rows("a", (0,))
    attempt = batches.Attempt(spark, path, 1)
    make("DIFFS", rows).selectExpr("*", "to_date(datetime) AS obs_date").write.partitionBy("obs_date").parquet(attempt.folder)
    assert names(spark, path) == [] and batches.newest_day(spark, path) is None
    append_batch(make("DIFFS", rows), path, DIFFS, 1)
    assert names(spark, path) == expected(rows) and batches.newest_day(spark, path) == DAY.date()


def test_a_compacted_batch_is_not_repeated(spark, make, tmp_path):
    path = str(tmp_path / "t")
    for number in range(3):
        append_batch(make("DIFFS", diff_rows(f"b{number}_", (0, 1))), path, DIFFS, number)
    for number in (7, 8):
        compact(spark, path, DIFFS, DAY.date())
        append_batch(make("DIFFS", diff_rows("more", (0,))), path, DIFFS, number)
    before = names(spark, path)
    for number, days in ((0, (0,)), (2, (0, 1)), (1, (1,))):  # the last one would clear its rows of the compacted date
        with pytest.raises(ValueError, match="compacted"):
            append_batch(make("DIFFS", diff_rows("again", days)), path, DIFFS, number)
        assert names(spark, path) == before


def test_a_batch_may_be_made_from_itself(spark, make, tmp_path):
    path = str(tmp_path / "t")
    append_batch(make("DIFFS", diff_rows("a", (0, 1))), path, DIFFS, 1)
    for _ in range(3):
        rows = read_batches(spark, path, DIFFS)
        append_batch(rows.withColumn("online", rows.online + 1).select(*DIFFS.names), path, DIFFS, 1)
    assert sorted(tuples(read_batches(spark, path, DIFFS), "online")) == [(3,), (3,), (4,), (4,), (5,), (5,)]


def test_rows_without_a_date(spark, make, tmp_path):
    path = str(tmp_path / "t")
    rows = [("a", 1, 0, None, None, None), ("b", 1, 0, None, None, DAY)]
    append_batch(make("DIFFS", rows), path, DIFFS, 1)
    assert names(spark, path) == ["a", "b"] and batches.newest_day(spark, path) == DAY.date()
    append_batch(make("DIFFS", rows[1:]), path, DIFFS, 1)
    assert names(spark, path) == ["b"]


def test_one_run_at_a_time(spark, tmp_path):
    tables = tasks.Tables(str(tmp_path))
    with tasks.exclusive(spark, tables, "diff"):
        with pytest.raises(RuntimeError, match="running"), tasks.exclusive(spark, tables, "diff"):
            pass
        with tasks.exclusive(spark, tables, "report"):
            pass
        with pytest.raises(RuntimeError, match="running"), tasks.exclusive(spark, tables, "diff"):
            pass
    with pytest.raises(KeyError), tasks.exclusive(spark, tables, "diff"):
        raise KeyError
    assert storage.create(spark, tables.path("_running/diff"))  # a run that died
    with tasks.exclusive(spark, tables, "diff", stale_hours=0):
        pass
    assert storage.matching(spark, tables.path("_running/*")) == []
