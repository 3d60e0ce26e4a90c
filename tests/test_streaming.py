"""Streams against the same rows in batch."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from livegauge import tasks
from livegauge.operators.buckets import bucket_max
from livegauge.plans.snapshot import snapshot_diff
from livegauge.schemas import CELLS, DIFFS, LANDED_PAGES, LANDED_REPLIES, OBSERVATIONS, REJECTS, SNAPSHOTS
from livegauge.settings import Settings
from livegauge.sinks.tables import append_batch
from livegauge.sources.tables import read_batches
from livegauge.streaming import jobs
from livegauge.streaming.jobs import (
    compact_cells,
    read_cells,
    start_bucket_max,
    start_page_ingest,
    start_reply_ingest,
    start_snapshot_diff,
    stream_number,
)
from livegauge.streaming.sources import observation_stream, stream_session
from tests.conftest import at, tuples


def rows_between(first, last, seed, size=300):
    pick = random.Random(seed)
    span = (last - first).total_seconds()
    return [
        (
            pick.choice(["a", "b", None]),
            pick.randrange(100),
            pick.choice(["https://youtu.be/v", "https://www.twitch.tv/t", None]),
            first + timedelta(seconds=pick.randrange(int(span))),
        )
        for _ in range(size)
    ]


def land(make, rows, path):
    make("OBSERVATIONS", rows).coalesce(1).write.mode("append").parquet(path)


def test_bucket_maxima_equal_batch(spark, make, tmp_path):
    landing, cells, checkpoint = (str(tmp_path / n) for n in ("landing", "cells", "checkpoint"))
    steps = [
        rows_between(at("10 00:00:00"), at("11 00:00:00"), 1),
        rows_between(at("10 12:00:00"), at("12 00:00:00"), 2),  # overlaps: earlier buckets grow
        rows_between(at("12 00:00:00"), at("12 06:00:00"), 3),
    ]
    seen = []
    for rows in steps:
        land(make, rows, landing)
        seen += rows
        query = start_bucket_max(observation_stream(stream_session(spark, 3), landing), cells, checkpoint, drain=True)
        query.awaitTermination()
        expected = bucket_max(make("OBSERVATIONS", seen))
        assert sorted(tuples(read_cells(spark, cells)), key=str) == sorted(tuples(expected), key=str)


def test_late_rows_count_however_late(spark, make, tmp_path):
    landing, cells, checkpoint = (str(tmp_path / n) for n in ("landing", "cells", "checkpoint"))
    rows = [
        ("a", 1, "x", at("10 00:00:00")),
        ("a", 2, "x", at("08 00:00:00")),  # two days late
        ("a", 3, "x", at("06 00:00:00")),  # four days late
        ("a", 9, "x", at("10 00:01:00")),
        ("a", 5, "x", at("06 00:00:01")),  # late, into a bucket written before
    ]
    for row in rows:
        land(make, [row], landing)
        start_bucket_max(observation_stream(stream_session(spark, 3), landing), cells, checkpoint, drain=True).awaitTermination()
    assert sorted(tuples(read_cells(spark, cells))) == sorted(tuples(bucket_max(make("OBSERVATIONS", rows))))


def test_timed_trigger_takes_what_has_landed(spark, make, tmp_path):
    """Batches by processing time, not drained: the query stays up and a landing while it runs is taken by a later batch."""
    landing, cells, checkpoint = (str(tmp_path / n) for n in ("landing", "cells", "checkpoint"))
    land(make, [("a", 1, "x", at("10 00:00:00"))], landing)
    stream = observation_stream(stream_session(spark, 3), landing)
    query = start_bucket_max(stream, cells, checkpoint, Settings(trigger_seconds=1))
    try:
        query.processAllAvailable()
        land(make, [("a", 7, "x", at("10 00:05:00"))], landing)
        query.processAllAvailable()
        assert query.isActive and query.lastProgress["batchId"] >= 1
    finally:
        query.stop()
    assert tuples(read_cells(spark, cells), "online") == [(7,)]


def test_a_step_reads_the_two_kept_buckets_only(spark, make, tmp_path, monkeypatch):
    read = []

    def reading(session, path, schema, *dates, **more):
        found = read_batches(session, path, schema, *dates, **more)
        read.append((path, {f.rsplit("/", 2)[1] for f in found.inputFiles()}))
        return found

    landing, stored, diffs, checkpoint = (str(tmp_path / n) for n in ("landing", "stored", "diffs", "check"))

    def drain(rows):
        land(make, rows, landing)
        stream = observation_stream(stream_session(spark, 3), landing)
        start_snapshot_diff(stream, stored, diffs, checkpoint, drain=True).awaitTermination()

    drain(rows_between(at("01 00:00:00"), at("20 00:00:00"), 8, 2000))
    monkeypatch.setattr(jobs, "read_batches", reading)
    drain(rows_between(at("20 00:00:00"), at("20 00:10:00"), 9))
    assert {path for path, _ in read} == {f"{diffs}-snapshots"}
    assert [sorted(days) for _, days in read] == [["obs_date=2024-01-19"], ["obs_date=2024-01-19", "obs_date=2024-01-20"]]
    kept = tuples(read_batches(spark, f"{diffs}-snapshots", SNAPSHOTS).select("bucket").distinct())
    assert len(kept) == 2


def test_differences_equal_batch_after_every_landing(spark, make, tmp_path):
    landing, stored, diffs, checkpoint = (str(tmp_path / n) for n in ("landing", "stored", "diffs", "check"))
    steps = [
        rows_between(at("10 00:00:00"), at("10 00:30:00"), 4),
        rows_between(at("10 00:30:00"), at("10 00:50:00"), 5),
        rows_between(at("09 22:00:00"), at("09 23:00:00"), 6),  # late: the newest snapshot stays the newest
    ]
    seen, expected = [], []
    for rows in steps:
        land(make, rows, landing)
        seen += rows
        stream = observation_stream(stream_session(spark, 3), landing)
        start_snapshot_diff(stream, stored, diffs, checkpoint, drain=True).awaitTermination()
        expected += tuples(
            snapshot_diff(make("OBSERVATIONS", seen), max(r[3] for r in seen)), *DIFFS.names
        )
    found = tuples(read_batches(spark, diffs, DIFFS), *DIFFS.names)
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert read_batches(spark, stored, OBSERVATIONS).count() == len(seen)


def test_restart_without_new_rows_writes_nothing(spark, make, tmp_path):
    landing, stored, diffs, checkpoint = (str(tmp_path / n) for n in ("landing", "stored", "diffs", "check"))
    land(make, rows_between(at("10 00:00:00"), at("10 00:30:00"), 7), landing)
    for _ in range(2):
        stream = observation_stream(stream_session(spark, 3), landing)
        start_snapshot_diff(stream, stored, diffs, checkpoint, drain=True).awaitTermination()
    assert read_batches(spark, diffs, DIFFS).select("batch_id").distinct().count() == 1


def test_a_new_checkpoint_loses_nothing(spark, make, tmp_path):
    """Each landing under a checkpoint of its own: their micro-batches are all number 0, yet none replaces another's rows."""
    cells, stored, diffs = (str(tmp_path / n) for n in ("cells", "stored", "diffs"))
    seen, expected = [], []
    for number in range(3):
        rows = rows_between(at(f"1{number} 00:00:00"), at(f"1{number} 00:30:00"), 20 + number, 60)
        seen += rows
        landing = str(tmp_path / f"landing{number}")
        land(make, rows, landing)
        stream = observation_stream(stream_session(spark, 3), landing)
        start_bucket_max(stream, cells, str(tmp_path / f"check{number}"), drain=True).awaitTermination()
        start_snapshot_diff(stream, stored, diffs, str(tmp_path / f"other{number}"), drain=True).awaitTermination()
        expected += tuples(snapshot_diff(make("OBSERVATIONS", seen), max(r[3] for r in seen)), *DIFFS.names)
    assert sorted(tuples(read_cells(spark, cells)), key=str) == sorted(tuples(bucket_max(make("OBSERVATIONS", seen))), key=str)
    assert sorted(tuples(read_batches(spark, stored, OBSERVATIONS), *OBSERVATIONS.names), key=str) == sorted(seen, key=str)
    assert sorted(tuples(read_batches(spark, diffs, DIFFS), *DIFFS.names), key=str) == sorted(expected, key=str)


def test_numbers_of_streams(spark, tmp_path):
    numbers = []
    for n in ("one", "two"):
        (tmp_path / n).mkdir()
        (tmp_path / n / "metadata").write_text(f'{{"id":"{n}"}}')
        numbers += [stream_number(spark, str(tmp_path / n), batch) for batch in (0, 1, 7)]
    assert len(set(numbers)) == 6 and numbers[1] == numbers[0] + 1
    assert all(2**48 <= n < 2**63 for n in numbers)
    with pytest.raises(ValueError, match="micro-batches"):
        stream_number(spark, str(tmp_path / "one"), 1 << 28)


def test_snapshots_begin_with_what_is_stored(spark, make, tmp_path):
    """Kept snapshots that are not there are made from the stored observations of the look-back."""
    landing, stored, diffs, checkpoint = (str(tmp_path / n) for n in ("landing", "stored", "diffs", "check"))
    old = rows_between(at("09 00:00:00"), at("10 00:00:00"), 31)
    append_batch(make("OBSERVATIONS", old), stored, OBSERVATIONS, 5)
    new = rows_between(at("10 00:00:00"), at("10 00:10:00"), 32)
    land(make, new, landing)
    start_snapshot_diff(observation_stream(stream_session(spark, 3), landing), stored, diffs, checkpoint, drain=True).awaitTermination()
    expected = snapshot_diff(make("OBSERVATIONS", old + new), max(r[3] for r in new))
    assert sorted(tuples(read_batches(spark, diffs, DIFFS), *DIFFS.names), key=str) == sorted(tuples(expected, *DIFFS.names), key=str)


def test_random_landings_give_the_differences_of_the_look_back(spark, make, tmp_path):
    """Late rows between, before and in the kept buckets, and gaps longer than the look-back, against the batch job over all rows so far."""
    landing, stored, diffs, checkpoint = (str(tmp_path / n) for n in ("landing", "stored", "diffs", "check"))
    pick, seen, expected, clock = random.Random(5), [], [], at("10 00:00:00")
    for turn in range(6):
        clock += timedelta(minutes=pick.choice([10, 30, 60 * 80]))
        first = clock - timedelta(minutes=pick.choice([0, 25, 300]))
        rows = rows_between(first, clock + timedelta(minutes=9), turn, 40)
        seen += rows
        land(make, rows, landing)
        start_snapshot_diff(observation_stream(stream_session(spark, 3), landing), stored, diffs, checkpoint, drain=True).awaitTermination()
        expected += tuples(snapshot_diff(make("OBSERVATIONS", seen), max(r[3] for r in seen)), *DIFFS.names)
    assert sorted(tuples(read_batches(spark, diffs, DIFFS), *DIFFS.names), key=str) == sorted(expected, key=str)


def test_merged_cells_read_alike(spark, make, tmp_path):
    landing, cells, checkpoint = (str(tmp_path / n) for n in ("landing", "cells", "checkpoint"))
    seen = []
    for seed in range(3):
        rows = rows_between(at("10 22:00:00"), at("11 02:00:00"), seed, 100)
        seen += rows
        land(make, rows, landing)
        start_bucket_max(observation_stream(stream_session(spark, 3), landing), cells, checkpoint, drain=True).awaitTermination()
        if seed:
            compact_cells(spark, cells, at("10 00:00:00").date())
        assert sorted(tuples(read_cells(spark, cells)), key=str) == sorted(tuples(bucket_max(make("OBSERVATIONS", seen))), key=str)
    day = read_batches(spark, cells, CELLS, at("10 00:00:00").date(), at("10 00:00:00").date())
    assert len(day.inputFiles()) == 1 and day.count() == day.select("name", "link", "bucket").distinct().count()


PAGES = [
    ("Ann", "https://y/ann/live", 100, "v1"), ("Ann", "https://y/ann/live", 90, "v1"), ("Off", "https://y/off/live", 5, "v2"),
    ("Ann", "https://y/ann/live", "1.2K", "v1"), ("Ann", "https://y/ann/live", 7, None), ("Two", "https://y/two/live", 8, "v3"), ("Nil", "https://y/nil/live", 9, "v4"),
]
LISTED = [
    ("Ann", "youtube", "https://y/ann", "yes", "yes"), ("Off", "youtube", "https://y/off", "yes", "no"), ("Bo", "twitch", "https://t/bo", "bo", "yes"),
    ("Two", "youtube", "https://y/two", "yes", "yes"), ("Twin", "youtube", "https://y/two", "yes", "yes"), (None, "youtube", "https://y/nil", "yes", "yes"),
]


def payloads(minute):
    """Pages and replies landed around one run's interval; one page not fetched, one not live."""
    when = at("10 00:00:00") + timedelta(minutes=minute)
    pages = []
    for n, (name, url, count, video) in enumerate(PAGES):
        link = f'<a href="https://www.youtube.com/watch?v={video}"></a>' if video else ""
        html = f'<img src="hqdefault_live.jpg">{link}<script>{{"x":1,"originalViewCount":"{count}"}}}},"y":2}}</script>'
        pages.append((name, url, html, when + timedelta(minutes=n % 3, microseconds=n % 2)))
    pages += [("Ann", "https://y/ann/live", None, when), ("Ann", "https://y/ann/live", "<p>offline</p>", when)]
    replies = [("bo", f'{{"data":[{{"viewer_count":{minute + n}}}]}}', when + timedelta(minutes=n)) for n in range(3)]
    return pages, replies + [("bo", '{"data":[]}', when), ("no", '{"data":[{"viewer_count":3}]}', when), ("bo", "{", when)]


def test_streams_of_payloads_equal_the_tasks(spark, make, tmp_path):
    """A drained stream over landed files against the periodic runs over all intervals, rejects and the ends of intervals included."""
    tables = tasks.Tables(str(tmp_path / "tables"))
    make("CHANNELS", LISTED).write.parquet(tables.path("channels"))
    channels, streamed = tables.path("channels"), tasks.Tables(str(tmp_path / "streamed"))
    for step, minute in enumerate((8, 18, 39)):
        pages, replies = payloads(minute)
        for name, rows, schema in (("pages", pages, LANDED_PAGES), ("replies", replies, LANDED_REPLIES)):
            df = spark.createDataFrame(rows, schema)
            append_batch(df, tables.path(f"landed_{name}"), schema, step, ts="landed")
            df.coalesce(1).write.mode("append").parquet(str(tmp_path / f"landing_{name}"))
        if step == 1:
            continue  # two landings in one micro-batch
        session = stream_session(spark, 3)
        pages = observation_stream(session, str(tmp_path / "landing_pages"), LANDED_PAGES)
        replies = observation_stream(session, str(tmp_path / "landing_replies"), LANDED_REPLIES)
        start_page_ingest(
            pages, channels, streamed.path("observations"), streamed.path("rejected"), str(tmp_path / "check_p"), drain=True
        ).awaitTermination()
        start_reply_ingest(replies, channels, streamed.path("observations"), str(tmp_path / "check_r"), drain=True).awaitTermination()
    totals = {"read": 0, "live": 0, "rejected": 0, "written": 0}
    for run in range(1, 7):
        as_of = at("10 00:00:00") + timedelta(minutes=10 * run)
        for name, n in tasks.ingest(spark, tables, "youtube", tables.path("landed_pages"), as_of).items():
            totals[name] += n
        tasks.ingest(spark, tables, "twitch", tables.path("landed_replies"), as_of)
    for name, columns in (("observations", OBSERVATIONS.names), ("rejected", REJECTS.names)):
        have, want = (sorted(tuples(getattr(t, name)(spark), *columns), key=str) for t in (streamed, tables))
        assert have == want and want
    # Three landings of seven live pages; one of the pages is that of two channels.
    assert totals == {"read": 3 * 8, "live": 3 * 7, "rejected": 3 * 3, "written": 3 * 5}
    assert tables.rejected(spark).count() == totals["rejected"]
    assert sorted(tuples(tables.rejected(spark).select("reason").distinct())) == [("no channel",), ("no count",), ("no link",)]
    youtube = tables.observations(spark).filter(F.col("link").startswith("https://youtu.be"))
    assert youtube.count() == totals["written"]
