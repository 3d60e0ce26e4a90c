"""Baselines, verdicts and grades: hand-worked rows, brute force and properties."""

import math
import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from livegauge.functions import labels, stats
from livegauge.operators.channels import join_channel_history, join_login, twitch_channels, youtube_channels
from livegauge.plans.baseline import (
    baseline_from_daily,
    baseline_stats,
    baseline_verdict,
    ci_position,
    daily_moments,
    kept_day,
)
from livegauge.settings import Settings
from tests.conftest import at, tuples

AS_OF = datetime(2024, 1, 31)
CHANNELS = [
    ("a", "youtube", "https://www.youtube.com/@a", None, "yes"),
    ("a", "twitch", "https://www.twitch.tv/a", "a", "no"),
    ("b", "twitch", "https://www.twitch.tv/b", "b", "yes"),
    ("b", "twitch", "https://www.twitch.tv/b", "b", "yes"),
    ("f", "youtube", "https://www.youtube.com/@f", "yes", "no"),
]
LINK = "https://youtu.be/v"


def history(name, *counts):
    return [(name, count, LINK, at(f"{20 + i} 12:00:00")) for i, count in enumerate(counts)]


def test_hand_worked_interval(make):
    rows = history("n", 10, 20, 30)
    (row,) = baseline_stats(make("OBSERVATIONS", rows), make("CHANNELS", []), AS_OF).collect()
    assert (row.platform, row.n, row.avg_online) == (None, 3, 20.0)
    assert row.margin_of_error == pytest.approx(11.316065, abs=1e-6)
    assert row.ci_lower_bound == pytest.approx(8.683935, abs=1e-6)
    assert row.ci_upper_bound == pytest.approx(31.316065, abs=1e-6)


@pytest.mark.parametrize(
    ("online", "rate", "flag", "grade", "position"),
    [
        (30, -4, 0, "within", "inside"),
        (100, 69, 1, "high", "above"),
        (20, -57, 0, "low", "inside"),  # low by rate, inside by bounds
        (7, -347, 0, "low", "below"),
        (0, None, 0, "low", "below"),
    ],
)
def test_hand_worked_verdicts(make, online, rate, flag, grade, position):
    base = baseline_stats(make("OBSERVATIONS", history("n", 10, 20, 30)), make("CHANNELS", []), AS_OF)
    diffs = make("DIFFS", [("n", online, 0, LINK, "youtube", AS_OF)])
    verdict = ci_position(baseline_verdict(diffs, base, AS_OF))
    graded = labels.grade(stats.fill_rate(F.col("rate_online_ci"), -500)).alias("grade")
    (row,) = verdict.select("rate_online_ci", "flg_top_online", graded, "ci_position").collect()
    assert tuple(row) == (rate, flag, grade, position)


def test_one_observation_has_no_interval(make):
    base = baseline_stats(make("OBSERVATIONS", history("n", 10)), make("CHANNELS", []), AS_OF)
    diffs = make("DIFFS", [("n", 10, 0, LINK, "youtube", AS_OF)])
    (row,) = ci_position(baseline_verdict(diffs, base, AS_OF)).collect()
    assert row.avg_online == 10.0
    assert (row.margin_of_error, row.rate_online_ci, row.flg_top_online, row.ci_position) == (
        None, None, 0, None,
    )


def test_repeated_listing_counts_history_twice(make):
    observations = make("OBSERVATIONS", history("b", 10, 20, 30))
    channels = make("CHANNELS", CHANNELS)
    (row,) = baseline_stats(observations, channels, AS_OF).collect()
    assert row.n == 6
    assert row.stddev_online == pytest.approx(statistics.stdev([10, 20, 30] * 2))
    (once,) = baseline_stats(observations, channels, AS_OF, Settings(dedupe_channels=True)).collect()
    assert once.n == 3 and once.margin_of_error > row.margin_of_error


def test_window_ends_are_included(make):
    rows = [("n", 1, LINK, AS_OF - timedelta(days=15)), ("n", 3, LINK, AS_OF)]
    rows += [("n", 99, LINK, AS_OF - timedelta(days=15, microseconds=1))]
    rows += [("n", 99, LINK, AS_OF + timedelta(microseconds=1))]
    (row,) = baseline_stats(make("OBSERVATIONS", rows), make("CHANNELS", []), AS_OF).collect()
    assert (row.n, row.avg_online) == (2, 2.0)


def random_history(seed, size=600):
    pick = random.Random(seed)
    names = ["a", "b", "c", "f", None]
    return [
        (
            pick.choice(names),
            pick.choice([None, *range(40)]),
            LINK,
            AS_OF - timedelta(seconds=pick.randrange(-3600, 18 * 86400)),
        )
        for _ in range(size)
    ]


def brute_force(rows, channels, as_of):
    """Row-repeating join and plain statistics, as the definition reads."""
    groups = {}
    for name, online, _, ts in rows:
        if not as_of - timedelta(days=15) <= ts <= as_of:
            continue
        platforms = [c[1] for c in channels if c[0] == name and name is not None] or [None]
        for platform in platforms:
            groups.setdefault((name, platform), []).append(online)
    result = {}
    for key, values in groups.items():
        known = [v for v in values if v is not None]
        deviation = statistics.stdev(known) if len(known) > 1 else None
        margin = deviation / math.sqrt(len(values)) * 1.96 if deviation is not None else None
        result[key] = (len(values), statistics.fmean(known) if known else None, margin)
    return result


def cut(when, as_of):
    """On one of the two days that the window holds a part of: all that is read where every other day is kept."""
    return when.date() in ((as_of - timedelta(days=15)).date(), as_of.date())


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("as_of", [AS_OF, datetime(2024, 1, 30, 17, 3, 2)])
def test_statistics_equal_brute_force(make, seed, as_of):
    rows = random_history(seed)
    observations, channels = make("OBSERVATIONS", rows), make("CHANNELS", CHANNELS)
    expected = brute_force(rows, CHANNELS, as_of)
    direct = baseline_stats(observations, channels, as_of)
    kept = baseline_from_daily(daily_moments(observations), observations, channels, as_of)
    holed = daily_moments(observations).filter(F.dayofmonth("day") % 3 != 1)  # days that no run has kept
    holed = baseline_from_daily(holed, observations, channels, as_of)
    marked = None
    for number in range(40):
        day = kept_day(observations, (as_of - timedelta(days=number)).date())
        marked = day if marked is None else marked.unionByName(day)
    marked = baseline_from_daily(marked, make("OBSERVATIONS", [r for r in rows if cut(r[3], as_of)]), channels, as_of)
    for result in (direct, kept, holed, marked):
        found = {
            (r.name, r.platform): (r.n, r.avg_online, r.margin_of_error) for r in result.collect()
        }
        assert found.keys() == expected.keys()
        for key, values in expected.items():
            assert found[key] == pytest.approx(values, rel=1e-9)
    ordered = direct.filter("NOT (ci_lower_bound <= avg_online AND avg_online <= ci_upper_bound)")
    assert ordered.count() == 0


def test_history_join_repeats_rows_per_listing(make):
    observations = make("OBSERVATIONS", history("a", 1) + history("c", 2) + [(None, 3, LINK, AS_OF)])
    joined = join_channel_history(observations, make("CHANNELS", CHANNELS))
    assert sorted(tuples(joined, "name", "platform"), key=str) == [
        ("a", "twitch"), ("a", "youtube"), ("c", None), (None, None),
    ]


def test_channel_selections(make):
    channels = make("CHANNELS", CHANNELS)
    assert tuples(youtube_channels(channels), "name", "big_stream") == [("a", "no")]
    assert sorted(tuples(twitch_channels(channels), "name", "login")) == [
        ("a", "a"), ("b", "b"), ("b", "b"),
    ]


def test_repeated_logins_multiply_and_null_logins_find_nothing(spark, make):
    extra = [("n", "twitch", "https://www.twitch.tv/n", None, "yes")]
    twitch = twitch_channels(make("CHANNELS", CHANNELS + extra))
    counts = spark.createDataFrame([("b", 5), ("b", 5), (None, 4), ("x", 1)], "login string, online bigint")
    joined = join_login(counts, twitch)
    assert sorted(tuples(joined, "login", "online", "name"), key=str) == sorted(
        [("b", 5, "b")] * 4 + [(None, 4, None), ("x", 1, None)], key=str
    )


@pytest.mark.parametrize(
    ("rate", "grade"), [(-51, "low"), (-50, "low"), (-49, "within"), (29, "within"), (30, "high")]
)
def test_grade_edges(spark, rate, grade):
    row = spark.range(1).select(labels.grade(F.lit(rate))).first()
    assert row[0] == grade


def test_every_rate_has_a_grade_and_grades_rise_with_it(spark):
    rates = spark.range(-600, 101).withColumn("grade", labels.grade(F.col("id")))
    grades = [row.grade for row in rates.orderBy("id").collect()]
    assert grades == ["low"] * 551 + ["within"] * 79 + ["high"] * 71


@pytest.mark.parametrize(
    ("upper", "online", "rate"),
    [(10.0, 16, 38), (11.0, 16, 31), (24.0, 16, -50), (1e12, 1, None), (1.0, None, None), (None, 5, None)],
)
def test_rate_rounds_half_away_and_survives_extremes(spark, upper, online, rate):
    row = spark.range(1).select(
        stats.rate_vs_upper(F.lit(upper).cast("double"), F.lit(online).cast("bigint"))
    ).first()
    assert row[0] == rate
