"""Report rows, text, freshness and log."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from livegauge.operators import ordering, rates
from livegauge.plans import report
from livegauge.schemas import DIFFS, REPORTS
from livegauge.settings import Settings
from livegauge.sinks.tables import append_batch, compact, log_report, log_sent
from livegauge.sources.tables import read_batches
from livegauge.storage import matching, temporary
from tests.conftest import at, tuples

AS_OF = datetime(2024, 1, 31)
YT, TW = "https://youtu.be/v", "https://www.twitch.tv/t"


def diff_row(name, online, diff=0, link=YT, platform="youtube", when=AS_OF):
    return (name, online, diff, link, platform, when)


@pytest.fixture
def verdict(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "name string, online bigint, rate_online_ci int")

    return build


def test_threshold_applies_before_the_newest_batch_is_chosen(make):
    older = AS_OF - timedelta(minutes=10)
    diffs = make("DIFFS", [diff_row("a", 5), diff_row("b", 6, when=older), diff_row("c", 5, when=older)])
    assert tuples(report.report_rows(diffs, AS_OF), "name") == [("b",)]


def test_different_newest_batches_leave_the_report_empty(make, verdict):
    older = AS_OF - timedelta(minutes=10)
    diffs = make("DIFFS", [diff_row("a", 5), diff_row("b", 60, when=older)])
    assert report.graded_report(diffs, verdict(("a", 5, 10)), AS_OF).count() == 0


@pytest.mark.parametrize(
    ("online", "rate", "shown"),
    [(15, 0, False), (16, 0, True), (16, -350, False), (16, -349, True), (16, None, False)],
)
def test_thresholds(make, verdict, online, rate, shown):
    graded = report.graded_report(
        make("DIFFS", [diff_row("a", online)]), verdict(("a", online, rate)), AS_OF
    )
    assert graded.count() == (1 if shown else 0)


def test_rates_fan_out_by_name_but_not_by_value(make, verdict):
    diffs = make("DIFFS", [diff_row("a", 20), diff_row("a", 40, link=TW), diff_row(None, 30)])
    rows = report.report_rows(diffs, AS_OF)
    found = verdict(("a", 20, 1), ("a", 40, 2), (None, 30, 3))
    by_name = tuples(rates.join_rates(rows, found), "name", "online", "rate_online_ci")
    assert sorted(by_name, key=str) == sorted(
        [("a", 20, 1), ("a", 20, 2), ("a", 40, 1), ("a", 40, 2), (None, 30, 3)], key=str
    )
    by_value = tuples(rates.join_rates_by_value(rows, found), "name", "online", "rate_online_ci")
    assert sorted(by_value, key=str) == sorted([("a", 20, 1), ("a", 40, 2), (None, 30, 3)], key=str)


def test_sections(spark):
    links = [YT, TW, "https://youtu-be/x?u=twitch.tv", "https://vk.example/u", None]
    rows = spark.createDataFrame([(link,) for link in links], "link string")
    split = tuples(rates.split_by_platform(rows), "link", "section")
    assert sorted(split) == sorted(
        [(YT, "youtube"), (TW, "twitch"), (links[2], "youtube"), (links[2], "twitch")]
    )


def test_message_text(make, verdict):
    diffs = make(
        "DIFFS",
        [
            diff_row("low", 20, -3),
            diff_row("mid", 200, 7),
            diff_row("top", 99, 0, link=TW, platform="twitch"),
            diff_row("else", 99, 0, link="https://vk.example/u", platform=None),
        ],
    )
    rates_of = verdict(("low", 20, -50), ("mid", 200, 29), ("top", 99, 30), ("else", 99, 0))
    graded = report.graded_report(diffs, rates_of, AS_OF)
    (row,) = report.report_message(graded, diffs, AS_OF).collect()
    assert row.datetime == AS_OF
    assert row.message == (
        "⭐️ Online Streams: ⭐️\n\n"
        f"🔸  [mid]({YT}) [[200]] 🟢 +7\n"
        f"✖️  [low]({YT}) [[20]] 🔴 -3\n\n"
        f"✔️  [top]({TW}) [[99]] 🟡 0"
    )


def test_empty_report_keeps_both_blocks(make, verdict):
    diffs = make("DIFFS", [diff_row("a", 1)])
    graded = report.graded_report(diffs, verdict(), AS_OF)
    (row,) = report.report_message(graded, diffs, AS_OF).collect()
    assert row.message == "⭐️ Online Streams: ⭐️\n\n\n\n"


@pytest.mark.parametrize(
    ("age", "flag"),
    [
        (timedelta(minutes=9, seconds=59), 1),
        (timedelta(minutes=10), 0),
        (timedelta(minutes=-5), 0),  # after the run: not seen by it, as in the look-back
        (None, 0),
    ],
)
def test_freshness(make, verdict, age, flag):
    rows = [] if age is None else [diff_row("a", 1, when=AS_OF - age)]
    diffs = make("DIFFS", rows)
    assert tuples(report.freshness_flag(diffs, AS_OF)) == [(flag,)]
    if flag == 0:
        graded = report.graded_report(diffs, verdict(), AS_OF)
        assert tuples(report.report_message(graded, diffs, AS_OF), "message") == [("❌ Not Online Streams:",)]


def test_lines_join_the_same_in_any_piece_size(spark, monkeypatch):
    lines = spark.range(1, 3001).selectExpr(
        "if(id % 3 = 0, 'twitch', 'youtube') AS section", "id AS position", "concat('line ', id) AS line"
    )
    expected = {
        section: "\n".join(f"line {i}" for i in range(1, 3001) if (i % 3 == 0) == (section == "twitch"))
        for section in ("youtube", "twitch")
    }
    for size in (1, 7, 1000, 10**6):
        monkeypatch.setattr(ordering, "LINES_PER_PIECE", size)
        assert dict(tuples(ordering.join_lines(lines), "section", "lines")) == expected


def test_positions_count_every_row_once(spark):
    """A third of the rows share one key."""
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 7, pmod(hash(id), 1000)) AS online", "concat('n', id) AS name"
    )
    placed = ordering.with_position(rows, [F.desc("online"), F.asc("name")])
    found = tuples(placed.orderBy("position"), "position", "online", "name")
    assert [p for p, _, _ in found] == list(range(1, 30_001))
    assert found == [
        (i, *key) for i, key in enumerate(sorted([r[1:] for r in found], key=lambda r: (-r[0], r[1])), 1)
    ]


def test_latest_report(make):
    rows = [(at("30 10:00:00"), "(-1, 4)", "x"), (at("30 11:00:00"), "(-1, 5)", "y")]
    assert tuples(report.latest_report(make("REPORTS", rows + rows)), "chat_message_id") == [("(-1, 5)",)]
    assert report.latest_report(make("REPORTS", [])).count() == 0


def test_append_is_idempotent_and_empty_text_is_null(spark, make, tmp_path):
    path = str(tmp_path / "diffs")
    first = [diff_row("a", 1), diff_row("", 2, link="", when=AS_OF - timedelta(days=1))]
    append_batch(make("DIFFS", first), path, DIFFS, batch_id=1)
    append_batch(make("DIFFS", [diff_row("b", 3)]), path, DIFFS, batch_id=2)
    append_batch(make("DIFFS", first), path, DIFFS, batch_id=1)
    stored = read_batches(spark, path, DIFFS)
    assert sorted(tuples(stored, "name", "online", "link", "batch_id"), key=str) == sorted(
        [("a", 1, YT, 1), (None, 2, None, 1), ("b", 3, YT, 2)], key=str
    )
    assert tuples(report.report_rows(stored, AS_OF), "name") == []  # nothing exceeds five


def test_dates_bound_what_is_listed(spark, make, tmp_path):
    path = str(tmp_path / "diffs")
    rows = [diff_row(f"n{i}", i, when=AS_OF - timedelta(days=i)) for i in range(5)]
    append_batch(make("DIFFS", rows), path, DIFFS, batch_id=1)
    day = AS_OF.date()
    for first, last, names in ((1, 0, ["n0", "n1"]), (9, 3, ["n3", "n4"]), (40, 30, [])):
        dates = day - timedelta(days=first), day - timedelta(days=last)
        stored = read_batches(spark, path, DIFFS, *dates)
        assert sorted(r.name for r in stored.collect()) == names
        assert all(f"obs_date={day - timedelta(days=first)}" <= f.split("/")[-2] for f in stored.inputFiles())


def test_missing_column_raises(spark, make, tmp_path):
    with pytest.raises(Exception, match="online_diff"):
        bad = make("DIFFS", [diff_row("a", 1)]).drop("online_diff")
        append_batch(bad, str(tmp_path / "bad"), DIFFS, batch_id=1)


def test_report_log(spark, make, verdict, tmp_path):
    diffs = make("DIFFS", [diff_row("a", 1)])
    message = report.report_message(report.graded_report(diffs, verdict(), AS_OF), diffs, AS_OF)
    path = str(tmp_path / "reports")
    later = AS_OF + timedelta(minutes=10)
    log_report(message, path, AS_OF, batch_id=1)
    log_report(message, path, later, batch_id=2)
    assert report.latest_report(read_batches(spark, path, REPORTS)).count() == 0  # nothing is sent yet
    log_sent(spark, path, "(-1, 9)", AS_OF, batch_id=1)
    assert tuples(report.latest_report(read_batches(spark, path, REPORTS)), "chat_message_id") == [("(-1, 9)",)]
    for _ in range(2):
        log_sent(spark, path, "(-1, 10)", later, batch_id=2)
    stored = read_batches(spark, path, REPORTS)
    assert tuples(report.latest_report(stored), "chat_message_id") == [("(-1, 10)",)]
    assert stored.count() == 2 and stored.select("message").distinct().count() == 1


def test_a_batch_replaces_all_of_itself(spark, make, tmp_path):
    """A retry with fewer dates, and one without rows, read back as just the new result; other batches stay."""
    path = str(tmp_path / "diffs")
    rows = [diff_row(f"n{i}", i, when=AS_OF - timedelta(days=i)) for i in range(4)]
    append_batch(make("DIFFS", [diff_row("other", 9)]), path, DIFFS, batch_id=2)
    for size in (4, 2, 1, 0, 3):
        append_batch(make("DIFFS", rows[:size]), path, DIFFS, batch_id=1)
        stored = read_batches(spark, path, DIFFS)
        assert sorted(r.name for r in stored.collect()) == sorted(["other"] + [r[0] for r in rows[:size]])


def test_compaction_keeps_the_rows_in_few_files(spark, make, tmp_path):
    path = str(tmp_path / "diffs")
    for number in range(6):
        append_batch(make("DIFFS", [diff_row(f"n{number}", number), diff_row("old", number, when=AS_OF - timedelta(days=1))]), path, DIFFS, number)
    before = sorted(tuples(read_batches(spark, path, DIFFS), *DIFFS.names), key=str)
    compact(spark, path, DIFFS, AS_OF.date())
    stored = read_batches(spark, path, DIFFS)
    assert sorted(tuples(stored, *DIFFS.names), key=str) == before
    day = stored.filter(F.col("obs_date") == F.lit(AS_OF.date()))
    assert day.select(F.input_file_name()).distinct().count() == 1 and stored.select("batch_id").distinct().count() == 6
    compact(spark, path, DIFFS, AS_OF.date() - timedelta(days=40))  # a day without batches


def test_rates_by_value_are_a_setting(make, verdict):
    """One name live on two links with two counts: each line takes its own rate instead of both."""
    diffs = make("DIFFS", [diff_row("a", 20), diff_row("a", 40, link=YT + "2")])
    known = verdict(("a", 20, 5), ("a", 40, 7))
    found = lambda s: sorted(tuples(report.graded_report(diffs, known, AS_OF, s), "online", "rate_online_ci"))
    assert found(Settings()) == [(20, 5), (20, 7), (40, 5), (40, 7)]
    assert found(Settings(rates_by_value=True)) == [(20, 5), (40, 7)]


def test_tables_written_aside_are_removed(spark, make, verdict, tmp_path):
    with temporary(spark, "x") as aside:
        lines = report.report_lines(report.graded_report(make("DIFFS", [diff_row("a", 20)]), verdict(), AS_OF), aside)
        assert lines.count() >= 0 and matching(spark, aside)
    assert not matching(spark, aside)


def test_stored_and_plain_tables_give_the_same_newest_batch(spark, make, tmp_path):
    rows = [diff_row(f"n{i}", 20 + i, when=AS_OF - timedelta(hours=7 * (i % 5))) for i in range(25)]
    path = str(tmp_path / "diffs")
    append_batch(make("DIFFS", rows), path, DIFFS, batch_id=1)
    for as_of in (AS_OF, AS_OF - timedelta(hours=8)):
        plain = report.report_rows(make("DIFFS", rows), as_of)
        stored = report.report_rows(read_batches(spark, path, DIFFS), as_of)
        assert sorted(tuples(plain)) == sorted(tuples(stored)) != []
