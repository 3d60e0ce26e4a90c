"""Extraction from pages and replies."""

import time

import pytest
from pyspark.sql import functions as F

from livegauge.functions import payload
from livegauge.operators import extract
from livegauge.plans import ingest
from livegauge.sources import payloads, tables
from livegauge.schemas import OBSERVATIONS, PAGES, REPLIES
from tests.conftest import tuples

AS_OF = "2024-01-31 00:00:00"
MARKER = '<img src="/vi/hqdefault_live.jpg">'
LINKS = (
    '<a href="/x"></a><a href="https://www.youtube.com/WATCH?v=AbC123"></a>'
    '<a href="https://www.youtube.com/watch?v=zzz"></a>'
)
COUNTS = '<script>{"a":1,"originalViewCount":"12"}},"originalViewCount":"3456"}},"b":2}</script>'


def value(spark, column):
    return spark.range(1).select(column).first()[0]


def test_first_link_and_last_token(make):
    pages = make("PAGES", [("a", "u", MARKER + LINKS + COUNTS), ("off", "u", LINKS + COUNTS)])
    found = extract.observations_from_pages(pages, AS_OF)
    assert found.columns == OBSERVATIONS.names
    assert tuples(found, "name", "online", "link") == [("a", 3456, "https://youtu.be/AbC123")]


def test_marker_is_sought_without_non_ascii_characters(make):
    html = MARKER.replace("default", "defaulté") + LINKS + COUNTS
    assert extract.observations_from_pages(make("PAGES", [("a", "u", html)]), AS_OF).count() == 1


@pytest.mark.parametrize(
    "html",
    [
        MARKER + LINKS,  # no count
        MARKER + LINKS + ',"originalViewCount":"1.2K"}},',  # not a number
        MARKER + COUNTS,  # no link
    ],
)
def test_unreadable_live_pages_are_set_aside_alone(make, html):
    pages = make("PAGES", [("bad", "u", html), ("good", "u", MARKER + LINKS + COUNTS)])
    assert tuples(extract.rejected_pages(pages), "name") == [("bad",)]
    assert tuples(extract.observations_from_pages(pages, AS_OF), "name") == [("good",)]


@pytest.mark.parametrize(
    ("html", "links"),
    [
        ("<a href='/a'>x</a><A HREF=/b>", ["/a", "/b"]),
        ('<link rel="x"\n href = "/c?a=1&amp;b=2">', ["/c?a=1&b=2"]),
        ('<!-- <a href="/no"> --><a href="/yes">', ["/yes"]),
        ("<script>var s='<a href=\"/no\">'</script><a id=1 href=\"/yes\">", ["/yes"]),
        ('<p>href="/no"</p><a data-href="/no">', []),
        ("", []),
        ('<a href="">', [""]),
        ('<a href="/x"><!-- open <a href="/in">', ["/x"]),  # an open comment or script runs to the end
        ('<a href="/x"><script>"<a href=\'/in\'>', ["/x"]),
        ('<STYLE x>a{}<a href="/in"></styles></style ><a href="/y">', ["/y"]),
        ('<a title="a>b" href="/x"><a class="x"href="/z">', ["/x", "/z"]),
        ('<a href="/x" href="/no"><a data-href="/no" HREF = /y><a href><a href= "/v">', ["/x", "/y", "/v"]),
        ('<a href="/a&#38;lt;b&#x26;c&#233;&#x1F600;&#0;&unknown;&amp;lt;&&nbsp;">', ["/a&lt;b&cé😀\ufffd&unknown;&lt;&\u00a0"]),
        ('<a href="/open" <a href=/in>', ["/open"]),
        ('<a href="/never closed', []),
        ("<a title='it' href=it's><p x='>' y=\"'\"><a/href=/s>", ["it's", "/s"]),
        ('<!--> <a href="/c"> <!---> <a href="/d"> <!-- --!> <a href="/e">', ["/c", "/d", "/e"]),
        ("<script>" + "x < y; " * 200_000 + '</script><a href="/after">' + "é" * 500_000, ["/after"]),
        ("<p " * 20_000 + '><a title="' + "t" * 100_000 + '" href="/far">', ["/far"]),
    ],
)
def test_links(spark, html, links):
    assert value(spark, payload.links(F.lit(html))) == links


@pytest.mark.parametrize("text", ["<a ", "<!--", "<script>", '<a href="', "<a x='", "<a href=/x ", "&#", "<style ", "< "])
def test_markup_that_never_closes_takes_time_in_proportion(spark, text):
    """A megabyte of it takes seconds; a scan that starts over at each would take hours."""
    page = spark.range(1).select(F.repeat(F.lit(text), 1_000_000 // len(text)).alias("html"))
    start = time.perf_counter()
    assert page.select(F.size(payload.links(F.col("html")))).first()[0] == 0
    assert time.perf_counter() - start < 20


@pytest.mark.parametrize(
    ("href", "chosen"),
    [
        ("https://www.youtube.com/watch?v=1", True),
        ("HTTPS://WWW.youtube.com/Watch?v=1", True),
        ("https://www.youtube.com/watch?u=https://www.youtube.com/watch", False),  # twice
        ("https://wwwXyoutube.com/watch?v=1", False),  # fits the pattern, is not the URL
        ("https://youtu.be/1", False),
    ],
)
def test_watch_link(spark, href, chosen):
    found = value(spark, payload.first_watch_link(F.array(F.lit("/x"), F.lit(href))))
    assert found == (href if chosen else None)


@pytest.mark.parametrize(
    ("text", "count"), [("3456", 3456), (" 7 ", 7), ("0", 0), ("1.2K", None), ("", None), (None, None)]
)
def test_count_text(spark, text, count):
    assert value(spark, payload.parse_count(F.lit(text).cast("string"))) == count


@pytest.mark.parametrize(
    ("body", "count"),
    [
        ('{"data":[{"viewer_count":7}]}', 7),
        ('{"data":[{"viewer_count":7,"x":1},{"viewer_count":9}]}', 7),
        ('{"data":[]}', 0),
        ('{"data":[{"viewer_count":', 0),
        ('{"error":"unauthorized"}', 0),
        (None, 0),
    ],
)
def test_reply_count(spark, body, count):
    assert value(spark, payload.reply_count(F.lit(body).cast("string"))) == count


def test_both_platform_jobs(spark, make):
    channels = make(
        "CHANNELS",
        [
            ("a", "youtube", "https://y/a", None, "yes"),
            ("idle", "youtube", "https://y/idle", None, "no"),  # inactive
            ("t", "twitch", "https://t/t", "tt", "no"),  # twitch takes inactive ones too
            ("off", "twitch", "https://t/off", "off", "yes"),
        ],
    )
    pages = make(
        "PAGES",
        [("?", "https://y/a/live", MARKER + LINKS + COUNTS), ("?", "https://y/idle/live", MARKER + LINKS + COUNTS)],
    )
    replies = make("REPLIES", [("tt", '{"data":[{"viewer_count":7}]}'), ("off", '{"data":[]}')])
    both = ingest.union_platforms(
        ingest.youtube_observations(channels, pages, AS_OF),
        ingest.observations_from_json(replies, channels, AS_OF),
    )
    assert sorted(tuples(both, "name", "online", "link")) == [
        ("a", 3456, "https://youtu.be/AbC123"),
        ("t", 7, "https://t/t"),
    ]


def test_landed_files(spark, make, tmp_path):
    make("PAGES", [("a", "u", "<p>"), ("b", "u", None)]).write.parquet(str(tmp_path / "pages"))
    make("REPLIES", [("a", "{}")]).write.json(str(tmp_path / "replies"))
    assert payloads.read_pages(spark, str(tmp_path / "pages")).schema.names == PAGES.names
    assert tuples(payloads.read_pages(spark, str(tmp_path / "pages")), "name") == [("a",)]
    assert tuples(payloads.read_replies(spark, str(tmp_path / "replies"), "json")) == [("a", "{}")]
    assert payloads.read_replies(spark, str(tmp_path / "replies"), "json").schema == REPLIES
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "kanal é.html").write_text("<p>\né</p>", encoding="utf-8")
    found = payloads.read_page_files(spark, str(tmp_path / "html"))
    assert tuples(found, "name", "html") == [("kanal é", "<p>\né</p>")]


def test_query_text(spark, make):
    rows = make("OBSERVATIONS", [("a", 1, "x", None), ("b", 9, "x", None)])
    assert tuples(tables.read_query(spark, "SELECT name FROM {obs} WHERE online > 5", obs=rows)) == [("b",)]


def test_database_reads_are_split():
    options = tables.jdbc_options(
        "jdbc:x", "SELECT * FROM t", "id", "0", "100", 8, user="u", driver="org.example.Driver"
    )
    assert options["dbtable"] == "(SELECT * FROM t) AS source"
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("id", "8", "u")
    assert "query" not in options  # Spark refuses it together with a partition column
