"""Payloads to counts."""

from pyspark.sql import functions as F

from livegauge.functions import payload
from livegauge.operators import extract
from livegauge.plans import ingest
from livegauge.schemas import REJECTS
from livegauge.sinks.tables import append_batch
from livegauge.sources.tables import read_batches
from livegauge.storage import new_path
from queries import inputs
from queries.inputs import AS_OF, sql
from queries.registry import query


@query(r"SELECT page_id, regexp_replace(html, '[^\x00-\x7F]', '', 'g') AS html FROM pages")
def ascii_strip(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", payload.ascii_strip(F.col("html")).alias("html"))


@query(sql(r"""SELECT name, url FROM live_pages
               WHERE contains(regexp_replace(html, '[^\x00-\x7F]', '', 'g'), 'hqdefault_live.jpg')""",
           "live_pages"))
def live_marker_filter(spark, sf_dir):
    return extract.live_pages(inputs.live_pages(spark, sf_dir)).select("name", "url")


@query(sql("""SELECT name, i - 1 AS place, hrefs[i] AS href
              FROM (SELECT name, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM page_links)""",
           "page_links"))
def extract_links(spark, sf_dir):
    links = payload.links(F.col("html"))
    placed = inputs.live_pages(spark, sf_dir).select("name", F.posexplode(links).alias("place", "href"))
    return placed.withColumn("place", F.col("place").cast("bigint"))


@query(sql("""SELECT name, list_filter(hrefs, lambda x:
                  regexp_extract_all(lower(x), 'https://www.youtube.com/watch')
                  = ['https://www.youtube.com/watch'])[1] AS link FROM page_links""", "page_links"))
def first_matching_link(spark, sf_dir):
    watch = payload.watch_link(F.col("html"))
    return inputs.live_pages(spark, sf_dir).select("name", watch.alias("link"))


@query(sql("SELECT name, link FROM page_fields WHERE link IS NOT NULL", "page_fields"))
def canonical_link(spark, sf_dir):
    pages = extract.page_fields(inputs.live_pages(spark, sf_dir))
    return pages.filter(F.col("link").isNotNull()).select("name", "link")


@query(sql("SELECT name, count_text FROM page_fields", "page_fields"))
def last_token_value(spark, sf_dir):
    return extract.page_counts(inputs.live_pages(spark, sf_dir)).select("name", "count_text")


@query(sql("SELECT name, count_text, TRY_CAST(count_text AS BIGINT) AS online FROM page_fields",
           "page_fields"))
def parse_count(spark, sf_dir):
    return extract.page_counts(inputs.live_pages(spark, sf_dir)).select("name", "count_text", "online")


@query(sql("SELECT name, url, link, count_text FROM page_counts WHERE online IS NULL OR link IS NULL",
           "page_counts"))
def rejected_pages(spark, sf_dir):
    pages = inputs.live_pages(spark, sf_dir)
    return extract.rejected_pages(pages).select("name", "url", "link", "count_text")


@query(sql("SELECT name, url, link, online FROM page_counts WHERE online IS NOT NULL AND link IS NOT NULL",
           "page_counts"))
def drop_missing(spark, sf_dir):
    fields = extract.page_fields(inputs.live_pages(spark, sf_dir))
    return extract.drop_missing(fields).select("name", "url", "link", "online")


@query(sql("""SELECT name, online, link, TIMESTAMP '2024-01-31' AS datetime FROM page_counts
              WHERE online IS NOT NULL AND link IS NOT NULL""", "page_counts"))
def observations_from_pages(spark, sf_dir):
    return extract.observations_from_pages(inputs.live_pages(spark, sf_dir), AS_OF)


YOUTUBE_SQL = """
    SELECT c.name, p.online, p.link, TIMESTAMP '2024-01-31' AS datetime
    FROM channels c JOIN page_counts p ON p.url = c.link || '/live'
    WHERE c.platform = 'youtube' AND c.actual = 'yes' AND p.online IS NOT NULL AND p.link IS NOT NULL"""
@query(sql("""SELECT p.name, p.url, p.link, p.count_text, TIMESTAMP '2024-01-31' AS datetime,
                     CASE WHEN p.link IS NULL THEN 'no link' WHEN p.online IS NULL THEN 'no count' ELSE 'no channel' END AS reason
              FROM page_counts p
              LEFT JOIN (SELECT * FROM channels WHERE platform = 'youtube' AND actual = 'yes') c ON p.url = c.link || '/live'
              WHERE p.link IS NULL OR p.online IS NULL OR c.link IS NULL""", "channels", "page_counts"))
def quarantined_pages(spark, sf_dir):
    """Read back from the table the page job writes beside the observations."""
    channels, path = inputs.channels(spark, sf_dir), new_path(spark, "rejected")
    fields = extract.page_fields(inputs.live_pages(spark, sf_dir))
    append_batch(ingest.rejected(ingest.page_outcomes(channels, fields, AS_OF)), path, REJECTS, 0)
    return read_batches(spark, path, REJECTS).select(*REJECTS.names)


TWITCH_SQL = """
    SELECT c.name, r.online, c.link, TIMESTAMP '2024-01-31' AS datetime
    FROM (SELECT * FROM counts WHERE online > 0) r
    LEFT JOIN (SELECT * FROM channels WHERE platform = 'twitch') c
      ON r.login = c.big_stream"""


@query(sql(YOUTUBE_SQL, "channels", "page_counts"))
def youtube_observations(spark, sf_dir):
    channels, pages = inputs.channels(spark, sf_dir), inputs.live_pages(spark, sf_dir)
    return ingest.youtube_observations(channels, pages, AS_OF)


@query(sql(TWITCH_SQL, "channels", "counts"))
def observations_from_json(spark, sf_dir):
    replies, channels = inputs.replies(spark, sf_dir), inputs.channels(spark, sf_dir)
    return ingest.observations_from_json(replies, channels, AS_OF)


@query(sql(f"{YOUTUBE_SQL} UNION ALL {TWITCH_SQL}", "channels", "page_counts", "counts"))
def union_platforms(spark, sf_dir):
    return ingest.union_platforms(youtube_observations(spark, sf_dir), observations_from_json(spark, sf_dir))
