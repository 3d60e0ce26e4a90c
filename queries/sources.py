"""Scans."""

from pyspark.sql import functions as F

from livegauge.functions.payload import reply_count, reply_field
from livegauge.sources.tables import read_query
from queries import inputs
from queries.inputs import sql
from queries.registry import query


@query(sql("SELECT name, online, link, datetime FROM observations ", "observations"))
def scan_observations(spark, sf_dir):
    text = "SELECT name, online, link, datetime FROM {observations}"
    return read_query(spark, text, observations=inputs.observations(spark, sf_dir))


@query(sql("SELECT name, platform, link, big_stream, actual FROM channels", "channels"))
def scan_channels(spark, sf_dir):
    return inputs.channels(spark, sf_dir)


@query("SELECT page_id, url, html FROM pages WHERE html IS NOT NULL")
def scan_pages(spark, sf_dir):
    pages = inputs.table(spark, sf_dir, "pages")
    return pages.select("page_id", "url", "html").filter(F.col("html").isNotNull())


@query(
    sql(
        """SELECT e.event_id, coalesce(TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT), 0) AS k
           FROM events e"""
    )
)
def scan_json_payloads(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events")
    return events.select("event_id", reply_field(F.col("props"), "$.k").alias("k"))


@query(sql("SELECT login, body, online FROM (SELECT r.login, r.body, "
           "CASE WHEN json_valid(body) THEN coalesce(TRY_CAST(json_extract(body, '$.data[0].viewer_count') "
           "AS BIGINT), 0) ELSE 0 END AS online FROM replies r)", "replies"))
def json_path_default(spark, sf_dir):
    replies = inputs.replies(spark, sf_dir)
    return replies.withColumn("online", reply_count(F.col("body")))
