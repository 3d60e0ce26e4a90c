"""The library's tables derived from the given ones, for Spark and as SQL.

``events`` become observations, ``customer`` the channels, ``pages`` the landed live pages and ``events.props``
the landed API replies. Every table grows with its source.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.plans.baseline import baseline_stats, baseline_verdict
from livegauge.plans.report import graded_report
from livegauge.plans.snapshot import diff_backfill
from livegauge.schemas import DIFFS
from livegauge.settings import Settings
from livegauge.sinks.tables import append_batch
from livegauge.sources.tables import read_batches
from livegauge.storage import new_path

AS_OF = datetime(2024, 1, 31)
DAILY = Settings(bucket_minutes=1440)  # at the small scales a ten-minute bucket holds two or three events


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _concat(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, ts = F.col("user_id"), F.col("ts")
    link = (
        F.when((user % 13 == 6) & (F.col("event_id") % 2 == 0), _concat("https://www.twitch.tv/alt", user))
        .when(user % 10 == 0, _concat("https://vk.example/u", user))
        .when(user % 4 == 2, _concat("https://youtu.be/v", user, "_", F.day(ts)))
        .when(user % 2 == 0, _concat("https://youtu.be/v", user))
        .otherwise(_concat("https://www.twitch.tv/u", user))
    )
    return table(spark, sf_dir, "events").select(
        _concat("user_", user).alias("name"),
        F.floor(F.col("value") * 10).cast("bigint").alias("online"),
        link.alias("link"),
        ts.cast("timestamp_ntz").alias("datetime"),
    )


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    main = F.when(key % 2 == 0, "youtube").otherwise("twitch")
    second = F.when(key % 2 == 0, "twitch").otherwise("youtube")
    listed = F.array_compact(F.array(F.when(key % 11 != 5, main), F.when(key % 7 == 3, second)))
    rows = table(spark, sf_dir, "customer").select(key, F.explode(listed).alias("platform"))
    big = F.when(F.col("platform") == "twitch", _concat("u", key)).when(key % 3 == 0, "yes")
    return rows.select(
        _concat("user_", key).alias("name"),
        "platform",
        _concat("https://", F.col("platform"), ".example/", key).alias("link"),
        big.alias("big_stream"),
        F.when(key % 5 == 0, "no").otherwise("yes").alias("actual"),
    )


def live_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages, whole, with the live fragments of a channel page appended."""
    page = F.col("page_id")
    marker = (
        F.when(page % 5 == 0, "")
        .when(page % 5 == 1, '<img src="/vi/hqdefaulté_live.jpg">')
        .otherwise('<img src="/vi/hqdefault_live.jpg">')
    )
    watch = F.when(page % 13 == 6, "<!-- <a href=\"https://www.youtube.com/watch?v=old\"> -->").otherwise(
        _concat(
            '<a class="x" href="/feed"></a><a href=\'https://www.youtube.com/WATCH?v=Pg', page,
            "&amp;t=1'></a><link href=\"https://www.youtube.com/watch?v=later\">",
        )
    )
    count = (
        F.when(page % 7 == 3, '"views":"1"')
        .when(page % 11 == 4, '"originalViewCount":"1.2K"}}')
        .otherwise(_concat('"originalViewCount":"12"}},"originalViewCount":"', page * 37 % 4001, '"}}'))
    )
    # Markup that a search for tags and quotes alone gets wrong.
    odd = (
        F.when(page % 13 == 2, '<a title="a>b" href="/quoted">')
        .when(page % 13 == 3, '<a class="x"href="/close">')
        .when(page % 13 == 4, '<a href="/n&#38;m&#x3D;1&#233;">')
        .when(page % 13 == 5, '<script>var open="<a href=\'/in\'>')
        .otherwise("")
    )
    html = F.concat(
        F.col("html"), marker, watch, F.lit("<script>var d={x:1,"), count, F.lit(",y:2}</script>"), odd
    )
    key = page + F.lit(1)
    return table(spark, sf_dir, "pages").select(
        _concat("user_", key).alias("name"),
        _concat("https://youtube.example/", key, "/live").alias("url"),
        html.alias("html"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    body = (
        F.when(event % 17 == 0, '{"data":[]}')
        .when(event % 19 == 0, '{"data":[{"viewer_count":')
        .when(event % 23 == 0, '{"error":"unauthorized"}')
        .otherwise(
            _concat('{"data":[{"viewer_count":', F.get_json_object("props", "$.k"), ',"type":"live"}]}')
        )
    )
    return table(spark, sf_dir, "events").select(
        _concat("u", F.col("user_id")).alias("login"), body.alias("body")
    )


def backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diff_backfill(observations(spark, sf_dir), DAILY)


def diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backfill(spark, sf_dir).select(*DIFFS.names)


def stored_diffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The differences as the table the report jobs read, which need them more than once."""
    path = new_path(spark, "diffs")
    append_batch(diffs(spark, sf_dir), path, DIFFS, batch_id=0)
    return read_batches(spark, path, DIFFS)


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline_stats(observations(spark, sf_dir), channels(spark, sf_dir), AS_OF)


def verdict(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None) -> DataFrame:
    stored = stored or stored_diffs(spark, sf_dir)
    return baseline_verdict(stored, stats(spark, sf_dir), AS_OF)


def report(spark: SparkSession, sf_dir: str, stored: DataFrame | None = None) -> DataFrame:
    stored = stored or stored_diffs(spark, sf_dir)
    return graded_report(stored, verdict(spark, sf_dir, stored), AS_OF)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles to six places, by way of a decimal so that both engines break ties alike."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("decimal(38,10)"), 6).cast("double") for c in columns}
    )


# The same tables as SQL, in order of dependence.
_TABLES = {
    "observations": """
        SELECT 'user_' || user_id AS name,
               CAST(floor(value * 10) AS BIGINT) AS online,
               CASE WHEN user_id % 13 = 6 AND event_id % 2 = 0 THEN 'https://www.twitch.tv/alt' || user_id
                    WHEN user_id % 10 = 0 THEN 'https://vk.example/u' || user_id
                    WHEN user_id % 4 = 2 THEN 'https://youtu.be/v' || user_id || '_' || day(ts)
                    WHEN user_id % 2 = 0 THEN 'https://youtu.be/v' || user_id
                    ELSE 'https://www.twitch.tv/u' || user_id END AS link,
               ts AS datetime
        FROM events""",
    "channel_keys": """
        SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'youtube' ELSE 'twitch' END AS platform
        FROM customer WHERE c_custkey % 11 <> 5
        UNION ALL
        SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'twitch' ELSE 'youtube' END
        FROM customer WHERE c_custkey % 7 = 3""",
    "channels": """
        SELECT 'user_' || k AS name, platform, 'https://' || platform || '.example/' || k AS link,
               CASE WHEN platform = 'twitch' THEN 'u' || k WHEN k % 3 = 0 THEN 'yes' END AS big_stream,
               CASE WHEN k % 5 = 0 THEN 'no' ELSE 'yes' END AS actual
        FROM channel_keys""",
    "live_pages": """
        SELECT 'user_' || (page_id + 1) AS name,
               'https://youtube.example/' || (page_id + 1) || '/live' AS url,
               html
               || CASE WHEN page_id % 5 = 0 THEN ''
                       WHEN page_id % 5 = 1 THEN '<img src="/vi/hqdefaulté_live.jpg">'
                       ELSE '<img src="/vi/hqdefault_live.jpg">' END
               || CASE WHEN page_id % 13 = 6
                       THEN '<!-- <a href="https://www.youtube.com/watch?v=old"> -->'
                       ELSE '<a class="x" href="/feed"></a><a href=''https://www.youtube.com/WATCH?v=Pg'
                            || page_id
                            || '&amp;t=1''></a><link href="https://www.youtube.com/watch?v=later">' END
               || '<script>var d={x:1,'
               || CASE WHEN page_id % 7 = 3 THEN '"views":"1"'
                       WHEN page_id % 11 = 4 THEN '"originalViewCount":"1.2K"}}'
                       ELSE '"originalViewCount":"12"}},"originalViewCount":"'
                            || (page_id * 37 % 4001) || '"}}' END
               || ',y:2}</script>'
               || CASE page_id % 13 WHEN 2 THEN '<a title="a>b" href="/quoted">'
                                    WHEN 3 THEN '<a class="x"href="/close">'
                                    WHEN 4 THEN '<a href="/n&#38;m&#x3D;1&#233;">'
                                    WHEN 5 THEN '<script>var open="<a href=''/in''>'
                                    ELSE '' END AS html
        FROM pages""",
    "page_links": r"""
        SELECT * EXCLUDE (tags), list_transform(
                   list_filter(
                     list_transform(tags, lambda x: regexp_extract(x, '(?i)[\s"'']href\s*=\s*("[^"]*"|''[^'']*''|[^\s"''>]+)', 1)),
                     lambda x: x <> ''),
                   lambda x: replace(replace(replace(replace(replace(replace(replace(replace(
                     regexp_replace(x, '^["'']|["'']$', '', 'g'),
                     '&quot;', '"'), '&#39;', ''''), '&#x3D;', '='), '&#233;', 'é'), '&lt;', '<'), '&gt;', '>'), '&#38;', '&'), '&amp;', '&')) AS hrefs
        FROM (SELECT *, regexp_extract_all(
                regexp_replace(html,
                  '(?is)<!--.*?(?:-->|\z)|<script\b[^>]*>.*?(?:</script\s*>|\z)|<style\b[^>]*>.*?(?:</style\s*>|\z)', '', 'g'),
                '(?is)<[a-z](?:[^"''>]|"[^"]*"|''[^'']*'')*>') AS tags
              FROM live_pages)""",
    "page_fields": """
        SELECT name, url,
               'https://youtu.be/' || substr(
                 list_filter(hrefs, lambda x: regexp_extract_all(lower(x), 'https://www.youtube.com/watch')
                                              = ['https://www.youtube.com/watch'])[1], 33) AS link,
               replace(replace(
                 list_filter(string_split(html, ','), lambda x: contains(x, 'originalViewCount'))[-1],
                 '"originalViewCount":"', ''), '"}}', '') AS count_text
        FROM page_links
        WHERE contains(regexp_replace(html, '[^\\x00-\\x7F]', '', 'g'), 'hqdefault_live.jpg')""",
    "page_counts": "SELECT *, TRY_CAST(count_text AS BIGINT) AS online FROM page_fields",
    "replies": """
        SELECT 'u' || user_id AS login,
               CASE WHEN event_id % 17 = 0 THEN '{"data":[]}'
                    WHEN event_id % 19 = 0 THEN '{"data":[{"viewer_count":'
                    WHEN event_id % 23 = 0 THEN '{"error":"unauthorized"}'
                    ELSE '{"data":[{"viewer_count":' || json_extract_string(props, '$.k')
                         || ',"type":"live"}]}' END AS body
        FROM events""",
    "counts": """
        SELECT login, CASE WHEN json_valid(body)
                           THEN coalesce(TRY_CAST(json_extract(body, '$.data[0].viewer_count') AS BIGINT), 0)
                           ELSE 0 END AS online
        FROM replies""",
    "cells": """
        SELECT name, link, CASE WHEN link LIKE '%youtu%' THEN 'youtube'
                                WHEN link LIKE '%twitch%' THEN 'twitch' END AS platform,
               date_trunc('day', datetime) AS bucket, max(online) AS online
        FROM observations GROUP BY ALL""",
    "ranked_cells": "SELECT *, dense_rank() OVER (ORDER BY bucket) AS r FROM cells",
    "newest_cells": """
        SELECT name, link, platform, bucket, online, CAST(r AS INTEGER) AS snapshot FROM (
          SELECT *, dense_rank() OVER (ORDER BY bucket DESC) AS r FROM (
            SELECT name, link, CASE WHEN link LIKE '%youtu%' THEN 'youtube'
                                    WHEN link LIKE '%twitch%' THEN 'twitch' END AS platform,
                   date_trunc('day', datetime) AS bucket, max(online) AS online
            FROM observations
            WHERE CAST(datetime AS DATE) >= DATE '2024-01-31' - INTERVAL 2 DAY
              AND datetime <= TIMESTAMP '2024-01-31'
            GROUP BY ALL))
        WHERE r <= 2""",
    "landings": """
        SELECT landing, max(datetime) AS as_of
        FROM observations JOIN (VALUES (1, TIMESTAMP '2024-01-11'), (2, TIMESTAMP '2024-01-21'), (3, NULL)) v(landing, before)
          ON before IS NULL OR datetime < before
        GROUP BY landing""",
    "landed_cells": """
        SELECT *, dense_rank() OVER (PARTITION BY landing ORDER BY bucket DESC) AS r FROM (
          SELECT landing, as_of, name, link,
                 CASE WHEN link LIKE '%youtu%' THEN 'youtube' WHEN link LIKE '%twitch%' THEN 'twitch' END
                   AS platform,
                 date_trunc('day', datetime) AS bucket, max(online) AS online
          FROM observations JOIN landings
            ON datetime <= as_of AND CAST(datetime AS DATE) >= CAST(as_of AS DATE) - INTERVAL 2 DAY
          GROUP BY ALL)""",
    "diffs": """
        SELECT c.name, c.online, coalesce(c.online - p.online, 0) AS online_diff, c.link, c.platform,
               c.bucket + INTERVAL 1 DAY AS datetime
        FROM ranked_cells c LEFT JOIN ranked_cells p ON c.link = p.link AND c.r = p.r + 1""",
    "history": """
        SELECT o.*, c.platform, c.link AS channel_link
        FROM observations o LEFT JOIN channels c ON o.name = c.name
        WHERE o.datetime <= TIMESTAMP '2024-01-31' AND o.datetime >= TIMESTAMP '2024-01-31' - INTERVAL 15 DAY""",
    "stats": """
        SELECT name, platform, count(*) AS n, avg(online) AS avg_online, stddev(online) AS stddev_online,
               stddev(online) / sqrt(count(*)) * 1.96 AS margin_of_error,
               avg(online) - stddev(online) / sqrt(count(*)) * 1.96 AS ci_lower_bound,
               avg(online) + stddev(online) / sqrt(count(*)) * 1.96 AS ci_upper_bound
        FROM history GROUP BY name, platform""",
    "last_online": """
        SELECT d.name, d.online FROM diffs d LEFT JOIN channels c ON d.name = c.name
        WHERE d.datetime = (SELECT max(datetime) FROM diffs
                            WHERE datetime BETWEEN TIMESTAMP '2024-01-29' AND TIMESTAMP '2024-01-31')""",
    "verdict": """
        SELECT DISTINCT lo.name, lo.online, six(avg_online) AS avg_online,
               six(1 - avg_online / nullif(lo.online, 0)) AS rate_online,
               CASE WHEN ci_upper_bound < lo.online THEN 1 ELSE 0 END AS flg_top_online,
               six(margin_of_error) AS margin_of_error,
               six(ci_lower_bound) AS ci_lower_bound, six(ci_upper_bound) AS ci_upper_bound,
               CAST(round(CAST((1 - ci_upper_bound / nullif(lo.online, 0)) * 100 AS DECIMAL(38, 10)), 0)
                    AS INTEGER) AS rate_online_ci
        FROM last_online lo LEFT JOIN stats s ON lo.name = s.name""",
    "report_rows": """
        SELECT name, online, online_diff, link, platform FROM diffs
        WHERE online > 5
          AND datetime = (SELECT max(datetime) FROM diffs WHERE online > 5
                          AND datetime BETWEEN TIMESTAMP '2024-01-29' AND TIMESTAMP '2024-01-31')""",
    "rated": """
        SELECT r.*, coalesce(v.rate_online_ci, -500) AS rate_online_ci
        FROM report_rows r LEFT JOIN verdict v ON r.name IS NOT DISTINCT FROM v.name""",
    "shown": """
        SELECT rated.*, section FROM rated
        JOIN (VALUES ('youtube', 'youtu.be'), ('twitch', 'twitch.tv')) s(section, pattern)
          ON regexp_matches(link, pattern)
        WHERE online > 15 AND rate_online_ci > -350""",
    "report": """
        SELECT *,
               CASE WHEN rate_online_ci > -50 AND rate_online_ci < 30 THEN 'within'
                    WHEN rate_online_ci <= -50 THEN 'low' ELSE 'high' END AS grade,
               CASE WHEN online_diff > 0 THEN 'up' WHEN online_diff < 0 THEN 'down' ELSE 'flat' END AS trend
        FROM shown""",
    "lines": """
        SELECT *,
               CASE grade WHEN 'within' THEN '🔸 ' WHEN 'low' THEN '✖️ ' ELSE '✔️ ' END
               || ' [' || name || '](' || link || ') [[' || online || ']] '
               || CASE trend WHEN 'up' THEN '🟢 +' WHEN 'down' THEN '🔴 ' ELSE '🟡 ' END
               || online_diff AS line,
               row_number() OVER (ORDER BY platform DESC NULLS FIRST, online DESC NULLS FIRST,
                                  name, link, online_diff, rate_online_ci, section) AS position
        FROM report""",
    "message": """
        SELECT TIMESTAMP '2024-01-31' AS datetime,
               CASE WHEN (SELECT coalesce(max(datetime) > TIMESTAMP '2024-01-31' - INTERVAL 10 MINUTE, false)
                          FROM diffs WHERE datetime <= TIMESTAMP '2024-01-31')
                    THEN '⭐️ Online Streams: ⭐️' || chr(10) || chr(10)
                      || coalesce(string_agg(line, chr(10) ORDER BY position)
                                  FILTER (section = 'youtube'), '')
                      || chr(10) || chr(10)
                      || coalesce(string_agg(line, chr(10) ORDER BY position)
                                  FILTER (section = 'twitch'), '')
                    ELSE '❌ Not Online Streams:' END AS message
        FROM lines""",
}

_NEEDS = {
    "observations": [],
    "channel_keys": [],
    "channels": ["channel_keys"],
    "live_pages": [],
    "page_links": ["live_pages"],
    "page_fields": ["page_links"],
    "page_counts": ["page_fields"],
    "replies": [],
    "counts": ["replies"],
    "cells": ["observations"],
    "ranked_cells": ["cells"],
    "newest_cells": ["observations"],
    "landings": ["observations"],
    "landed_cells": ["observations", "landings"],
    "diffs": ["ranked_cells"],
    "history": ["observations", "channels"],
    "stats": ["history"],
    "last_online": ["diffs", "channels"],
    "verdict": ["last_online", "stats"],
    "report_rows": ["diffs"],
    "rated": ["report_rows", "verdict"],
    "shown": ["rated"],
    "report": ["shown"],
    "lines": ["report"],
    "message": ["lines", "diffs"],
}


_SIX = re.compile(r"\bsix\(((?:[^()]|\([^()]*\))*)\)")


def sql(body: str, *tables: str) -> str:
    """``body`` with the named derived tables, and what they need, in front; ``six(x)`` rounds as above."""
    wanted: set[str] = set()

    def add(name: str) -> None:
        wanted.add(name)
        for other in _NEEDS[name]:
            add(other)

    for name in tables:
        add(name)
    parts = [f"{name} AS ({_TABLES[name]})" for name in _TABLES if name in wanted]
    text = f"WITH {', '.join(parts)} {body}" if parts else body
    return _SIX.sub(r"CAST(round(CAST(\1 AS DECIMAL(38, 10)), 6) AS DOUBLE)", text)
