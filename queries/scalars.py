"""Scalar functions over whole tables."""

from pyspark.sql import functions as F

from livegauge.functions import clock, labels, stats
from livegauge.plans import report
from queries import inputs
from queries.aggregates import TEN_MINUTES
from queries.inputs import AS_OF, rounded, sql
from queries.registry import query


def _timed(spark, sf_dir):
    return inputs.observations(spark, sf_dir).select("name", "datetime")


@query(sql(f"SELECT name, datetime, {TEN_MINUTES} AS bucket FROM observations", "observations"))
def bucket_10min(spark, sf_dir):
    return _timed(spark, sf_dir).withColumn("bucket", clock.bucket_start(F.col("datetime"), 10))


@query(sql("SELECT name, datetime, date_trunc('hour', datetime) AS hour_start FROM observations",
           "observations"))
def trunc_hour(spark, sf_dir):
    return _timed(spark, sf_dir).withColumn("hour_start", clock.hour_start(F.col("datetime")))


@query(sql("SELECT name, datetime, minute(datetime) AS minute FROM observations", "observations"))
def extract_minute(spark, sf_dir):
    return _timed(spark, sf_dir).withColumn("minute", clock.minute_of_hour(F.col("datetime")))


@query(sql("""SELECT name, datetime, CAST(CAST(datetime AS DATE) AS VARCHAR) AS day,
                     strftime(CAST(datetime AS DATE) - INTERVAL 2 DAY, '%Y-%m-%d') AS first_day
              FROM observations""", "observations"))
def date_arith(spark, sf_dir):
    day = clock.day_of(F.col("datetime"))
    return (
        _timed(spark, sf_dir)
        .withColumn("day", day.cast("string"))
        .withColumn("first_day", F.date_sub(day, 2).cast("string"))
    )


@query(sql("""SELECT name, datetime, datetime - INTERVAL 15 DAY AS window_start,
                     datetime + INTERVAL 1 MINUTE * CAST(minute(datetime) AS INTEGER) AS later
              FROM observations""", "observations"))
def interval_arith(spark, sf_dir):
    ts = F.col("datetime")
    return (
        _timed(spark, sf_dir)
        .withColumn("window_start", clock.days_before(ts, 15))
        .withColumn("later", clock.minutes_later(ts, clock.minute_of_hour(ts)))
    )


@query(sql("""SELECT c.name, c.link, c.bucket, c.online, coalesce(c.online - p.online, 0) AS online_diff
              FROM ranked_cells c LEFT JOIN ranked_cells p ON c.link = p.link AND c.r = p.r + 1""",
           "ranked_cells"))
def diff_or_zero(spark, sf_dir):
    return inputs.backfill(spark, sf_dir).select("name", "link", "bucket", "online", "online_diff")


@query(sql("""SELECT name, datetime, epoch_us(TIMESTAMP '2024-01-31') - epoch_us(datetime) AS age_micros
              FROM observations""", "observations"))
def age_minutes(spark, sf_dir):
    minutes = clock.age_minutes(F.col("datetime"), AS_OF)
    micros = F.round(minutes * F.lit(60_000_000)).cast("bigint")
    return _timed(spark, sf_dir).withColumn("age_micros", micros)


@query(sql("""SELECT CASE WHEN max(datetime) > TIMESTAMP '2024-01-31' - INTERVAL 10 MINUTE THEN 1 ELSE 0 END
                     AS flag FROM observations WHERE datetime <= TIMESTAMP '2024-01-31'""", "observations"))
def freshness_flag(spark, sf_dir):
    return report.freshness_flag(inputs.observations(spark, sf_dir), AS_OF)


_JOINED = """FROM observations o JOIN stats s ON o.name = s.name"""


def _with_stats(spark, sf_dir):
    observations = inputs.observations(spark, sf_dir).select("name", "datetime", "online")
    return observations.join(inputs.stats(spark, sf_dir), "name")


@query(sql(f"""SELECT o.name, o.datetime, o.online, s.platform,
                      six(1 - avg_online / nullif(o.online, 0)) AS rate {_JOINED}""",
           "observations", "stats"))
def rate_vs_mean(spark, sf_dir):
    rate = stats.rate_vs_mean(F.col("avg_online"), F.col("online"))
    rows = _with_stats(spark, sf_dir).select("name", "datetime", "online", "platform", rate.alias("rate"))
    return rounded(rows, "rate")


@query(sql(f"""SELECT o.name, o.datetime, o.online, s.platform,
                      CAST(round(CAST((1 - ci_upper_bound / nullif(o.online, 0)) * 100
                                      AS DECIMAL(38, 10)), 0) AS INTEGER) AS rate {_JOINED}""",
           "observations", "stats"))
def rate_vs_upper(spark, sf_dir):
    rate = stats.rate_vs_upper(F.col("ci_upper_bound"), F.col("online"))
    return _with_stats(spark, sf_dir).select("name", "datetime", "online", "platform", rate.alias("rate"))


@query(sql(f"""SELECT o.name, o.datetime, o.online, s.platform,
                      CASE WHEN ci_upper_bound < o.online THEN 1 ELSE 0 END AS flag {_JOINED}""",
           "observations", "stats"))
def above_bound_flag(spark, sf_dir):
    flag = stats.above_bound(F.col("ci_upper_bound"), F.col("online"))
    return _with_stats(spark, sf_dir).select("name", "datetime", "online", "platform", flag.alias("flag"))


@query(sql("SELECT name, online, coalesce(rate_online_ci, -500) AS rate FROM verdict", "verdict"))
def fill_rate(spark, sf_dir):
    rate = stats.fill_rate(F.col("rate_online_ci"), -500)
    return inputs.verdict(spark, sf_dir).select("name", "online", rate.alias("rate"))


@query(sql("""SELECT name, online, coalesce(rate_online_ci, -500) AS rate,
                     CASE WHEN coalesce(rate_online_ci, -500) > -50 AND coalesce(rate_online_ci, -500) < 30
                          THEN 'within' WHEN coalesce(rate_online_ci, -500) <= -50 THEN 'low'
                          ELSE 'high' END AS grade FROM verdict""", "verdict"))
def grade(spark, sf_dir):
    return fill_rate(spark, sf_dir).withColumn("grade", labels.grade(F.col("rate")))


@query(sql("""SELECT *, CASE WHEN online_diff > 0 THEN 'up' WHEN online_diff < 0 THEN 'down'
                             ELSE 'flat' END AS trend FROM diffs""", "diffs"))
def trend(spark, sf_dir):
    return inputs.diffs(spark, sf_dir).withColumn("trend", labels.trend(F.col("online_diff")))


@query(sql("SELECT section, name, line FROM lines", "lines"))
def render_line(spark, sf_dir):
    rows = inputs.report(spark, sf_dir)
    return rows.select("section", "name", report.rendered_line().alias("line"))


@query(sql("""SELECT datetime, CASE WHEN flag = 0 THEN '❌ Not Online Streams:'
                     ELSE '⭐️ Online Streams: ⭐️' || chr(10) || chr(10) || coalesce(youtube, '')
                          || chr(10) || chr(10) || coalesce(twitch, '') END AS message
              FROM (SELECT datetime, least(count(*) % 3, 1) AS flag,
                           max(name) FILTER (platform = 'youtube') AS youtube,
                           max(name) FILTER (platform = 'twitch') AS twitch
                    FROM diffs GROUP BY datetime)""", "diffs"))
def render_report(spark, sf_dir):
    def block(platform):
        return F.max(F.when(F.col("platform") == platform, F.col("name"))).alias(platform)

    batches = inputs.diffs(spark, sf_dir).groupBy("datetime")
    flag = F.least(F.count("*") % 3, F.lit(1)).alias("flag")
    text = labels.message(F.col("flag"), F.col("youtube"), F.col("twitch"))
    return batches.agg(flag, block("youtube"), block("twitch")).select("datetime", text.alias("message"))


@query(r"""SELECT page_id, lower(html) AS lowered, len(string_split(html, ',')) AS pieces,
                  replace(html, '"', '') AS unquoted, substr(html, 33) AS sliced,
                  CAST(html LIKE '%</a>%' AS INTEGER) AS has_link,
                  CAST(regexp_matches(html, 'd.v') AS INTEGER) AS has_div,
                  CAST(contains(html, 'track(') AS INTEGER) AS tracked, url || '/live' AS live_url
           FROM pages""")
def string_functions(spark, sf_dir):
    html = F.col("html")
    return inputs.table(spark, sf_dir, "pages").select(
        "page_id",
        F.lower(html).alias("lowered"),
        F.size(F.split(html, ",")).cast("bigint").alias("pieces"),
        F.replace(html, F.lit('"'), F.lit("")).alias("unquoted"),
        F.substring(html, 33, 2**31 - 1).alias("sliced"),
        html.like("%</a>%").cast("int").alias("has_link"),
        html.rlike("d.v").cast("int").alias("has_div"),
        F.contains(html, F.lit("track(")).cast("int").alias("tracked"),
        F.concat("url", F.lit("/live")).alias("live_url"),
    )
