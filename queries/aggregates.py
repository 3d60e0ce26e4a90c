"""Aggregates."""

from pyspark.sql import functions as F

from livegauge.operators import buckets
from livegauge.operators.ordering import join_lines
from livegauge.plans import baseline, report
from livegauge.schemas import DAILY
from livegauge.sources.tables import read_table
from livegauge.storage import new_path
from queries import inputs
from queries.inputs import AS_OF, rounded, sql
from queries.registry import query

TEN_MINUTES = "time_bucket(INTERVAL 10 MINUTE, datetime)"
PLATFORM = "CASE WHEN link LIKE '%youtu%' THEN 'youtube' WHEN link LIKE '%twitch%' THEN 'twitch' END"


@query(sql(f"""SELECT name, link, {PLATFORM} AS platform, {TEN_MINUTES} AS bucket, max(online) AS online
               FROM observations GROUP BY ALL""", "observations"))
def bucket_max(spark, sf_dir):
    return buckets.bucket_max(inputs.observations(spark, sf_dir))


@query(sql("""SELECT name, platform, six(avg(online)) AS avg_online FROM history
              GROUP BY name, platform""", "history"))
def group_avg(spark, sf_dir):
    return rounded(inputs.stats(spark, sf_dir).select("name", "platform", "avg_online"), "avg_online")


@query(sql("""SELECT name, platform, six(stddev_samp(online)) AS stddev_online FROM history
              GROUP BY name, platform""", "history"))
def group_stddev(spark, sf_dir):
    return rounded(inputs.stats(spark, sf_dir).select("name", "platform", "stddev_online"), "stddev_online")


@query(sql("SELECT name, platform, count(*) AS n FROM history GROUP BY name, platform", "history"))
def group_count(spark, sf_dir):
    return inputs.stats(spark, sf_dir).select("name", "platform", "n")


@query(sql("SELECT name, platform, six(margin_of_error) AS margin_of_error FROM stats", "stats"))
def margin_of_error(spark, sf_dir):
    margins = inputs.stats(spark, sf_dir).select("name", "platform", "margin_of_error")
    return rounded(margins, "margin_of_error")


@query(sql("""SELECT name, platform, six(ci_lower_bound) AS ci_lower_bound,
                     six(ci_upper_bound) AS ci_upper_bound FROM stats""", "stats"))
def confidence_interval(spark, sf_dir):
    bounds = inputs.stats(spark, sf_dir).select("name", "platform", "ci_lower_bound", "ci_upper_bound")
    return rounded(bounds, "ci_lower_bound", "ci_upper_bound")


@query(sql("SELECT max(datetime) AS newest FROM observations", "observations"))
def latest_timestamp(spark, sf_dir):
    return inputs.observations(spark, sf_dir).agg(F.max("datetime").alias("newest"))


@query(sql("SELECT name, online, link FROM observations GROUP BY 1, 2, 3", "observations"))
def group_distinct(spark, sf_dir):
    return inputs.observations(spark, sf_dir).select("name", "online", "link").distinct()


@query(sql("SELECT section, string_agg(line, chr(10) ORDER BY position) AS lines FROM lines GROUP BY section",
           "lines"))
def message_lines(spark, sf_dir):
    return join_lines(report.report_lines(inputs.report(spark, sf_dir)))


@query(sql("""SELECT name, platform, n, six(avg_online) AS avg_online,
                     six(margin_of_error) AS margin_of_error FROM stats""", "stats"))
def baseline_from_daily(spark, sf_dir):
    observations, channels = inputs.observations(spark, sf_dir), inputs.channels(spark, sf_dir)
    path = new_path(spark, "daily")
    baseline.daily_moments(observations).write.partitionBy("day").parquet(path)
    daily = read_table(spark, path, DAILY)
    stats = baseline.baseline_from_daily(daily, observations, channels, AS_OF)
    columns = ["name", "platform", "n", "avg_online", "margin_of_error"]
    return rounded(stats.select(*columns), "avg_online", "margin_of_error")
