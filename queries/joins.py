"""Joins."""

from pyspark.sql import functions as F

from livegauge.operators import channels as dimension
from livegauge.operators import extract, rates
from livegauge.operators.buckets import newest_two_snapshots
from livegauge.operators.lookback import calendar_lookback
from livegauge.plans.baseline import live_counts
from livegauge.plans.report import report_rows
from queries import inputs
from queries.inputs import AS_OF, DAILY, rounded, sql
from queries.registry import query


@query(sql("""SELECT r.login, r.online, c.name, c.link
              FROM counts r LEFT JOIN (SELECT * FROM channels WHERE platform = 'twitch') c
                ON r.login = c.big_stream""", "counts", "channels"))
def join_login(spark, sf_dir):
    counts = extract.reply_counts(inputs.replies(spark, sf_dir))
    return dimension.join_login(counts, dimension.twitch_channels(inputs.channels(spark, sf_dir)))


@query(sql("""SELECT c.name, c.link, c.platform, c.bucket, c.online, p.online AS previous_online,
                     coalesce(c.online - p.online, 0) AS online_diff
              FROM (SELECT * FROM newest_cells WHERE snapshot = 1) c
              LEFT JOIN (SELECT * FROM newest_cells WHERE snapshot = 2) p ON c.link = p.link""",
           "newest_cells"))
def snapshot_join(spark, sf_dir):
    recent = calendar_lookback(inputs.observations(spark, sf_dir), AS_OF)
    cells = newest_two_snapshots(recent, DAILY.bucket_minutes)
    current = cells.filter(F.col("snapshot") == 1).drop("snapshot")
    return rates.snapshot_join(current, cells.filter(F.col("snapshot") == 2))


@query(sql("""SELECT o.*, c.platform, c.link AS channel_link
              FROM observations o LEFT JOIN channels c ON o.name = c.name""", "observations", "channels"))
def join_channel_history(spark, sf_dir):
    return dimension.join_channel_history(inputs.observations(spark, sf_dir), inputs.channels(spark, sf_dir))


@query(sql("SELECT DISTINCT name, online FROM last_online", "last_online"))
def redundant_join_equiv(spark, sf_dir):
    return live_counts(inputs.stored_diffs(spark, sf_dir), AS_OF)


@query(sql("""SELECT l.name, l.online, s.platform, s.n, six(s.avg_online) AS avg_online,
                     six(s.ci_upper_bound) AS ci_upper_bound
              FROM (SELECT DISTINCT name, online FROM last_online) l LEFT JOIN stats s ON l.name = s.name""",
           "last_online", "stats"))
def join_baseline(spark, sf_dir):
    live = live_counts(inputs.stored_diffs(spark, sf_dir), AS_OF)
    joined = rates.join_baseline(live, inputs.stats(spark, sf_dir))
    columns = ["name", "online", "platform", "n", "avg_online", "ci_upper_bound"]
    return rounded(joined.select(*columns), "avg_online", "ci_upper_bound")


@query(sql("SELECT * FROM rated", "rated"))
def join_rates(spark, sf_dir):
    diffs = inputs.stored_diffs(spark, sf_dir)
    return rates.join_rates(report_rows(diffs, AS_OF), inputs.verdict(spark, sf_dir, diffs))


@query(sql("""SELECT r.*, coalesce(v.rate_online_ci, -500) AS rate_online_ci
              FROM report_rows r LEFT JOIN (SELECT DISTINCT name, online, rate_online_ci FROM verdict) v
                ON r.name IS NOT DISTINCT FROM v.name AND r.online IS NOT DISTINCT FROM v.online""",
           "report_rows", "verdict"))
def join_rates_by_value(spark, sf_dir):
    diffs = inputs.stored_diffs(spark, sf_dir)
    return rates.join_rates_by_value(report_rows(diffs, AS_OF), inputs.verdict(spark, sf_dir, diffs))
