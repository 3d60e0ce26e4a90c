"""Projections, filters and predicates."""

from livegauge.operators import channels as dimension
from livegauge.operators import extract, lookback, rates
from livegauge.plans.report import report_rows
from queries import inputs
from queries.inputs import AS_OF, sql
from queries.registry import query


@query(sql("SELECT * FROM channels WHERE platform = 'youtube'", "channels"))
def filter_platform(spark, sf_dir):
    return dimension.on_platform(inputs.channels(spark, sf_dir), "youtube")


@query(sql("SELECT * REPLACE (coalesce(big_stream, 'no') AS big_stream) FROM channels", "channels"))
def fill_default(spark, sf_dir):
    return dimension.fill_flag(inputs.channels(spark, sf_dir))


@query(sql("SELECT * FROM channels WHERE actual = 'yes'", "channels"))
def filter_active(spark, sf_dir):
    return dimension.active(inputs.channels(spark, sf_dir))


@query(sql("""SELECT name, link, coalesce(big_stream, 'no') AS big_stream FROM channels
              WHERE platform = 'youtube' AND actual = 'yes'""", "channels"))
def project_columns(spark, sf_dir):
    return dimension.youtube_channels(inputs.channels(spark, sf_dir))


@query(sql("SELECT login, online FROM counts WHERE online > 0", "counts"))
def filter_positive(spark, sf_dir):
    return extract.positive(extract.reply_counts(inputs.replies(spark, sf_dir)))


@query(sql("""SELECT * FROM observations WHERE datetime <= TIMESTAMP '2024-01-31'
              AND CAST(datetime AS DATE) >= DATE '2024-01-31' - INTERVAL 2 DAY""", "observations"))
def calendar_lookback(spark, sf_dir):
    return lookback.calendar_lookback(inputs.observations(spark, sf_dir), AS_OF)


@query(sql("""SELECT * FROM observations WHERE datetime <= TIMESTAMP '2024-01-31'
              AND datetime >= TIMESTAMP '2024-01-31' - INTERVAL 15 DAY""", "observations"))
def rolling_lookback(spark, sf_dir):
    return lookback.rolling_lookback(inputs.observations(spark, sf_dir), AS_OF)


@query(sql("SELECT name, online, online_diff, link, platform FROM report_rows", "report_rows"))
def threshold_then_rank(spark, sf_dir):
    return report_rows(inputs.stored_diffs(spark, sf_dir), AS_OF)


@query(sql("""SELECT name, online, online_diff, link, platform, rate_online_ci FROM rated
              WHERE online > 15 AND rate_online_ci > -350""", "rated"))
def report_thresholds(spark, sf_dir):
    diffs = inputs.stored_diffs(spark, sf_dir)
    rated = rates.join_rates(report_rows(diffs, AS_OF), inputs.verdict(spark, sf_dir, diffs))
    return rates.report_thresholds(rated)


@query(sql("""SELECT o.*, section FROM observations o
              JOIN (VALUES ('youtube', 'youtu.be'), ('twitch', 'twitch.tv')) s(section, pattern)
                ON regexp_matches(link, pattern)""", "observations"))
def split_by_platform(spark, sf_dir):
    return rates.split_by_platform(inputs.observations(spark, sf_dir))


@query(sql("""SELECT *, CASE WHEN link LIKE '%youtu%' THEN 'youtube'
                             WHEN link LIKE '%twitch%' THEN 'twitch' END AS platform
              FROM observations""", "observations"))
def derive_platform(spark, sf_dir):
    return dimension.with_platform(inputs.observations(spark, sf_dir))


@query(sql("SELECT login, online, TIMESTAMP '2024-01-31' AS datetime FROM counts", "counts"))
def batch_stamp(spark, sf_dir):
    return extract.stamp_batch(extract.reply_counts(inputs.replies(spark, sf_dir)), AS_OF)
