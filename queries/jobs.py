"""The jobs as a whole."""

from pyspark.sql import functions as F

from livegauge.plans import backfill, baseline, report, snapshot
from livegauge.schemas import BACKFILL, OBSERVATIONS
from livegauge.sinks.tables import append_batch
from livegauge.sources.tables import read_batches
from livegauge.storage import new_path
from queries import inputs
from queries.inputs import AS_OF, DAILY, rounded, sql
from queries.registry import query


@query(sql("""SELECT c.name, c.online, coalesce(c.online - p.online, 0) AS online_diff, c.link, c.platform,
                     TIMESTAMP '2024-01-31' AS datetime, c.bucket
              FROM (SELECT * FROM newest_cells WHERE snapshot = 1) c
              LEFT JOIN (SELECT * FROM newest_cells WHERE snapshot = 2) p ON c.link = p.link""",
           "newest_cells"))
def snapshot_diff(spark, sf_dir):
    return snapshot.snapshot_diff(inputs.observations(spark, sf_dir), AS_OF, DAILY)


@query(sql("SELECT *, datetime - INTERVAL 1 DAY AS bucket FROM diffs", "diffs"))
def diff_backfill(spark, sf_dir):
    return inputs.backfill(spark, sf_dir)


@query(sql("SELECT *, datetime - INTERVAL 1 DAY AS bucket FROM diffs", "diffs"))
def refreshed_backfill(spark, sf_dir):
    """A tenth of the rows, and two whole days, arrive late; only the dates they can change are computed again."""
    observations, path, stored = inputs.observations(spark, sf_dir), new_path(spark, "observations"), new_path(spark, "backfill")
    ts = F.col("datetime")
    late = (F.pmod(F.xxhash64("name", "link", ts), F.lit(10)) == 3) & (F.day(ts) % 6 == 2) | F.day(ts).isin(11, 17)
    append_batch(observations.filter(~late), path, OBSERVATIONS, 0)
    backfill.refresh_backfill(spark, path, stored, settings=DAILY)
    append_batch(observations.filter(late), path, OBSERVATIONS, 1)
    backfill.refresh_backfill(spark, path, stored, [1], DAILY)
    return read_batches(spark, stored, BACKFILL).select(*BACKFILL.names)


@query(sql("""SELECT name, platform, n, six(avg_online) AS avg_online,
                     six(stddev_online) AS stddev_online, six(margin_of_error) AS margin_of_error,
                     six(ci_lower_bound) AS ci_lower_bound, six(ci_upper_bound) AS ci_upper_bound
              FROM stats""", "stats"))
def baseline_stats(spark, sf_dir):
    stats = inputs.stats(spark, sf_dir)
    return rounded(
        stats, "avg_online", "stddev_online", "margin_of_error", "ci_lower_bound", "ci_upper_bound"
    )


@query(sql("SELECT * FROM verdict", "verdict"))
def baseline_verdict(spark, sf_dir):
    verdict = inputs.verdict(spark, sf_dir)
    return rounded(
        verdict, "avg_online", "rate_online", "margin_of_error", "ci_lower_bound", "ci_upper_bound"
    )


@query(sql("SELECT * FROM report", "report"))
def graded_report(spark, sf_dir):
    return inputs.report(spark, sf_dir)


@query(sql("SELECT datetime, message FROM message", "message"))
def report_message(spark, sf_dir):
    diffs = inputs.stored_diffs(spark, sf_dir)
    return report.report_message(inputs.report(spark, sf_dir, diffs), diffs, AS_OF)


@query(sql("""SELECT name, online, ci_lower_bound, ci_upper_bound,
                     CASE WHEN online > ci_upper_bound THEN 'above' WHEN online < ci_lower_bound THEN 'below'
                          WHEN ci_upper_bound IS NOT NULL THEN 'inside' END AS ci_position
              FROM verdict""", "verdict"))
def ci_position(spark, sf_dir):
    placed = baseline.ci_position(inputs.verdict(spark, sf_dir))
    columns = ["name", "online", "ci_lower_bound", "ci_upper_bound", "ci_position"]
    return rounded(placed.select(*columns), "ci_lower_bound", "ci_upper_bound")
