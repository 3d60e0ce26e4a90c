"""Ranks, order and newest rows."""

from pyspark.sql import functions as F

from livegauge.operators import buckets
from livegauge.operators.lookback import calendar_lookback
from livegauge.operators.ordering import report_order, with_position
from livegauge.plans import report
from livegauge.schemas import DIFFS, REPORTS
from livegauge.sinks.tables import append_batch
from livegauge.sources.tables import read_batches
from livegauge.storage import new_path
from queries import inputs
from queries.aggregates import TEN_MINUTES
from queries.inputs import AS_OF, DAILY, sql
from queries.registry import query


@query(sql(f"""SELECT *, dense_rank() OVER (ORDER BY bucket DESC) AS bucket_rank
               FROM (SELECT *, {TEN_MINUTES} AS bucket FROM observations)""", "observations"))
def rank_buckets(spark, sf_dir):
    ranked = buckets.rank_buckets(inputs.observations(spark, sf_dir))
    return ranked.withColumn("bucket_rank", F.col("bucket_rank").cast("bigint"))


@query(sql("SELECT * FROM diffs WHERE datetime = (SELECT max(datetime) FROM diffs)", "diffs"))
def latest_batch(spark, sf_dir):
    return buckets.newest_batch(inputs.stored_diffs(spark, sf_dir)).select(*DIFFS.names)


@query(sql("""SELECT datetime, '(-100, ' || count(*) || ')' AS chat_message_id FROM diffs
              GROUP BY datetime ORDER BY datetime DESC LIMIT 1""", "diffs"))
def latest_report(spark, sf_dir):
    """Over the stored reports: one for every time of the differences, with the id its chat would have given it."""
    count = F.concat(F.lit("(-100, "), F.count("*").cast("string"), F.lit(")"))
    sent = inputs.diffs(spark, sf_dir).groupBy("datetime").agg(count.alias("chat_message_id"), F.max("name").alias("message"))
    path = new_path(spark, "reports")
    append_batch(sent, path, REPORTS, batch_id=0)
    return report.latest_report(read_batches(spark, path, REPORTS))


@query(sql("SELECT * FROM newest_cells", "newest_cells"))
def newest_two_snapshots(spark, sf_dir):
    recent = calendar_lookback(inputs.observations(spark, sf_dir), AS_OF)
    return buckets.newest_two_snapshots(recent, DAILY.bucket_minutes)


@query(sql("""SELECT *, row_number() OVER (ORDER BY platform DESC NULLS FIRST, online DESC NULLS FIRST,
                                           name, link, online_diff, datetime) AS position
              FROM diffs""", "diffs"))
def order_report(spark, sf_dir):
    return with_position(inputs.diffs(spark, sf_dir), report_order("online_diff", "datetime"))


@query(sql("""SELECT *, row_number() OVER (ORDER BY online DESC NULLS LAST, name, link) AS position
              FROM (SELECT DISTINCT name, online, link, bucket AS datetime FROM newest_cells WHERE snapshot = 1)""",
           "newest_cells"))
def order_online(spark, sf_dir):
    """The rows of one batch, as a run orders them."""
    recent = calendar_lookback(inputs.observations(spark, sf_dir), AS_OF)
    batch = buckets.newest_two_snapshots(recent, DAILY.bucket_minutes).filter("snapshot = 1")
    batch = batch.select("name", "online", "link", F.col("bucket").alias("datetime"))
    return with_position(batch, [F.desc("online"), F.asc("name"), F.asc("link")])
