"""Sinks, read back."""

from pyspark.sql import functions as F

from livegauge.plans.report import report_message
from livegauge.schemas import DIFFS, REPORTS
from livegauge.sinks.tables import append_batch, log_report, log_sent
from livegauge.sources.tables import read_batches
from livegauge.storage import new_path
from queries import inputs
from queries.inputs import AS_OF, sql
from queries.registry import query


@query(sql("""SELECT nullif(name, '') AS name, online, online_diff, link, platform, datetime FROM diffs""",
           "diffs"))
def append_roundtrip(spark, sf_dir):
    path = new_path(spark, "diffs")
    # A first attempt with other dates too; the retry leaves nothing of it.
    other = F.col("datetime") - F.make_dt_interval(days=F.lit(400))
    rows = inputs.diffs(spark, sf_dir)
    append_batch(rows.union(rows.withColumn("datetime", other)), path, DIFFS, batch_id=0)
    append_batch(rows, path, DIFFS, batch_id=0)
    return read_batches(spark, path, DIFFS).select(*DIFFS.names)


@query(sql("SELECT datetime, '(-100, 1)' AS chat_message_id, message FROM message", "message"))
def report_log(spark, sf_dir):
    path, diffs = new_path(spark, "reports"), inputs.stored_diffs(spark, sf_dir)
    message = report_message(inputs.report(spark, sf_dir, diffs), diffs, AS_OF)
    log_report(message, path, AS_OF, batch_id=0)
    log_sent(spark, path, "(-100, 1)", AS_OF, batch_id=0)
    return read_batches(spark, path, REPORTS).select(*REPORTS.names)
