"""Streaming jobs over the given events, drained and read back."""

from pyspark.sql import functions as F

from livegauge.functions.clock import as_of_column
from livegauge.schemas import DIFFS
from livegauge.sources.tables import read_batches
from livegauge.storage import new_path
from livegauge.streaming.jobs import read_cells, start_bucket_max, start_snapshot_diff
from livegauge.streaming.sources import observation_stream, stream_session
from queries import inputs
from queries.aggregates import PLATFORM, TEN_MINUTES
from queries.inputs import DAILY, sql
from queries.registry import query

# Times before which the rows of each landing lie that did not land earlier; the last takes all that is left.
LANDINGS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00", None)


def _land_and_drain(spark, sf_dir, start):
    """Land the observations in three steps of time; after each, restart the query until it has read all."""
    landing, checkpoint = new_path(spark, "landing"), new_path(spark, "stream")
    streams = stream_session(spark)
    ts, first = F.col("datetime"), None
    for last in LANDINGS:
        rows = inputs.observations(spark, sf_dir)
        if first is not None:
            rows = rows.filter(ts >= as_of_column(first))
        if last is not None:
            rows, first = rows.filter(ts < as_of_column(last)), last
        rows.write.mode("append").parquet(landing)
        start(observation_stream(streams, landing), checkpoint).awaitTermination()


@query(sql(f"""SELECT name, link, {PLATFORM} AS platform, {TEN_MINUTES} AS bucket, max(online) AS online
               FROM observations GROUP BY ALL""", "observations"))
def stream_bucket_max(spark, sf_dir):
    cells = new_path(spark, "cells")
    _land_and_drain(
        spark, sf_dir, lambda stream, checkpoint: start_bucket_max(stream, cells, checkpoint, drain=True)
    )
    return read_cells(spark, cells)


@query(sql("""SELECT c.name, c.online, coalesce(c.online - p.online, 0) AS online_diff, c.link, c.platform,
                     c.as_of AS datetime
              FROM (SELECT * FROM landed_cells WHERE r = 1) c
              LEFT JOIN (SELECT * FROM landed_cells WHERE r = 2) p ON c.landing = p.landing AND c.link = p.link""",
           "landed_cells"))
def stream_snapshot_diff(spark, sf_dir):
    observations, diffs = new_path(spark, "observations"), new_path(spark, "diffs")
    _land_and_drain(
        spark,
        sf_dir,
        lambda stream, checkpoint: start_snapshot_diff(
            stream, observations, diffs, checkpoint, DAILY, drain=True
        ),
    )
    return read_batches(spark, diffs, DIFFS).select(*DIFFS.names)
