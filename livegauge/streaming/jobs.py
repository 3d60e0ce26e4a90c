"""Streaming queries. One query keeps one batch active at a time, as the ten-minute job does."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from livegauge.batches import live, newest_day, vacuum
from livegauge.functions.clock import bucket_start, in_calendar_lookback, run_end
from livegauge.operators.buckets import bucket_max
from livegauge.operators.channels import with_platform
from livegauge.operators.extract import page_fields, stamp_batch
from livegauge.operators.rates import snapshot_join
from livegauge.plans.ingest import accepted, observations_from_json, page_outcomes, rejected
from livegauge.schemas import CELLS, CHANNELS, DIFFS, OBSERVATIONS, REJECTS, SNAPSHOTS
from livegauge.settings import DEFAULTS, Settings
from livegauge.sinks.tables import append_batch, compact
from livegauge.sources.tables import read_batches, read_table
from livegauge.storage import content, freeze, temporary

_BATCH_BITS = 28  # micro-batches of one checkpoint: at one a second, eight years


def stream_number(spark: SparkSession, checkpoint: str, batch_id: int) -> int:
    """The number under which a micro-batch is stored: that of the checkpoint, from the id Spark keeps in it, and its own.

    A repeated micro-batch has the same number and replaces itself. Another checkpoint has another id, so it replaces
    nothing; its numbers also lie above those of the periodic tasks.
    """
    known = json.loads(content(spark, f"{checkpoint}/metadata"))["id"]
    own = int.from_bytes(hashlib.sha256(known.encode()).digest()[:5]) >> 6  # 34 bits
    if batch_id >= 1 << _BATCH_BITS:
        raise ValueError("too many micro-batches for one checkpoint")
    return (own + (1 << 20)) << _BATCH_BITS | batch_id


def _start(
    stream: DataFrame, checkpoint: str, settings: Settings, drain: bool, step: Callable[[SparkSession, DataFrame, int], None]
) -> StreamingQuery:
    """Run ``step`` on every micro-batch: until all that has landed is read, or at every cadence."""
    spark = stream.sparkSession
    trigger = {"availableNow": True} if drain else {"processingTime": f"{settings.trigger_seconds} seconds"}
    return (
        stream.writeStream.foreachBatch(lambda batch, batch_id: step(spark, batch, stream_number(spark, checkpoint, batch_id)))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def start_page_ingest(
    pages: DataFrame,
    channels_path: str,
    observations_path: str,
    rejected_path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    drain: bool = False,
) -> StreamingQuery:
    """Observations and rejects of landed pages (schema LANDED_PAGES), as the periodic task makes them.

    A page is stamped with the end of the interval it landed in, whichever micro-batch takes it: what is read in all equals
    the task's runs over all intervals. Channels are read anew for every batch, and pages once: their outcomes are written aside for both tables.
    """

    def step(spark: SparkSession, batch: DataFrame, number: int) -> None:
        fields = page_fields(batch.filter(F.col("html").isNotNull()), carried=("landed",))
        outcomes = page_outcomes(read_table(spark, channels_path, CHANNELS), fields, run_end(F.col("landed"), settings.bucket_minutes))
        with temporary(spark, "outcomes") as aside:
            outcomes = freeze(outcomes, aside)
            append_batch(accepted(outcomes), observations_path, OBSERVATIONS, number)
            append_batch(rejected(outcomes), rejected_path, REJECTS, number)

    return _start(pages, checkpoint, settings, drain, step)


def start_reply_ingest(
    replies: DataFrame,
    channels_path: str,
    observations_path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    drain: bool = False,
) -> StreamingQuery:
    """Observations of landed API replies (schema LANDED_REPLIES), stamped as in :func:`start_page_ingest`."""

    def step(spark: SparkSession, batch: DataFrame, number: int) -> None:
        channels, stamp = read_table(spark, channels_path, CHANNELS), run_end(F.col("landed"), settings.bucket_minutes)
        append_batch(observations_from_json(batch, channels, stamp, ("landed",)), observations_path, OBSERVATIONS, number)

    return _start(replies, checkpoint, settings, drain, step)


def start_bucket_max(
    observations: DataFrame,
    cells_path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    drain: bool = False,
) -> StreamingQuery:
    """Write the bucket maxima of each batch's rows; :func:`read_cells` merges them.

    A maximum of maxima needs no state, so nothing has to be forgotten at a watermark: a row counts however late it is.
    """

    def step(spark: SparkSession, batch: DataFrame, number: int) -> None:
        append_batch(bucket_max(batch, settings.bucket_minutes).drop("platform"), cells_path, CELLS, number, ts="bucket")

    return _start(observations, checkpoint, settings, drain, step)


def _merged(cells: DataFrame) -> DataFrame:
    return cells.groupBy("name", "link", "bucket").agg(F.max("online").alias("online"))


def read_cells(spark: SparkSession, cells_path: str) -> DataFrame:
    """Current bucket maxima: the largest value written for each cell."""
    cells = _merged(read_batches(spark, cells_path, CELLS))
    return with_platform(cells).select("name", "link", "platform", "bucket", "online")


def compact_cells(spark: SparkSession, cells_path: str, day: date) -> None:
    """Merge what the batches of a past day wrote into one row per cell. Rows that come later still count."""
    compact(spark, cells_path, CELLS, day, ts="bucket", merge=_merged)


def start_snapshot_diff(
    observations: DataFrame,
    observations_path: str,
    diffs_path: str,
    checkpoint: str,
    settings: Settings = DEFAULTS,
    drain: bool = False,
    snapshots_path: str | None = None,
) -> StreamingQuery:
    """Append each batch to the stored observations, then difference the newest snapshot.

    The newest two snapshots are kept as a small table (by default beside the differences), replaced as a whole with each batch, so a step reads them and its own rows,
    not the look-back. Late rows of these two buckets, or of one between them, count in later differences; no late row changes
    differences already written. The stamp is the newest observation time.
    """
    snapshots_path = snapshots_path or f"{diffs_path.rstrip('/')}-snapshots"

    def cells_of(rows: DataFrame) -> DataFrame:
        bucket = bucket_start(F.col("datetime"), settings.bucket_minutes)
        cells = rows.groupBy("name", "link", bucket.alias("bucket"))
        return cells.agg(F.max("online").alias("online"), F.max("datetime").alias("newest"))

    def known(spark: SparkSession) -> DataFrame:
        """The kept snapshots; where none are kept yet, those of the look-back of the stored observations."""
        if live(spark, snapshots_path):
            return read_batches(spark, snapshots_path, SNAPSHOTS).select(*SNAPSHOTS.names)
        if (day := newest_day(spark, observations_path)) is None:
            return spark.createDataFrame([], SNAPSHOTS)
        stored = read_batches(spark, observations_path, OBSERVATIONS, day - timedelta(days=settings.lookback_days), day)
        return cells_of(stored).select(*SNAPSHOTS.names)

    def step(spark: SparkSession, batch: DataFrame, number: int) -> None:
        append_batch(batch, observations_path, OBSERVATIONS, number)
        if batch.isEmpty():
            return
        cells = known(spark).unionByName(cells_of(batch)).groupBy("name", "link", "bucket")
        cells = cells.agg(F.max("online").alias("online"), F.max("newest").alias("newest"))
        buckets = cells.select("bucket").distinct().orderBy(F.desc("bucket")).limit(2)
        append_batch(cells.join(buckets, "bucket"), snapshots_path, SNAPSHOTS, 0, ts="bucket")
        vacuum(spark, snapshots_path, hours=1)
        kept = read_batches(spark, snapshots_path, SNAPSHOTS)
        # Two times to the driver: the stamp and the newest bucket.
        as_of, newest = kept.agg(F.max("newest"), F.max("bucket")).first()
        kept = with_platform(kept).select("name", "link", "platform", "bucket", "online")
        kept = kept.filter(in_calendar_lookback(F.col("bucket"), as_of, settings.lookback_days))
        start = F.lit(newest).cast("timestamp_ntz")
        rows = snapshot_join(kept.filter(F.col("bucket") == start), kept.filter(F.col("bucket") < start))
        append_batch(stamp_batch(rows, as_of), diffs_path, DIFFS, number)

    return _start(observations, checkpoint, settings, drain, step)
