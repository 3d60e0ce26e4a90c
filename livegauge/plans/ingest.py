"""Observation jobs of the two platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.functions.clock import AsOf
from livegauge.operators.channels import join_login, twitch_channels, youtube_channels
from livegauge.operators.extract import (
    as_observations,
    drop_missing,
    page_fields,
    positive,
    reply_counts,
    stamp_batch,
)
from livegauge.schemas import REJECTS
from livegauge.settings import PAGE_PATTERNS, PagePatterns


def youtube_observations(
    channels: DataFrame, pages: DataFrame, as_of: AsOf, patterns: PagePatterns = PAGE_PATTERNS
) -> DataFrame:
    """Observations of active youtube channels from their landed live pages.

    Pages shrink to four small columns before the join, so page text is never shuffled.
    """
    listed = youtube_channels(channels).select(
        F.col("name").alias("channel"), F.concat("link", F.lit("/live")).alias("url")
    )
    found = drop_missing(page_fields(pages, patterns)).join(listed, "url")
    return as_observations(stamp_batch(found.withColumn("name", F.col("channel")), as_of))


def page_outcomes(channels: DataFrame, fields: DataFrame, as_of: AsOf) -> DataFrame:
    """What became of every live page (``extract.page_fields``): the columns of observations and rejects, with a reason where the page gave no observation.

    A page of several channels has a row for each, as in :func:`youtube_observations`; any other live page has one.
    """
    listed = youtube_channels(channels).select(
        F.col("name").alias("channel"), F.concat("link", F.lit("/live")).alias("url")
    )
    # The marker tells a page of no channel from that of a channel without a name.
    joined = fields.join(listed.withColumn("listed", F.lit(True)), "url", "left")
    reason = F.when(F.col("link").isNull(), "no link").when(F.col("online").isNull(), "no count")
    return stamp_batch(joined.withColumn("reason", reason.when(F.col("listed").isNull(), "no channel")), as_of)


def accepted(outcomes: DataFrame) -> DataFrame:
    """The observations among the outcomes."""
    return as_observations(outcomes.filter(F.col("reason").isNull()).withColumn("name", F.col("channel")))


def rejected(outcomes: DataFrame) -> DataFrame:
    """The live pages that gave no observation, one row each, and why."""
    return outcomes.filter(F.col("reason").isNotNull()).select(*REJECTS.names)


def observations_from_json(
    replies: DataFrame, channels: DataFrame, as_of: AsOf, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Observations of twitch channels from their landed API replies; offline and failed ones count 0 and drop. ``as_of`` may be
    an expression over carried columns of the replies."""
    counts = positive(reply_counts(replies, carried))
    return as_observations(stamp_batch(join_login(counts, twitch_channels(channels)), as_of))


def union_platforms(*observations: DataFrame) -> DataFrame:
    """All rows of several batches, matched by column name."""
    first, *rest = observations
    for other in rest:
        first = first.unionByName(other)
    return first
