"""From landed payloads to counts. Map-only: page text never enters a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.functions.clock import AsOf, as_of_column
from livegauge.functions.payload import (
    canonical_link,
    is_live,
    last_count_token,
    parse_count,
    reply_count,
    watch_link,
)
from livegauge.schemas import OBSERVATIONS
from livegauge.settings import PAGE_PATTERNS, PagePatterns


def live_pages(pages: DataFrame, patterns: PagePatterns = PAGE_PATTERNS) -> DataFrame:
    return pages.filter(is_live(F.col("html"), patterns.live_marker))


def page_counts(pages: DataFrame, patterns: PagePatterns = PAGE_PATTERNS) -> DataFrame:
    """Name, url and count of every live page; its markup is not searched."""
    fields = F.struct(F.col("name"), F.col("url"), last_count_token(F.col("html"), patterns).alias("count_text"))
    counted = live_pages(pages, patterns).select(F.inline(F.array(fields)))
    return counted.withColumn("online", parse_count(F.col("count_text")))


def page_fields(pages: DataFrame, patterns: PagePatterns = PAGE_PATTERNS, carried: tuple[str, ...] = ()) -> DataFrame:
    """Name, url, link and count of every live page, and any carried columns; link or count is NULL where the page lacks it."""
    html = F.col("html")
    fields = F.struct(
        F.col("name"),
        F.col("url"),
        canonical_link(watch_link(html, patterns.watch_url), patterns).alias("link"),
        last_count_token(html, patterns).alias("count_text"),
        *carried,
    )
    # The one-element inline keeps later filters above it, so the text is searched once per page and not
    # once more for every condition on the result.
    return (
        live_pages(pages, patterns)
        .select(F.inline(F.array(fields)))
        .withColumn("online", parse_count(F.col("count_text")))
    )


def is_complete():
    return F.col("online").isNotNull() & F.col("link").isNotNull()


def drop_missing(fields: DataFrame) -> DataFrame:
    """Pages that gave both a link and a count."""
    return fields.filter(is_complete())


def rejected_pages(pages: DataFrame, patterns: PagePatterns = PAGE_PATTERNS) -> DataFrame:
    """Live pages without a link or a readable count, with the count text that was found, for inspection."""
    return page_fields(pages, patterns).filter(~is_complete())


def stamp_batch(df: DataFrame, as_of: AsOf) -> DataFrame:
    """The same time on every row of a batch."""
    return df.withColumn("datetime", as_of_column(as_of))


def as_observations(df: DataFrame) -> DataFrame:
    return df.select(*OBSERVATIONS.names)


def observations_from_pages(
    pages: DataFrame, as_of: AsOf, patterns: PagePatterns = PAGE_PATTERNS
) -> DataFrame:
    """Observations of the live pages; other pages give no row."""
    return as_observations(stamp_batch(drop_missing(page_fields(pages, patterns)), as_of))


def reply_counts(replies: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Login and count of every reply, and any carried columns. As for pages, the inline keeps filters on the count above it, so that a
    reply is parsed once."""
    counted = F.struct(F.col("login"), reply_count(F.col("body")).alias("online"), *carried)
    return replies.select(F.inline(F.array(counted)))


def positive(counts: DataFrame) -> DataFrame:
    return counts.filter(F.col("online") > 0)
