"""Order made explicit, and text joined in that order, without one task seeing all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from livegauge.storage import freeze

# Lines joined by one group of the first step; any number gives the same text.
LINES_PER_PIECE = 1000


def report_order(*ties: str) -> list[Column]:
    """Platform, then count, both descending with NULLs first; then name, link and ``ties``."""
    return [F.desc_nulls_first("platform"), F.desc_nulls_first("online")] + [
        F.asc_nulls_first(column) for column in ("name", "link", *ties)
    ]


def with_position(df: DataFrame, order: list[Column], path: str | None = None) -> DataFrame:
    """Rows with their 1-based ``position`` in ``order``.

    A range shuffle sorts the rows over all tasks. A position is the row's place within its range plus the
    sizes of the ranges before it. The sorted rows are written out first, since places taken from a shuffle that
    may run again after a lost executor are not safe to add up. A caller that removes that table later names its ``path``.
    """
    placed = freeze(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id()),
        path,
    )
    # monotonically_increasing_id: partition number above bit 33, place within the partition below.
    part = F.shiftright("_id", 33)
    place = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_size"))
        .select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    )
    # One row per shuffle partition, so always small enough to broadcast.
    return (
        placed.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn("position", F.col("_before") + place + F.lit(1))
        .drop("_id", "_part", "_before")
    )


def join_lines(lines: DataFrame, by: str = "section") -> DataFrame:
    """Lines joined by newlines in order of ``position``, one text per ``by``.

    Pieces of at most ``LINES_PER_PIECE`` lines are joined in parallel, then the pieces.
    """
    piece = F.floor(F.col("position") / F.lit(LINES_PER_PIECE)).alias("_piece")
    in_pieces = lines.groupBy(by, piece).agg(
        F.expr("listagg(line, '\n') WITHIN GROUP (ORDER BY position)").alias("_text")
    )
    return in_pieces.groupBy(by).agg(
        F.expr("listagg(_text, '\n') WITHIN GROUP (ORDER BY _piece)").alias("lines")
    )
