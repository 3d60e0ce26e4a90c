"""Shards of nearly equal bytes by a minimax contiguous partition.

Texts that are equal form one atomic group; groups are ordered by their smallest id. The smallest capacity is searched for which
cutting greedily, always as late as the capacity allows, needs no more shards than wanted; the cuts of that capacity are the result. No
contiguous partition of these groups has a smaller largest shard.

The groups and their running sizes stay in a table. A greedy step asks it for the last group end at or below
a threshold, for many capacities in one pass that reads only the range partitions concerned. The driver holds
the cuts of those capacities and one offset per range partition.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch
from livegauge.operators.ordering import with_position

TRIED_AT_ONCE = 512


class _Ends:
    """The ends of the ordered groups, looked up by threshold."""

    def __init__(self, ends: DataFrame):
        self.ends = ends
        parts = ends.groupBy("part").agg(F.max("end").alias("end")).orderBy("end").collect()
        self.parts = [row["part"] for row in parts]
        self.stops = [row["end"] for row in parts]
        self.total = self.stops[-1] if parts else 0

    def last(self, wanted: list[int]) -> list[int]:
        """For each threshold the largest end that does not exceed it; 0 if there is none."""
        at = [bisect_right(self.stops, t) for t in wanted]  # range partitions that end at or below it
        known = [self.stops[i - 1] if i else 0 for i in at]
        asked = sorted({(i, t) for i, t in zip(at, wanted, strict=True) if i < len(self.parts)})
        if not asked:
            return known
        hit = self.ends.where(F.col("part").isin(sorted({self.parts[i] for i, _ in asked})))
        # One row per threshold; a table rather than literals, so that every pass runs the same compiled code.
        values = ", ".join(f"({self.parts[i]}L, {t}L)" for i, t in asked)
        thresholds = self.ends.sparkSession.sql(f"SELECT * FROM VALUES {values} AS v(part, threshold)")
        found = hit.join(F.broadcast(thresholds), "part").where("end <= threshold AND threshold < next").collect()
        inside = {(row["part"], row["threshold"]): row["end"] for row in found}
        return [
            max(k, inside.get((self.parts[i], t), 0) if i < len(self.parts) else 0)
            for k, i, t in zip(known, at, wanted, strict=True)
        ]


def _greedy(ends: _Ends, capacities: list[int], shards: int) -> list[list[int] | None]:
    """The cuts that each capacity leads to, or None where it needs more shards."""
    cuts = {c: [0] for c in capacities}
    for _ in range(shards - 1):
        going = [c for c in capacities if cuts[c][-1] + c < ends.total]
        if not going:
            break
        for c, end in zip(going, ends.last([cuts[c][-1] + c for c in going]), strict=True):
            cuts[c].append(end)
    return [cuts[c][1:] if ends.total - cuts[c][-1] <= c else None for c in capacities]


def smallest_capacity(ends: DataFrame, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest feasible capacity and its cuts, for a table of group ends (part, end, next:
    the end after it in the part).

    The search halves the range in several steps at once: first over capacities at doubling distances from the lower bound, where the answer
    usually lies, then over evenly spaced ones, all tried in the same passes.
    """
    table = _Ends(ends)
    share = -(-table.total // shards)
    low, high = max(share, largest), max(share, largest) + largest  # high is always feasible
    tried = [low + (1 << k) - 1 for k in range(largest.bit_length() + 1)]
    best = None
    while True:
        tried = sorted({c for c in tried if low <= c <= high} | {high})
        for c, cuts in zip(tried, _greedy(table, tried, shards), strict=True):
            if cuts is not None:
                high, best = c, cuts
                break
            low = c + 1
        if low >= high:
            return high, best
        step = max(1, -(-(high - low) // TRIED_AT_ONCE))
        tried = list(range(low, high, step))


def byte_shards(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = 16) -> DataFrame:
    """One row per input row: id, size, text_crc32, law, shard, slot, grown_shard.

    size: UTF-8 bytes of the text, none for null, plus 1. Equal texts share a shard; null texts are one group, empty texts another.
    Shards follow the order of the groups' smallest ids (null ids first); slots within a shard follow group, id and, among
    rows that repeat an id, an arbitrary order. text_crc32 of a null text is 0, as of an empty one. An empty
    table gives no rows. Other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "shards")
    text = F.col(text_col)
    rows = scratch.keep(
        documents.select(
            F.col(id_col).alias("id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)).cast("long").alias("size"),
            F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
            F.unhex(F.sha2(text, 256)).alias("key"),
        )
    )
    groups = rows.groupBy("key").agg(F.min("id").alias("first"), F.sum("size").alias("bytes"))
    ordered = scratch.keep(
        groups.repartitionByRange("first", "key").sortWithinPartitions("first", "key")
        .withColumn("place", F.monotonically_increasing_id()).withColumn("part", F.shiftright("place", 33))
    )
    # One row per range partition.
    sums = ordered.groupBy("part").agg(F.sum("bytes").alias("sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before"))
    running = F.sum("bytes").over(Window.partitionBy("part").orderBy("place"))
    ends = ordered.withColumn("running", running).join(F.broadcast(offsets), "part")
    ends = ends.select("key", "bytes", "part", "place", (F.col("before") + F.col("running")).alias("end"))
    following = F.lead("end").over(Window.partitionBy("part").orderBy("place"))
    ends = scratch.keep(ends.select("key", "bytes", "part", "end", following.alias("next")))

    largest = ends.agg(F.max("bytes")).first()[0] or 0
    cuts = smallest_capacity(ends.select("part", "end", "next"), largest, shards)[1] if largest else []
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("end") > F.lit(cut)).cast("int")
    lines = rows.withColumn("line", F.monotonically_increasing_id())
    placed = lines.join(ends.select(F.col("key").alias("k"), "end"), F.col("key").eqNullSafe(F.col("k")))
    placed = placed.select("id", "size", "text_crc32", "end", "line", shard.alias("shard"))
    placed = with_position(placed, [F.col(c).asc_nulls_first() for c in ("end", "id", "line")])
    scratch.only()  # the positions are a written table of their own
    first = placed.groupBy("shard").agg(F.min("position").alias("start"))  # one row per shard
    return placed.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("position") - F.col("start")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
