"""What several operators share: written intermediate tables, numbering and connected components."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.storage import new_path, remove


class Scratch:
    """Intermediate tables in the session's shared folder.

    A written table cuts the lineage and survives lost executors. ``drop`` removes one that no later step reads, ``only`` all but
    those that a result reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name = spark, name
        self._tables: list[tuple[DataFrame, str]] = []
        for made in _COLLECTED:
            made.append(self)

    def keep(self, df: DataFrame) -> DataFrame:
        path = new_path(self.spark, self.name)
        df.write.parquet(path)
        kept = self.spark.read.schema(df.schema).parquet(path)
        self._tables.append((kept, path))
        return kept

    def drop(self, *dropped: DataFrame) -> None:
        for kept, path in list(self._tables):
            if any(kept is df for df in dropped):
                remove(self.spark, path)
                self._tables.remove((kept, path))

    def only(self, *needed: DataFrame) -> None:
        self.drop(*[kept for kept, _ in self._tables if not any(kept is df for df in needed)])


_COLLECTED: list[list[Scratch]] = []


@contextmanager
def collected() -> Iterator[None]:
    """Removes at the end whatever tables operators have written within, which only results that have been written too may need."""
    made: list[Scratch] = []
    _COLLECTED.append(made)
    try:
        yield
    finally:
        _COLLECTED.pop()
        for scratch in made:
            scratch.only()


def slices(batches: Iterator, rows: int = 512) -> Iterator:
    """Arrow or pandas batches in parts of some rows, so that what a task holds of them at a time stays small."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows) if hasattr(batch, "slice") else batch.iloc[start : start + rows]


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of ``links`` (a, b) reaches.

    Large-star and small-star steps in turn: every step points the neighbours of a node at the smallest of them,
    so that paths shrink by about half each time. Minima are combined before the shuffle and joined back, so a node with very
    many links is never held in one task. Links of a node to itself give the node as its own component.
    """
    links = scratch.keep(links.select("a", "b").distinct())  # read more than once below
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).distinct()
    edges = scratch.keep(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    state = _state(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e")
        )
        after = scratch.keep(small.select("e.a", F.col("e.m").alias("b")).where("a <> b").distinct())
        scratch.drop(edges)
        before, state, edges = state, _state(after), after
        if before == state:
            break
    return nodes.join(edges.select(F.col("a").alias("node"), "b"), "node", "left").select(
        "node", F.coalesce("b", "node").alias("component")
    )


def _state(edges: DataFrame) -> tuple:
    """Count and two order-free digests of the edges: alike only if nothing changed."""
    return tuple(
        edges.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").cast("decimal(38,0)"))
        ).first()
    )
