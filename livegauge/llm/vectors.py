"""Near-duplicate vectors by a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. An inverted list holds, for each label and pivot, the vectors
that have the pivot among their nearest. Two vectors of a list that share enough pivots, this one and others, are candidates, and only for
candidates is the cosine taken, in double precision; those that reach the threshold are linked. With the defaults a pair at a cosine of
0.93 in 64 dimensions is a candidate with probability above 0.998.

The number of pivots grows with the root of the largest label, and so does the length of a list: so a vector meets a number of others that grows
with that root, not with the label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch, components, slices

LEAST_PIVOTS, PER_ROOT, MOST_PIVOTS = 256, 8, 1 << 14  # pivots: so many for each unit of the root of the largest label, within bounds (8 MB at 64 dimensions)
NEAREST, SHARED = 12, 2
APART = 0.8  # cosine that two pivots stay below
BLOCK = 512  # rows of one list compared in one task with as many others


def unit(vectors: list) -> np.ndarray:
    """Vectors of one dimension in double precision, scaled to length 1; the largest component first, so that no square overflows."""
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def number_of_pivots(largest: int) -> int:
    """For a label of so many vectors at most."""
    return min(MOST_PIVOTS, max(LEAST_PIVOTS, int(PER_ROOT * largest**0.5)))


def choose_pivots(sample: np.ndarray, dimension: int, pivots: int) -> np.ndarray:
    """The first vectors of the sample that lie apart, at most half of the pivots; random directions are the rest, for vectors unlike the sample."""
    chosen, n = np.zeros((pivots, dimension)), 0
    for v in sample:
        if n >= pivots // 2:
            break
        if not n or (chosen[:n] @ v).max() < APART:
            chosen[n], n = v, n + 1
    rest = np.random.default_rng(dimension).normal(size=(pivots - n, dimension))
    chosen[n:] = rest / np.linalg.norm(rest, axis=1, keepdims=True)
    return chosen


def nearest_pivots(x: np.ndarray, pivots: np.ndarray, nearest: int = NEAREST) -> np.ndarray:
    """The numbers of the nearest pivots of each row, nearest first."""
    near = x @ pivots.T
    first = np.argpartition(-near, nearest - 1, axis=1)[:, :nearest]
    order = np.argsort(-np.take_along_axis(near, first, 1), axis=1, kind="stable")
    return np.take_along_axis(first, order, 1).astype(np.int32)


def _described(known: dict[int, np.ndarray], pivots: int, nearest: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches, 1024):
            sizes = batch["vector"].map(len)
            for dimension, part in batch.groupby(sizes):
                if dimension not in known:
                    known[dimension] = choose_pivots(np.zeros((0, dimension)), dimension, pivots)
                near = nearest_pivots(unit(list(part["vector"])), known[dimension], nearest)
                yield pd.DataFrame(
                    {
                        "rep": part["rep"].to_numpy(), "size": part["size"].to_numpy(), "label": part["label"].to_numpy(),
                        "dimension": dimension, "vector": list(part["vector"]), "nearest": list(near),
                    }
                )

    return run


def candidates(a: np.ndarray, b: np.ndarray, pivot: int, shared: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of rows of ``a`` and ``b`` (nearest pivots) that share ``shared`` pivots, ``pivot`` among them, which all have. Counted by the lists that the rows
    form for each other pivot, so a pair that shares none costs nothing. With ``same`` each pair once."""
    count = np.ones((len(a), len(b)), np.uint8)

    def by_pivot(near: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        order = np.argsort(near, axis=None, kind="stable")
        names, starts = np.unique(near.ravel()[order], return_index=True)
        return names, np.split(order // near.shape[1], starts[1:])

    names_a, rows_a = by_pivot(a)
    names_b, rows_b = (names_a, rows_a) if same else by_pivot(b)
    both, at_a, at_b = np.intersect1d(names_a, names_b, assume_unique=True, return_indices=True)
    for name, i, j in zip(both, at_a, at_b, strict=True):
        if name != pivot and not (same and len(rows_a[i]) == 1):
            count[rows_a[i][:, None], rows_b[j]] += 1
    found = count >= shared
    return np.nonzero(np.triu(found, 1) if same else found)


def first_shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest pivot that rows of a and b, pair by pair, share."""
    both = (a[:, :, None] == b[:, None, :]).any(2)
    return np.where(both, a, np.iinfo(np.int32).max).min(1)


def _compare(threshold: float, shared: int):
    """Links between two blocks of one inverted list.

    Returns, for every row that has a link here, how many vectors it links to by links counted here (those whose smallest shared
    pivot is this list's), and one row it is connected with, so that the output is no longer than the input.
    """

    def run(group: pd.DataFrame) -> pd.DataFrame:
        pivot, i, j = (int(group[c].iloc[0]) for c in ("pivot", "i", "j"))
        group = group.sort_values("rep")
        left, right = group[group["block"] == i], group[group["block"] == j]
        a, b = (np.stack(side["nearest"].to_list()) if len(side) else np.zeros((0, 1), np.int32) for side in (left, right))
        p, q = candidates(a, b, pivot, shared, i == j)
        if len(p):
            x = unit(list(left["vector"]))
            y = x if i == j else unit(list(right["vector"]))
            near = np.concatenate([np.einsum("ij,ij->i", x[s], y[t]) for s, t in _parts(p, q)]) >= threshold
            p, q = p[near], q[near]
        if not len(p):
            return pd.DataFrame({"rep": left["rep"].iloc[:0], "links": [], "mate": left["rep"].iloc[:0]})
        first = np.concatenate([first_shared(a[s], b[t]) for s, t in _parts(p, q)])
        own = first == pivot
        ids = np.concatenate([left["rep"], right["rep"]]) if i != j else left["rep"].to_numpy()
        sizes = np.concatenate([left["size"], right["size"]]) if i != j else left["size"].to_numpy()
        q = q + len(left) if i != j else q
        links = np.bincount(p[own], sizes[q[own]], len(ids)) + np.bincount(q[own], sizes[p[own]], len(ids))
        root = np.arange(len(ids))
        while True:  # the smallest row that each reaches within the block pair
            low = root.copy()
            np.minimum.at(low, p, root[q])
            np.minimum.at(low, q, root[p])
            low = low[low]
            if (low == root).all():
                break
            root = low
        used = np.zeros(len(ids), bool)
        used[p] = used[q] = True
        return pd.DataFrame({"rep": ids[used], "links": links[used].astype(np.int64), "mate": ids[root[used]]})

    return run


def _parts(p: np.ndarray, q: np.ndarray, rows: int = 1 << 14) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for start in range(0, len(p), rows):
        yield p[start : start + rows], q[start : start + rows]


def near_vectors(
    vectors: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
    pivots: int | None = None, nearest: int = NEAREST, shared: int = SHARED,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Vectors of equal, non-null label and equal dimension link at a cosine of ``threshold`` or more. Vectors that are null, empty, zero or
    hold a null or non-finite component, and rows with a null id, link with nothing. n_links counts the other ids linked
    directly; equal vectors link too. The smallest id of a component is kept; a null id has a null component and is kept. Rows that repeat an id are
    one vector; with differing vectors they share their links. Other columns are not read.

    Equal vectors become one representative with a count. A long inverted list is split into blocks, and every pair of blocks is a
    task of its own, so that no list need fit in one.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "vectors")
    vector = F.col(vector_col)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), vector.alias("vector"))
    finite = "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists(vector, x -> x <> 0)"
    usable = F.coalesce(F.expr(f"id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND {finite}"), F.lit(False))
    rows = rows.withColumn("usable", usable)
    used = rows.where("usable").select("id", "label", "vector").distinct()
    classes = scratch.keep(used.groupBy("label", "vector").agg(F.min("id").alias("rep"), F.count("*").alias("size")))

    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    pivots = pivots or number_of_pivots(largest)
    picked = classes.orderBy(F.xxhash64("rep"), "rep").limit(pivots).select("vector").toPandas()
    known = {}
    for dimension, part in picked.groupby(picked["vector"].map(len)) if len(picked) else ():
        known[int(dimension)] = choose_pivots(unit(list(part["vector"])), int(dimension), pivots)
    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    described = scratch.keep(
        classes.mapInPandas(
            _described(known, pivots, nearest),
            f"rep {kinds['rep']}, size long, label {kinds['label']}, dimension int, vector {kinds['vector']}, nearest array<int>",
        )
    )
    lists = described.withColumn("pivot", F.explode("nearest"))
    lengths = described.select("label", "dimension", F.explode("nearest").alias("pivot")).groupBy("label", "dimension", "pivot").count()
    lengths = lengths.where("count > 1").withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int")).drop("count")
    blocks = lists.join(lengths, ["label", "dimension", "pivot"])
    blocks = blocks.withColumn("block", F.pmod(F.xxhash64("rep", "pivot"), "blocks").cast("int"))
    blocks = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    blocks = blocks.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    found = blocks.groupBy("label", "dimension", "pivot", "i", "j").applyInPandas(
        _compare(threshold, shared), f"rep {kinds['rep']}, links long, mate {kinds['rep']}"
    )
    found = scratch.keep(found)
    degree = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(scratch, found.select(F.col("rep").alias("a"), F.col("mate").alias("b")))
    totals = classes.groupBy("rep").agg(F.max("size").alias("size")).join(degree, "rep", "left")
    totals = totals.join(joined.withColumnRenamed("node", "rep"), "rep", "left")
    totals = totals.select(
        F.col("rep").alias("r"), (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
        F.coalesce("component", "rep").alias("component"),
    )
    member = used.join(classes.select("label", "vector", "rep"), ["label", "vector"]).groupBy("id").agg(F.min("rep").alias("rep"))
    of = member.join(totals, member["rep"] == totals["r"]).select(F.col("id").alias("member"), "links", "component")
    out = rows.join(of, F.col("usable") & (F.col("id") == F.col("member")), "left")
    component = F.coalesce("component", "id")
    out = out.select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
    out = scratch.keep(out)
    scratch.only(out)
    return out
