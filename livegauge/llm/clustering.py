"""K-means over integer vectors, exact, with bounds that spare most distances.

A vector keeps an upper bound of the distance to its own centroid and a lower one of the distance to all others. While the upper is below the lower
it stays where it is and nothing is computed for it. When centroids move, the upper bound grows by its own centroid's drift. The lower bound
would have to shrink by the largest drift of all others; planar geometry spares most of that. The vectors of a cluster lie in a sphere around its
centroid. Seen in the plane through that centre and the old and new place of another centroid, the points whose distance to the latter shrinks by more than a
given amount lie beyond a branch of a hyperbola, thus beyond its asymptotes. The smallest amount whose asymptote leaves the sphere on the near side bounds
what any vector of the cluster can lose. Vectors whose bounds meet are ambiguous: their own distance is computed, and all others if that does not decide.

Distances, sums and centroids are whole numbers; bounds are doubles with a margin for rounding, so they decide which distances are computed, never the
result. The vectors and their bounds are one table, written once a round; sums change by the vectors that moved. The driver holds k
centroids, k sums and k radii.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from math import inf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch, slices

LARGEST = 1 << 27  # components of vectors: 64 squared differences of that size still fit in 64 bits
MARGIN = 1e-9  # share by which rounding may move a bound


def asymptote_drift(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """An upper bound of ``|x - old| - |x - new|`` over all x within ``radius`` of ``centre``: at least 0, at most ``|old - new|``.

    In the plane through the three points, with the foci ``old`` and ``new`` at (0, -1) and (0, 1), the difference is 2a on the branch
    y = a * sqrt(1 + x*x / (1 - a*a)), which lies above its asymptote of slope angle t, a = sin(t). A sphere at (p, q) of radius r
    lies below that line if p * sin(t) - q * cos(t) >= r, so the smallest such t is atan2(q, p) + asin(r / R), R the distance
    of the centre from the middle.
    """
    axis = new - old
    drift = sqrt(axis @ axis)
    if drift == 0:
        return 0.0
    half = drift / 2
    offset = centre - (old + new) / 2
    q = float(offset @ axis) / drift
    p = sqrt(max(0.0, float(offset @ offset) - q * q))
    p, q, r = p / half, q / half, radius * (1 + MARGIN) / half
    if r <= -q:  # wholly nearer to the old place: no distance shrinks
        return 0.0
    square = p * p + q * q
    if square <= r * r:
        return drift
    rest = sqrt(square - r * r)
    cosine = (p * rest - q * r) / square
    return drift if cosine <= 0 else drift * min(1.0, max(0.0, (q * rest + p * r) / square) + MARGIN)


def loosening(old: np.ndarray, new: np.ndarray, radii: list[float | None]) -> list[float]:
    """For each cluster, by how much the lower bounds of its vectors shrink: the largest bound over all other centroids."""
    old, new = old.astype(np.float64), new.astype(np.float64)
    k = len(old)
    return [
        0.0 if radii[i] is None else max((asymptote_drift(old[i], radii[i], old[j], new[j]) for j in range(k) if j != i), default=0.0)
        for i in range(k)
    ]


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    gap = vectors - centroid
    return np.einsum("ij,ij->i", gap, gap)


def nearest_two(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the nearest centroid, its squared distance, the next squared distance); the smaller number among equals."""
    distances = np.stack([squared(vectors, c) for c in centroids], axis=1)
    own = distances.argmin(1)
    rows = np.arange(len(vectors))
    best = distances[rows, own]
    if len(centroids) == 1:
        return own, best, np.full(len(vectors), inf)
    distances[rows, own] = np.iinfo(np.int64).max
    return own, best, distances.min(1).astype(np.float64)


def reassign(
    vectors: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray, centroids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Assignment and bounds against these centroids, for bounds that hold against them already, and the number of vectors scanned."""
    own, upper, lower = own.copy(), upper.copy(), lower.copy()
    sure = lambda u, l: u * (1 + MARGIN) + MARGIN < l * (1 - MARGIN)
    doubt = np.flatnonzero(~sure(upper, lower))
    for j in np.unique(own[doubt]):
        if j >= 0:
            part = doubt[own[doubt] == j]
            upper[part] = np.sqrt(squared(vectors[part], centroids[j]))
    scan = doubt[~sure(upper[doubt], lower[doubt])]
    if len(scan):
        own[scan], best, second = nearest_two(vectors[scan], centroids)
        upper[scan], lower[scan] = np.sqrt(best), np.sqrt(second)
    return own, upper, lower, len(scan)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension).astype(np.int64)


def _round(centroids: np.ndarray, drifts: list[float], losses: list[float]) -> Callable[[Iterator], Iterator]:
    """One round over the written state: bounds follow the moved centroids, then the ambiguous vectors are scanned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drift, loss = np.array([*drifts, 0.0]), np.array([*losses, 0.0])  # the last one is for vectors in no cluster yet
        for batch in slices(batches, 4096):
            before, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cluster", "upper", "lower"))
            vectors = _matrix(batch.column("vector"), centroids.shape[1])
            own, upper, lower, _ = reassign(vectors, before, upper + drift[before], lower - loss[before], centroids)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("vector"), pa.array(own, pa.int32()), pa.array(before, pa.int32()),
                 pa.array(upper, pa.float64()), pa.array(lower, pa.float64())],
                ["id", "vector", "cluster", "before", "upper", "lower"],
            )

    return run


def _distances(centroids: np.ndarray) -> Callable[[Iterator], Iterator]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            own = batch.column("cluster").to_numpy(zero_copy_only=False)
            distance = squared(_matrix(batch.column("vector"), centroids.shape[1]), centroids[own])
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(distance, pa.int64())], ["id", "cluster", "distance"])

    return run


def _moved(state: DataFrame) -> list:
    """Per cluster, position and sign: what the vectors that changed their cluster add to its sum. At most 2 * k * dimension rows."""
    moved = state.where("cluster <> before")
    entered = moved.select("cluster", F.lit(1).alias("sign"), "vector")
    left = moved.where("before >= 0").select(F.col("before").alias("cluster"), F.lit(-1).alias("sign"), "vector")
    parts = entered.unionByName(left).select("cluster", "sign", F.posexplode("vector").alias("pos", "x"))
    return parts.groupBy("cluster", "sign", "pos").agg(F.sum(F.col("x").cast("long")).alias("sum")).collect()


def centroid_clusters(
    vectors: DataFrame, clusters: int = 8, rounds: int = 10, dimension: int = 64, scale: int = 1024, seed: str = "3",
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector of ``dimension`` components, none null or non-finite: id, cluster, distance (squared, to the final centroid),
    cluster_inertia, inertia, centroid_sha256. Other rows and columns are left out.

    Components become floor(scale * x). The first centroids are the vectors with the smallest SHA-256 of ``seed:id`` (equal hashes by vector, a null id
    last); with fewer vectors there are fewer centroids. Every round assigns all vectors to the nearest centroid, the smaller
    number among equals, and replaces every centroid that has vectors by floor(sum / count); after the last round vectors are assigned once more.
    Rows that repeat an id are vectors of their own. No vectors give no rows. A component beyond 2**27 after scaling raises.
    """
    scratch = Scratch(vectors.sparkSession, "clusters")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    usable = f"v IS NOT NULL AND size(v) = {dimension} AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    rows = rows.where(usable).select("id", F.expr(f"transform(v, x -> floor({scale}D * double(x)))").alias("vector"))
    fits = F.expr(f"forall(vector, x -> abs(x) <= {LARGEST})")
    checked = F.when(fits, F.col("vector")).otherwise(F.raise_error(F.lit(f"a component beyond {LARGEST}")))
    start = rows.select(
        "id", checked.cast("array<int>").alias("vector"), F.lit(-1).alias("cluster"), F.lit(-1).alias("before"),
        F.lit(inf).alias("upper"), F.lit(0.0).alias("lower"),
    )
    schema = start.schema
    state = scratch.keep(start)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = state.select(digest.alias("digest"), "vector").orderBy(F.asc_nulls_last("digest"), "vector").limit(clusters).collect()
    centroids = np.array([row["vector"] for row in first], np.int64).reshape(-1, dimension)
    k = len(centroids)
    sums = [[0] * dimension for _ in range(k)]
    drifts, losses = [0.0] * k, [0.0] * k
    for turn in range(rounds + 1 if k else 0):
        after = scratch.keep(state.mapInArrow(_round(centroids, drifts, losses), schema))
        scratch.drop(state)
        state = after
        if turn == rounds:
            break
        for row in _moved(state):
            sums[row["cluster"]][row["pos"]] += row["sign"] * row["sum"]
        spheres = {r["cluster"]: r for r in state.groupBy("cluster").agg(F.count("*").alias("n"), F.max("upper").alias("radius")).collect()}
        moved = np.array([[s // spheres[j]["n"] for s in sums[j]] if j in spheres else centroids[j] for j in range(k)], np.int64)
        losses = loosening(centroids, moved, [spheres[j]["radius"] if j in spheres else None for j in range(k)])
        drifts = [sqrt(d) for d in ((moved - centroids) ** 2).sum(1).tolist()]
        centroids = moved
    found = state.select("id", "vector", "cluster").mapInArrow(_distances(centroids), f"id {schema['id'].dataType.simpleString()}, cluster int, distance long")
    found = scratch.keep(found)
    scratch.only(found)
    inertia = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))  # one row per centroid
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    name = F.element_at(F.array(*map(F.lit, names)), F.col("cluster") + 1) if names else F.lit("")
    inertia = inertia.withColumn("inertia", F.lit(found.agg(F.sum("distance")).first()[0]).cast("long")).withColumn("centroid_sha256", name)
    return found.join(F.broadcast(inertia), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
