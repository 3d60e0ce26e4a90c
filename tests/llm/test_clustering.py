import hashlib
import math
import random

import numpy as np
import pytest
from livegauge.llm.clustering import asymptote_drift, centroid_clusters, loosening, reassign
from pyspark.errors import PySparkException

from tests.llm.data import SMALL, clash, rows

COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def plain(found, clusters=8, rounds=10, dimension=64, seed="3"):
    """Lloyd's rounds in Python's whole numbers."""
    kept = []
    for i, v in found:
        if v is not None and len(v) == dimension and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    digest = lambda i: hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, "" if r[0] is None else digest(r[0]), r[1]))[:clusters]]

    def assign():
        distances = [[sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids] for _, v in kept]
        return [(d.index(min(d)), min(d)) for d in distances]

    for _ in range(rounds):
        own = assign()
        for k in range(len(centroids)):
            members = [v for (_, v), (c, _) in zip(kept, own, strict=True) if c == k]
            if members:
                centroids[k] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assign()
    total = sum(d for _, d in own)
    of = [sum(d for c, d in own if c == k) for k in range(len(centroids))]
    name = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, of[c], total, name[c]) for (i, _), (c, d) in zip(kept, own, strict=True)), key=str)


def check(spark, found, **options):
    df = clash(spark.createDataFrame(found, "vec_id long, embedding array<float>").withColumnRenamed("size", "size_"))
    have = centroid_clusters(df, **options)
    assert have.columns == COLUMNS
    assert sorted((tuple(r) for r in have.collect()), key=str) == plain(found, **options)


def around(seed, n, dimension=64, centres=5, spread=0.2):
    pick = np.random.default_rng(seed)
    middle = pick.normal(size=(centres, dimension))
    return [(i, [float(x) for x in middle[i % centres] + spread * pick.normal(size=dimension)]) for i in range(n)]


def test_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    found = [(r["vec_id"], r["embedding"]) for r in rows(df.select("vec_id", "embedding"))]
    assert sorted((tuple(r) for r in centroid_clusters(df).collect()), key=str) == plain(found)


def test_awkward_rows(spark):
    found = around(1, 150)
    one = found[3][1]
    found += [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [1.0] * 63), (904, [float("nan")] * 64), (905, [float("inf")] * 64)]
    found += [(906, [0.0] * 64), (907, [0.0] * 64), (907, [0.0] * 64), (907, [1.0] * 64), (None, one), (None, [2.0] * 64), (908, [1e5] * 64), (909, [-0.0005] * 64)]
    check(spark, found)


def test_a_third_of_all_vectors_are_equal(spark):
    check(spark, [(i, [0.25] * 64 if i % 3 else v) for i, v in around(2, 240)])


def test_ties_go_to_the_smaller_number(spark):
    points = [(i, [float((i * 7 + j * 3) % 5 - 2) for j in range(2)]) for i in range(100)]
    check(spark, points, dimension=2, clusters=4, seed="tie")
    check(spark, [(i, [float(i % 2), 0.0]) for i in range(40)], dimension=2, clusters=6)  # equal centroids, some without vectors


@pytest.mark.parametrize("rounds, clusters", [(0, 8), (1, 1), (4, 30)])
def test_other_numbers(spark, rounds, clusters):
    check(spark, around(3, 120, 8), dimension=8, rounds=rounds, clusters=clusters, seed="x")


def test_few_and_no_vectors(spark):
    check(spark, around(4, 3))
    check(spark, [])
    check(spark, [(1, [1.0])])


def test_components_that_would_overflow_raise(spark):
    df = spark.createDataFrame([(1, [3e38] * 64)], "vec_id long, embedding array<float>")
    with pytest.raises(PySparkException, match="component beyond"):
        centroid_clusters(df).collect()


def test_the_bound_holds_and_is_tighter_than_the_drift():
    pick = np.random.default_rng(6)
    shares = []
    for _ in range(3000):
        dimension = int(pick.integers(1, 6))
        centre, old = pick.normal(size=(2, dimension)) * pick.choice([0.5, 3, 20])
        new = old + pick.normal(size=dimension) * pick.choice([0.01, 0.5, 3])
        radius = abs(pick.normal()) * pick.choice([0.1, 1, 5])
        bound = asymptote_drift(centre, radius, old, new)
        drift = np.linalg.norm(new - old)
        assert 0 <= bound <= drift * (1 + 1e-9)
        ways = pick.normal(size=(200, dimension))
        ways *= radius / np.linalg.norm(ways, axis=1, keepdims=True)
        inside = np.vstack([centre + ways, centre + ways * pick.random((200, 1)), centre])
        assert (np.linalg.norm(inside - old, axis=1) - np.linalg.norm(inside - new, axis=1)).max() <= bound + 1e-9
        shares.append(bound / drift)
    assert np.mean(shares) < 0.6
    assert asymptote_drift(np.zeros(2), 1.0, np.ones(2), np.ones(2)) == 0


def test_bounds_spare_scans_and_more_of_them_than_full_drifts():
    """Rounds by hand: every assignment equals a full scan, and geometry scans fewer vectors than the largest drift does."""
    points = np.floor(1024 * np.array([v for _, v in around(7, 4000, 16, centres=9, spread=0.45)])).astype(np.int64)
    scans = {}
    for tight in (True, False):
        centroids = points[random.Random(1).sample(range(len(points)), 8)]
        own, upper, lower = np.full(len(points), -1), np.full(len(points), np.inf), np.zeros(len(points))
        scanned = []
        for _ in range(12):
            own, upper, lower, n = reassign(points, own, upper, lower, centroids)
            assert (own == ((points[:, None] - centroids[None]) ** 2).sum(2).argmin(1)).all()
            scanned.append(n)
            moved = np.array([points[own == k].sum(0) // (own == k).sum() for k in range(8)])
            drift = np.sqrt(((moved - centroids) ** 2).sum(1).astype(float))
            radii = [float(upper[own == k].max()) for k in range(8)]
            loss = np.array(loosening(centroids, moved, radii)) if tight else np.array([max(np.delete(drift, k)) for k in range(8)])
            upper, lower, centroids = upper + drift[own], lower - loss[own], moved
        scans[tight] = sum(scanned[1:])
    assert scans[True] < scans[False] < 11 * len(points)
