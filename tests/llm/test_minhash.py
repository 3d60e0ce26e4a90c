import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from livegauge.llm import minhash
from livegauge.llm.minhash import BITS, RADIUS, SYMBOLS, distance, drop_near, first_shared, keys, most_shared, near_duplicates, sketches
from pyspark.sql import functions as F

from tests.llm.data import SMALL, Forest, documents, grouped, rows


def shingles(text, words):
    found = (text or "").encode().lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def plain(df, words):
    found = [(r["doc_id"], shingles(r["text"], words)) for r in rows(df.select("doc_id", "text"))]
    forest, holders = Forest(), grouped((s, k) for k, (i, own) in enumerate(found) if i is not None for s in own)
    common = {}
    for ks in holders.values():
        for pair in combinations(ks, 2):
            common[pair] = common.get(pair, 0) + 1
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(found[a][1]) + len(found[b][1]) - n):
            forest.join(found[a][0], found[b][0])
    return [(i, len(s), None if i is None else forest.of(i), i is None or forest.of(i) == i) for i, s in found]


@pytest.mark.parametrize("words", [2, 5])
def test_awkward_rows(spark, words):
    df = documents(spark)
    have = [tuple(r.values()) for r in rows(near_duplicates(df, words=words))]
    assert sorted(have, key=str) == sorted(plain(df, words), key=str)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    have = [tuple(r.values()) for r in rows(near_duplicates(df, words=2))]
    assert sorted(have) == sorted(plain(df, 2))


def test_a_chain_is_one_component(spark):
    """Neighbours are alike, the ends are not: only links that do not start at the smallest member join them."""
    words = [f"w{i}" for i in range(400)]
    df = documents(spark, [(900 - k, " ".join(words[12 * k : 12 * k + 200])) for k in range(12)])
    have = {r["doc_id"]: r["component_id"] for r in rows(near_duplicates(df, words=2))}
    assert set(have.values()) == {889} and len(have) == 12


def test_no_rows(spark):
    assert near_duplicates(documents(spark, [])).count() == 0


def test_the_index_finds_every_pair_within_the_radius(spark):
    """Worst case: as many differing symbols as the radius allows, spread as evenly as they can be."""
    chunks = SYMBOLS // 6
    differing = [0] * chunks
    for k in range(RADIUS):
        differing[k % chunks] += 1
    other = [sum(1 << 8 * j for j in range(n)) for n in differing]
    df = spark.createDataFrame([([0] * chunks, other)], "a array<long>, b array<long>")
    row = df.select(distance("a", "b").alias("d"), F.size(F.array_intersect(keys("a"), keys("b"))).alias("k")).first()
    assert row["d"] == RADIUS and row["k"] >= 1


def test_a_pair_comes_from_the_first_key_it_shares(spark):
    pick = np.random.default_rng(3)
    x = pick.integers(0, 256, (400, 512), dtype=np.uint8)
    y = np.where(pick.random(x.shape) < 0.75, x, pick.integers(0, 256, x.shape, dtype=np.uint8))
    long = lambda rows: [[sum(int(s) << 8 * j for j, s in enumerate(c)) for c in row[:72].reshape(12, 6)] for row in rows]
    df = spark.createDataFrame(list(zip(range(400), long(x), long(y), strict=True)), "pair long, a array<long>, b array<long>")
    found = [(r["pair"], k) for r in df.select("pair", F.array_intersect(keys("a"), keys("b")).alias("k")).collect() for k in r["k"]]
    pair, key = (np.array(c) for c in zip(*found, strict=True))
    first = first_shared(key, x[pair], y[pair])
    least = {p: min(k for q, k in found if q == p) for p in set(pair.tolist())}
    assert len(least) > 300 and dict(zip(pair[first].tolist(), key[first].tolist(), strict=True)) == least and first.sum() == len(least)


def bits_of(sets):
    return np.ascontiguousarray(sketches(sets)[:, SYMBOLS:]).view(np.uint64)


@pytest.mark.parametrize("size", [1, 7, 200, 3000, 40_000])
def test_sketches_never_rule_out_what_two_sets_share(size):
    """Bound from above at every size and overlap; of small sets close to the true number."""
    pick = np.random.default_rng(size)
    one = np.unique(pick.integers(0, 2**64, size, dtype=np.uint64))
    others = [np.unique(np.concatenate([one[: size * k // 10], pick.integers(0, 2**64, 1 + size * (10 - k) // 8, dtype=np.uint64)])) for k in range(11)]
    bits = bits_of([one, *others])
    most = most_shared(len(one), bits[0], np.array([len(o) for o in others]), bits[1:])
    true = np.array([len(np.intersect1d(one, o)) for o in others])
    assert (most >= true).all() and bits.shape[1] * 64 == BITS
    if size <= 200:
        assert (most - true <= 0.12 * size + 1).all()


@pytest.mark.parametrize("nearest", [True, False])
def test_pairs_of_a_bucket_that_link_are_never_left_out(nearest):
    """At exactly 0.8, and one shingle below it where no two shingles fall into one range."""
    pick = np.random.default_rng(5)
    every = np.sort(pick.choice(BITS, 90, replace=False).astype(np.uint64) << np.uint64(52))
    x, at, below = every[:81], every[9:90], every[8:89]  # 72 of 90 are shared; of 89, 73
    less = np.concatenate([every[10:90], [np.uint64(1) << np.uint64(51)]])

    def found(a, b):
        sketch = sketches([a, b])
        sketch[:, :SYMBOLS] = 0
        bucket = pd.DataFrame({"node": [1, 2], "component": [1, 2], "n": [len(a), len(b)], "sketch": [r.tobytes() for r in sketch]})
        bucket = bucket.assign(key=0, block=0, i=0, j=0)
        return pd.concat(minhash._across(80, nearest)(iter([bucket]))).to_numpy().tolist()

    assert found(x, at) == found(x, below) == [[1, 2]]
    assert len(np.intersect1d(x, less)) == 71 and found(x, less) == []


def test_large_buckets_are_split_without_loss(spark, monkeypatch):
    """Copies that differ from one text in other places each: linked with it, not with one another, and not with the smallest id."""
    monkeypatch.setattr(minhash, "BLOCK", 5)
    pick = random.Random(8)
    base = [f"w{i}" for i in range(150)]
    changed = lambda k: " ".join(f"x{k}_{i}" if i in spots else w for spots in [set(pick.sample(range(150), pick.randint(5, 9)))] for i, w in enumerate(base))
    df = documents(spark, [(k, changed(k)) for k in range(80)] + [(500, " ".join(base))])
    have = [tuple(r.values()) for r in rows(near_duplicates(df, words=2))]
    assert sorted(have) == sorted(plain(df, 2))


def test_drop_keeps_one_of_each_group_and_the_columns(spark):
    df = documents(spark)
    kept = drop_near(df, words=2)
    assert kept.columns == df.columns
    want = sorted(str(i) for i, *_, k in plain(df, 2) if k)
    assert sorted(str(r["doc_id"]) for r in rows(kept)) == want
