import zlib

import pytest
from livegauge.llm.sharding import byte_shards

from tests.llm.data import SMALL, documents, grouped, rows


def smallest(sizes, shards):
    """By plain halving over the whole range."""

    def needed(capacity):
        count, held = 1, 0
        for size in sizes:
            if held + size > capacity:
                count, held = count + 1, 0
            held += size
        return count

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if needed(middle) <= shards else (middle + 1, high)
    return low


def check(df, shards):
    have = rows(byte_shards(df, shards=shards))
    source = rows(df.select("doc_id", "text"))
    size = lambda t: len((t or "").encode()) + 1
    want = sorted((str(r["doc_id"]), size(r["text"]), zlib.crc32((r["text"] or "").encode())) for r in source)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in have) == want
    first, total = {}, {}
    for r in source:
        t = r["text"]
        first[t] = min(first.get(t, float("inf")), float("inf") if r["doc_id"] is None else r["doc_id"])
        total[t] = total.get(t, 0) + size(t)
    no_id = [t for t in first if first[t] == float("inf")]
    ordered = no_id + sorted((t for t in first if t not in no_id), key=first.get)
    by = grouped((r["shard"], r) for r in have)
    assert max(sum(r["size"] for r in group) for group in by.values()) == smallest([total[t] for t in ordered], shards)
    assert set(by) == set(range(len(by))) and len(by) <= shards
    for group in by.values():
        assert sorted(r["slot"] for r in group) == list(range(len(group)))
    places = grouped(((r["size"], r["text_crc32"]), r["shard"]) for r in have if r["size"] > 1)
    assert all(len(set(p)) == 1 for p in places.values())
    assert {r["law"] for r in have} == {"bytes"} and {r["grown_shard"] for r in have} == {None}


@pytest.mark.parametrize("shards", [1, 5, 16])
def test_awkward_rows(spark, shards):
    check(documents(spark), shards)


def test_given_documents(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"), 16)


def test_a_third_of_all_rows_are_copies(spark):
    check(documents(spark, [(i, "copy of one text " * 9 if i % 3 else f"text {i} " * (i % 11)) for i in range(300)]), 16)


def test_fewer_texts_than_shards_and_none(spark):
    check(documents(spark, [(1, "a"), (2, "bb")]), 16)
    assert byte_shards(documents(spark, [])).count() == 0


def test_no_python_in_the_plan(spark):
    plan = byte_shards(documents(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
