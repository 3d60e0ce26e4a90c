import hashlib
import os
import random

from livegauge.llm.exact import MAX_CHUNK, chunk_ids, cut_points, drop_exact, exact_groups, recipe
from pyspark.sql import functions as F

from tests.llm.data import SMALL, documents, grouped, rows

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def plain(df):
    found = [(r["doc_id"], (r["text"] or "").encode().translate(LOWER)) for r in rows(df.select("doc_id", "text"))]
    groups = grouped((data, i) for i, data in found)
    out = []
    for i, data in found:
        ids = groups[data]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(data).hexdigest()))
    return out


def check(df):
    have = [tuple(r.values()) for r in rows(exact_groups(df).select("doc_id", "keep_id", "group_size", "kept", "text_sha256"))]
    assert sorted(have, key=str) == sorted(plain(df), key=str)


def test_awkward_rows(spark):
    check(documents(spark))


def test_given_documents(spark):
    check(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_no_rows(spark):
    assert exact_groups(documents(spark, [])).count() == 0


def test_chunks_cover_the_data_and_survive_an_insertion():
    data = random.Random(3).randbytes(400_000)
    ends = cut_points(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    assert max(b - a for a, b in zip([0, *ends], ends, strict=False)) <= MAX_CHUNK
    assert b"".join(data[a:b] for a, b in zip([0, *ends], ends, strict=False)) == data
    assert cut_points(b"") == [] and cut_points(b"x") == [1] and len(cut_points(b"a" * 100_000)) == 4
    changed = {c[2] for c in recipe(data[:1000] + os.urandom(10) + data[1000:])}
    assert len({c[2] for c in recipe(data)} - changed) <= 3


def test_chunks_of_one_mark_are_told_apart_by_their_proof(spark):
    chunks = spark.createDataFrame([(7, 3, b"a"), (7, 3, b"b"), (7, 3, b"a"), (8, 3, b"a")], "mark long, size int, proof binary")
    found = rows(chunk_ids(chunks))
    assert len(found) == 3 and len({tuple(r["chunk"].values()) for r in found}) == 3


def test_drop_keeps_the_columns_and_one_row_of_each_group(spark):
    df = documents(spark)
    kept = drop_exact(df)
    assert kept.columns == df.columns
    want = {i for i, keep, *_ in plain(df) if i == keep}
    assert {r["doc_id"] for r in rows(kept)} == want
    assert kept.where(F.col("doc_id") == 101).count() == 0 or kept.where(F.col("doc_id") == 100).count() == 0


def test_an_id_with_several_texts_stays_only_where_its_group_keeps_it(spark):
    df = documents(spark, [(9, "a"), (9, "B"), (12, "b"), (12, "É"), (3, "É"), (None, "a"), (None, "n"), (9, None), (1, "")])
    kept = rows(drop_exact(df.withColumn("_text_sha256", F.lit("x"))))
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(9, "a"), (12, "b"), (12, "É"), (None, "n"), (9, None)], key=str)
