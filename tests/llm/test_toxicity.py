import math
import re
import zlib

import numpy as np
import xxhash
from livegauge.llm.toxicity import _SPAN, _trained, _words, features, fit, keep_clean, rate, telling_features
from pyspark.sql import functions as F

from tests.llm.data import documents, rows

MEDIUM = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet")


def test_held_out_toxic_texts_are_found_and_clean_ones_left_alone(spark):
    docs, labels = tables(spark)
    have = {r["doc_id"]: r for r in rows(rate(docs, labels))}
    assert len(have) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in have.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in have.values())
    held = [(r["toxic"], have[r["doc_id"]]["predicted"]) for r in rows(labels) if r["doc_id"] in have and have[r["doc_id"]]["held_out"]]
    toxic, clean = [p for t, p in held if t], [p for t, p in held if not t]
    assert len(toxic) >= 8 and np.mean(toxic) >= 0.6 and np.mean(clean) <= 0.02  # 33 toxic texts to learn from


def test_held_out_labels_teach_nothing(spark):
    docs, labels = tables(spark)
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    other = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = ({r["doc_id"]: r["score"] for r in rows(rate(docs, x))} for x in (labels, other))
    assert one == two


def test_awkward_rows(spark):
    docs = documents(spark)
    labels = docs.select("doc_id", F.lit(None).cast("int").alias("quality"), F.when(F.col("doc_id") % 4 == 0, 1).when(F.col("doc_id") % 4 == 1, 0).alias("toxic"))
    have = rows(rate(docs, labels))
    assert sorted(str(r["doc_id"]) for r in have) == sorted(str(r["doc_id"]) for r in rows(docs))
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in have)
    kept = keep_clean(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["predicted"] == 0 for r in have)


def test_no_labels_no_rows(spark):
    docs, (d, labels) = documents(spark), tables(spark)
    assert {r["predicted"] for r in rows(rate(docs, labels.limit(0)))} == {0}
    assert keep_clean(docs, labels.limit(0)).count() == docs.count()
    assert rate(d.limit(0), labels).count() == 0


def test_risk_finds_the_positive_word_among_unlabelled_positives():
    """A tenth of the unlabelled texts are positive too; a naive model of labelled against unlabelled would rate them by that."""
    pick = np.random.default_rng(5)
    text = lambda toxic: np.unique(np.append(pick.integers(10, 60, 20), [1] if toxic else [])).astype(np.uint64)
    model = fit([text(True) for _ in range(200)], [text(k % 10 == 0) for k in range(1000)], 0.1)
    known = dict(zip(model.known.tolist(), model.weights, strict=True))
    assert set(known) == {1} and known[1] + model.bias > 1 and model.bias < -1
    # A classifier of labelled against unlabelled would put a text with the word at 200 / (200 + 100), less than the prior says.
    assert 1 / (1 + np.exp(-known[1] - model.bias)) > 0.85


def test_long_texts_are_read_to_the_end():
    text = "filler words " * (_SPAN // 8) + " last"
    assert _words(text) == {"filler", "words", "last"} and len(features(None)) == len(features("")) == 0


def crowded(spark, share, copied):
    """2,000 texts of common words; ``share`` of the rows toxic: texts that hold two of ten toxic words, or copies of one of them."""
    pick = np.random.default_rng(8)
    found, labels = [], []
    one = " ".join([f"common{k}" for k in pick.integers(0, 200, 25)] + ["vile3", "vile7"])
    for i in range(2000):
        toxic, fresh = pick.random() < share, copied is None or pick.random() > copied
        words = [f"common{k}" for k in pick.integers(0, 200, 25)] + [f"vile{k}" for k in pick.choice(10, 2, replace=False) if toxic]
        found.append((i, " ".join(pick.permutation(words)) if fresh or not toxic else one))
        labels.append((i, int(toxic)))
    return documents(spark, found), spark.createDataFrame(labels, "doc_id long, toxic int")


def check_crowded(docs, labels):
    toxic = {r["doc_id"]: r["toxic"] for r in rows(labels)}
    have = {r["doc_id"]: r["predicted"] for r in rows(rate(docs, labels))}
    assert np.mean([have[i] for i, t in toxic.items() if t]) >= 0.95 and np.mean([have[i] for i, t in toxic.items() if not t]) <= 0.02
    kept = {r["doc_id"] for r in rows(keep_clean(docs, labels))}
    assert kept == {i for i, p in have.items() if not p}


def test_toxic_texts_are_found_whatever_their_share(spark):
    for share in (0.3, 0.7):
        check_crowded(*crowded(spark, share, None))


def test_a_third_of_the_rows_are_copies_of_one_toxic_text(spark):
    check_crowded(*crowded(spark, 0.36, 0.92))
    check_crowded(*crowded(spark, 0.33, 1.0))  # and nothing else is toxic


def test_scores_equal_plain_sums(spark):
    docs, labels = tables(spark)
    model = _trained(docs, labels, "doc_id", "text")
    weight = dict(zip(model.known.tolist(), model.weights.tolist(), strict=True))
    assert len(weight) > 3
    texts = {r["doc_id"]: r["text"] for r in rows(docs)}
    for r in rows(rate(docs, labels)):
        words = {w for w in re.findall(r"[^\W_]+", (texts[r["doc_id"]] or "").lower())}
        names = [w for w in words] + ["^" + p for p in {w[:4] for w in words if len(w) > 4}]
        z = model.bias + sum(weight.get(xxhash.xxh3_64_intdigest(n.encode()), 0.0) for n in names)
        assert abs(r["score"] - 1 / (1 + math.exp(-z))) < 1e-9


def test_every_telling_feature_is_kept():
    """More telling words than any cap would let through: each of 60,000 in every toxic text and in no other."""
    toxic = [np.arange(60_000, dtype=np.uint64) for _ in range(60)]
    clean = [np.array([10**6 + k], np.uint64) for k in range(60)]
    assert len(telling_features(toxic, clean)) == 60_000
