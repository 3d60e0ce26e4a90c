import json
import subprocess
import sys

import corpus_pipeline
from livegauge.llm.language import has_letter, remainder, train_language_model

from tests.llm.data import documents, grouped, rows
from tests.llm.test_exact import LOWER
from tests.llm.test_language import plain_predict
from tests.llm.test_minhash import plain as plain_near

MEDIUM = "/root/testdata/sf0.01"


def test_each_stage_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in rows(spark.read.parquet(f"{MEDIUM}/labels.parquet"))}
    stages = [f for _, f in corpus_pipeline.STAGES]
    clean = stages[0](spark, docs, MEDIUM).cache()
    ids = {r["doc_id"] for r in rows(clean)}
    gone = [labels.get(r["doc_id"]) for r in rows(docs) if r["doc_id"] not in ids]
    assert gone and sum(x == 0 for x in gone) <= 0.1 * len(gone)
    assert sum(labels.get(i) == 1 for i in ids) <= 0.4 * sum(labels.values())  # few to learn from here: a word or two each

    known = stages[1](spark, clean, MEDIUM).cache()
    model = train_language_model(clean.where(remainder("doc_id", 5) != 0).selectExpr("doc_id AS id", "text", "lang"))
    scored = ((r["doc_id"], plain_predict(model, r["text"])[1][0]) for r in rows(clean) if has_letter(r["text"]))
    assert {r["doc_id"] for r in rows(known)} == {i for i, score in scored if score >= model.floor}

    single = stages[2](spark, known, MEDIUM).cache()
    copies = grouped((r["text"].encode().translate(LOWER), r["doc_id"]) for r in rows(known))
    assert {r["doc_id"] for r in rows(single)} == {max(v) for v in copies.values()}

    near = stages[3](spark, single, MEDIUM).cache()
    assert sorted(r["doc_id"] for r in rows(near)) == sorted(i for i, *_, kept in plain_near(single, 5) if kept)
    assert all(df.columns == docs.columns for df in (clean, known, single, near))

    packed = rows(stages[4](spark, near, MEDIUM))
    lengths = grouped((r["doc_id"], r["length"]) for r in packed)
    assert set(lengths) == {r["doc_id"] for r in rows(near)}
    assert all(sum(lengths[r["doc_id"]]) == r["doc_tokens"] for r in packed)


def test_awkward_rows_and_none_pass_through(spark):
    for docs in (documents(spark), documents(spark, [])):
        kept = docs
        for _, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, MEDIUM)
        assert (kept.count() > 0) == (docs.count() > 0)


def test_run_is_the_stages_in_order(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and out.count() > 0


def test_queries_are_registered_and_the_library_does_without():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} >= {f"op{k}" for k in range(1, 11)} and "pipeline" in names
    script = (
        "import sys, json\n"
        "sys.modules['livegauge.llm'] = None\n"
        "import __spark_entry__ as c\n"
        "print(json.dumps(sorted(c.queries())))"
    )
    done = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, check=True)
    left = set(json.loads(done.stdout.splitlines()[-1]))
    assert left == {n for n in names if not n.startswith("op") or not n[2].isdigit()} - {"pipeline"}
