import random

import pytest
from livegauge.llm.audit import filter_audit
from livegauge.llm.clustering import centroid_clusters
from livegauge.llm.common import Scratch, collected, components
from livegauge.llm.contamination import contaminated_documents
from livegauge.llm.exact import exact_groups
from livegauge.llm.minhash import near_duplicates
from livegauge.llm.packing import pack
from livegauge.llm.sharding import byte_shards
from livegauge.llm.vectors import near_vectors
from livegauge.storage import matching, shared_dir

from tests.llm.data import Forest, documents, rows


@pytest.mark.parametrize("seed", range(3))
def test_against_a_plain_forest(spark, seed):
    pick = random.Random(seed)
    links = [(pick.randint(0, 400), pick.randint(0, 400)) for _ in range(250)]
    links += [(1000 + k, 1001 + k) for k in range(70)]  # a long chain
    links += [(5000, 6000 + k) for k in range(200)]  # a hub
    links += [(7000, 7000), (7001, 7002), (7001, 7002)]
    forest = Forest()
    for a, b in links:
        forest.join(a, b)
    have = rows(components(Scratch(spark, "test"), spark.createDataFrame(links, "a long, b long")))
    assert {r["node"]: r["component"] for r in have} == {x: forest.of(x) for pair in links for x in pair}
    assert len(have) == len({x for pair in links for x in pair})


def test_no_links(spark):
    assert components(Scratch(spark, "test"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_operators_leave_what_their_results_read(spark):
    """Tables that a call leaves in the shared folder; each result is still read after that."""
    folder = f"{shared_dir(spark)}/livegauge/*"
    docs = documents(spark)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(1, "some words")], "item_id long, text string")
    vectors = spark.createDataFrame([(i, [float(i % 3), 1.0 + i % 2], 0) for i in range(20)], "vec_id long, embedding array<float>, label int")
    cases = {
        "exact": (lambda: exact_groups(docs), 1), "near": (lambda: near_duplicates(docs), 2), "pack": (lambda: pack(docs), 2),
        "shards": (lambda: byte_shards(docs), 1), "vectors": (lambda: near_vectors(vectors, 0.9), 1), "audit": (lambda: filter_audit(docs, labels), 0),
        "contamination": (lambda: contaminated_documents(docs, items), 1), "clusters": (lambda: centroid_clusters(vectors, dimension=2), 1),
    }
    for name, (run, most) in cases.items():
        before = set(matching(spark, folder))
        out = run()
        assert out.count() > 0
        assert len(set(matching(spark, folder)) - before) <= most, name
    before = set(matching(spark, folder))
    with collected():
        assert near_duplicates(docs).count() == docs.count()
    assert set(matching(spark, folder)) == before


def test_scratch_drops_by_the_table_itself(spark):
    scratch = Scratch(spark, "tables")
    kept = [scratch.keep(spark.range(n + 1)) for n in range(4)]
    scratch.drop(kept[1])
    scratch.only(kept[2], kept[3])
    assert [df.count() for df in kept[2:]] == [3, 4] and len(scratch._tables) == 2
