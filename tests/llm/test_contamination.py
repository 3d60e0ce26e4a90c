import hashlib
import random
import re

import pytest
from livegauge.llm.common import Scratch
from livegauge.llm.contamination import contaminated_documents, find_phrases, words_of
from pyspark.sql import functions as F

from tests.llm.data import clash, documents, grouped, rows, texts

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOWER).decode())


def plain(found, items, size=10):
    windows = grouped(
        (tuple(w[i : i + size]), item) for item, text in items if (w := words(text)) for i in range(max(1, len(w) - size + 1))
    )
    lengths = {len(w) for w in windows}
    out = []
    for doc, text in found:
        w, hit, held = words(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    held.update(str(x) for x in windows[tuple(w[i : i + n])] if x is not None)
        out.append((doc, len(w), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def benchmark(spark, items):
    return clash(spark.createDataFrame(items, "item_id long, text string"))


def check(spark, found, items, size=10):
    have = contaminated_documents(documents(spark, found), benchmark(spark, items), size=size)
    assert have.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted((tuple(r) for r in have.collect()), key=str) == plain(found, items, size)


def planted(seed=5):
    """Documents with whole, cut, overlapping and repeated passages, in other case and between other separators."""
    pick = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Ä", "ä", "漢字", "😀x", "é1"]
    text = lambda n: [pick.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(pick.randint(10, 25)))) for i in range(12)]
    items += [(20, items[0][1]), (100, items[1][1].upper()), (3, "w1 w2 w3"), (21, "w7"), (22, ""), (23, None), (24, "..."), (None, " ".join(text(11)))]
    items += [(25, "w5 " * 30), (26, "a " * 12)]
    found = []
    for i in range(120):
        w = text(pick.randint(0, 40))
        passage = words(pick.choice(items)[1])
        cut = passage[pick.randint(0, 3) : len(passage) - pick.randint(0, 3)]
        at = pick.randint(0, len(w))
        w[at:at] = cut + (cut[2:] if i % 7 == 0 else [])
        found.append((i, pick.choice([" ", ", ", "\n", "-", "\x00"]).join(w)))
    return found + [(500, "a " * 300), (501, "w5 " * 100), (None, "w7"), (None, "w7"), (502, "W1, W2; w3"), (7, "w7 again")], items


def test_planted_passages(spark):
    check(spark, *planted())


@pytest.mark.parametrize("size", [1, 2, 3, 4, 15])
def test_windows_of_other_sizes(spark, size):
    check(spark, *planted(size), size=size)


def test_awkward_rows(spark):
    found = texts()
    items = [(i, " ".join((t or "").split()[5:40])) for i, t in found if i is not None and i % 9 == 0] + [(100, found[40][1]), (1, None)]
    check(spark, found, items)


def test_a_third_of_all_rows_hold_one_passage_of_one_word(spark):
    found = [(i, "the " * (i % 50) if i % 3 else "x y z " + "the quick brown fox jumps over a very lazy dog " * 3) for i in range(400)]
    check(spark, found, [(1, "The quick brown fox jumps over a very lazy dog"), (2, "the " * 10), (3, "the"), (4, "unseen " * 10)])


def test_no_rows(spark):
    found, items = planted()
    check(spark, [], items)
    check(spark, found, [])
    check(spark, found, [(1, None), (2, "!")])


def test_words(spark):
    cases = [None, "", " ", "a", "A.b", "ÄA äa", "x\x00y\x7fz", "😀A 漢Z", "-1-", "İI"]
    df = spark.createDataFrame([(t,) for t in cases], "t string").select(words_of(F.col("t")).alias("w"))
    assert [r["w"] for r in rows(df)] == [words(t) for t in cases]


@pytest.mark.parametrize("slop", [0, 1, 3])
def test_proximity(spark, slop):
    pick = random.Random(slop)
    found = [(i, " ".join(pick.choices("abcdefgh", k=60))) for i in range(40)]
    phrases = [(i, " ".join(pick.choices("abcdefgh", k=n))) for i, n in enumerate((1, 2, 3, 4, 5, 6, 5))] + [(99, ""), (98, None), (97, "a b c"), (96, "a b c")]
    uses = {c: sum(words(t).count(c) for _, t in found) for c in "abcdefgh"}
    want = set()
    for d, t in found:
        w = words(t)
        for p, phrase in phrases:
            if not (terms := words(phrase)):
                continue
            first = min(range(len(terms)), key=lambda o: (uses[terms[o]], o))
            for i, x in enumerate(w):
                if x == terms[first] and all(
                    any(0 <= q < len(w) and w[q] == terms[o] for q in range(i - first + o - slop, i - first + o + slop + 1)) for o in range(len(terms)) if o != first
                ):
                    want.add((d, p, i - first + 1))
    df = spark.createDataFrame(phrases, "phrase_id long, phrase string")
    have = [tuple(r) for r in find_phrases(documents(spark, found), clash(df), slop).select("doc_id", "phrase_id", "start").collect()]
    assert len(have) == len(set(have)) and set(have) == want and want


def test_no_python_and_no_text_in_a_shuffle(spark, monkeypatch):
    plans = []
    keep = Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(self, df))
    out = contaminated_documents(*[make(spark, t) for make, t in ((documents, [(1, "a b")]), (benchmark, [(1, "a b")]))])
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5
    for plan in plans:
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct"))
    index_plan = next(p for p in plans if "posexplode" in p and "n_words" in p)
    assert "Exchange hashpartitioning" not in index_plan  # the index is written where the texts are read
