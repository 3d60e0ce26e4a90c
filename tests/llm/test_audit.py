import re
from itertools import permutations

import pytest
from livegauge.llm.audit import Diagram, adjacent_swaps, failure_masks, filter_audit, interactions, order_steps, text_conditions

from tests.llm.data import clash, documents, grouped, rows, texts


def fails(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    return [
        len(words) < 100,
        100 * len(set(words)) < 80 * len(words),
        100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
        any(c in "#$%&*|" for c in text),
    ]


def plain(found, marks):
    """The contract by walking through the documents, once for every order."""
    good = {i for i, g, _ in marks if g == 1 and i is not None}
    toxic = {i for i, _, t in marks if t == 1 and i is not None}
    ids = grouped((t or "", i) for i, t, _ in found if i is not None)
    of_part = grouped(
        (lang or "", (fails(t or "") + [i is not None and i > min(ids[t or ""])], i in good, i in toxic)) for i, t, lang in found
    )
    out = []
    for part, docs in of_part.items():
        lost = dict.fromkeys(range(5), 0)
        of_part_rows = []
        for order in permutations(range(5)):
            left = docs
            for step, f in enumerate(order, 1):
                gone, left = [d for d in left if d[0][f]], [d for d in left if not d[0][f]]
                lost[f] += len(gone)
                failing = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0]) == 1 for d in docs)
                name = "".join("ABCDE"[v] for v in order)
                of_part_rows.append(
                    (f, (part, name, step, len(left), len(gone), failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone)))
                )
        out += [(*row, lost[f]) for f, row in of_part_rows]
    return sorted(out)


def check(spark, found, marks):
    docs = clash(spark.createDataFrame(found, "doc_id long, text string, lang string"))
    labels = clash(spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert sorted(tuple(r) for r in filter_audit(docs, labels).collect()) == plain(found, marks)


MORE = [
    (200, "A" * 50), (201, "# one two"), (202, " ".join(f"w{i}" for i in range(100))), (203, "same " * 120), (204, "ONE TWO " * 60 + "|"),
    (205, " ".join(f"x{i}" for i in range(80)) + " x1" * 20), (206, " ".join(f"x{i}" for i in range(79)) + " x1" * 21), (207, "A" + "b" * 9), (208, "AB" + "b" * 8),
    (3, "A" * 50), (201, "# one two"), (208, "x\x0by\x1cz " * 60), (None, "A" * 50), (None, "A" * 50),
]


def test_awkward_rows(spark):
    found = [(i, t, (None, "", "en", "de")[n % 4]) for n, (i, t) in enumerate(texts() + MORE)]
    marks = [(i, i % 3 % 2 if i % 5 else None, i % 2) for i in range(0, 210, 2)] + [(200, 1, 1), (200, 0, None), (201, None, 1), (None, 1, 1), (9999, 1, 1)]
    check(spark, found, marks)


def test_a_third_of_all_rows_are_copies_in_one_language(spark):
    found = [(i, "copy " * 30 if i % 3 == 0 else f"text {i} " * (i % 60), "en" if i % 5 else "de") for i in range(600)]
    check(spark, found, [(i, 1, i % 2) for i in range(0, 600, 3)])


def test_no_rows_and_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(documents(spark, []), labels).count() == 0
    assert filter_audit(documents(spark, [(1, None)]), labels).count() == 600


def test_every_order_is_one_swap_away():
    for n in range(1, 7):
        order, seen = list(range(n)), {tuple(range(n))}
        for level in adjacent_swaps(n):
            order[level : level + 2] = reversed(order[level : level + 2])
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert seen == set(permutations(range(n)))


def test_a_swapped_diagram_equals_one_built_in_that_order():
    weights = {m: (m * m % 7, m % 3, m % 2) for m in range(16) if m not in (3, 9)}
    diagram = Diagram(4, weights, 3)
    for level in adjacent_swaps(4):
        diagram.swap(level)
        moved = {sum(1 << place for place, v in enumerate(diagram.order) if m >> v & 1): w for m, w in weights.items()}
        built = Diagram(4, moved, 3)
        assert [list(map(tuple, s[1:])) for s in diagram.steps()] == [list(map(tuple, s[1:])) for s in built.steps()]
        assert [len(level) for level in diagram.levels] == [len(level) for level in built.levels]  # as small as can be


def test_equal_branches_are_one_node():
    assert [len(level) for level in Diagram(5, {m: (1,) for m in range(32)}, 1).levels] == [1] * 5


def test_other_filters(spark):
    masks = spark.createDataFrame([("p", 1, 0, 0), ("p", 3, 1, 0), ("p", 0, 0, 1), ("q", 2, 0, 1)], "part string, mask int, good int, toxic int")
    found = {(r["part"], r["filter_order"], r["step"]): r for r in rows(interactions(masks, "XY"))}
    assert len(found) == 8
    assert [found["p", "XY", 1][c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "shapley")] == [1, 2, 0, 1, 1, 3]
    assert [found["p", "YX", 2][c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "shapley")] == [1, 1, 1, 1, 0, 3]
    assert order_steps("Z", {}) == [("Z", 1, 0, 0, 0, 0, 0, 0, 0)]
    for names in ("", "AA", "ABCDEFGHI"):
        with pytest.raises(ValueError, match="filters"):
            interactions(masks, names)


def test_texts_are_not_shuffled(spark):
    masks = failure_masks(documents(spark, [(1, "a")]), spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    plan = masks._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and not any("text#" in line for line in plan.splitlines() if "Exchange" in line)
    assert list(text_conditions(masks["mask"].cast("string"))) == list("ABCD")
