"""How filters interact: what each removes, first or last, in every order, by decision diagrams.

Every document becomes a mask of the filters it fails. A part's masks, with their counts, form a decision diagram: one level per filter,
each node with a branch for documents that pass and one for those that fail, equal nodes shared, every branch weighted by the documents
that take it. Two adjacent levels can be swapped without building anything anew, so one swap leads from each order of the filters to
the next. The path on which everything passes then holds the steps of that order: what fails beside it is removed there.

Spark makes and counts the masks; a part has at most 2**k of them for k filters, whatever its size, and its diagram is built where they meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from string import ascii_uppercase

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WEIGHTS = ("n", "good", "toxic")
MOST_FILTERS = 8  # k! orders are returned; more filters raise
STEPS = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


class Diagram:
    """A decision diagram over failure masks whose leaves are weights, in one order of its variables at a time.

    ``levels[i]`` maps the nodes of level i to their (pass, fail) children; the nodes of the last level point at leaves. ``weight``
    holds for every node the sum of the weights below it.
    """

    def __init__(self, variables: int, weights: dict[int, tuple[int, ...]], width: int):
        self.order = list(range(variables))
        self.levels: list[dict[int, tuple[int, int]]] = [{} for _ in self.order]
        self.unique: list[dict[tuple[int, int], int]] = [{} for _ in self.order]
        self.weight: list[np.ndarray] = []
        leaves: dict[tuple[int, ...], int] = {}
        nodes = []
        for mask in range(1 << variables):
            value = weights.get(mask, (0,) * width)
            if value not in leaves:
                leaves[value] = len(self.weight)
                self.weight.append(np.array(value, object))
            nodes.append(leaves[value])
        for level in reversed(self.order):  # bit i of a mask is variable i, on level i
            half = 1 << level
            nodes = [self._node(level, nodes[m], nodes[m + half]) for m in range(half)]
        self.root = nodes[0]

    def _node(self, level: int, passes: int, fails: int) -> int:
        """The node of a level with these children; there is only one."""
        known = self.unique[level]
        if (passes, fails) not in known:
            known[passes, fails] = len(self.weight)
            self.levels[level][len(self.weight)] = (passes, fails)
            self.weight.append(self.weight[passes] + self.weight[fails])
        return known[passes, fails]

    def swap(self, level: int) -> None:
        """Exchange the variables of a level and the next. Nodes above and below stay as they are, those of the level keep their names."""
        upper, lower = self.levels[level], self.levels[level + 1]
        self.order[level : level + 2] = reversed(self.order[level : level + 2])
        self.levels[level + 1], self.unique[level + 1], self.unique[level] = {}, {}, {}
        for node, (passes, fails) in upper.items():
            (pp, pf), (fp, ff) = lower[passes], lower[fails]
            children = self._node(level + 1, pp, fp), self._node(level + 1, pf, ff)
            upper[node] = children
            self.unique[level][children] = node

    def steps(self) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(variable, weight removed at it, weight left after it) along the path on which all pass."""
        found, node = [], self.root
        for level, variable in enumerate(self.order):
            node, removed = self.levels[level][node]
            found.append((variable, self.weight[removed], self.weight[node]))
        return found


def adjacent_swaps(n: int) -> Iterator[int]:
    """Levels to swap so that each of the n! orders is met once, starting from the given one."""
    if n < 2:
        return
    inner, upwards = adjacent_swaps(n - 1), False
    while True:
        yield from range(n - 1) if upwards else range(n - 2, -1, -1)  # the last variable wanders through the others
        upwards = not upwards
        level = next(inner, None)
        if level is None:
            return
        yield level + upwards  # meanwhile it stands first, if it is about to go upwards, or last


def order_steps(names: str, counts: dict[int, tuple[int, ...]]) -> list[tuple]:
    """(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for every order of the filters."""
    diagram = Diagram(len(names), counts, len(WEIGHTS))
    orders = [(list(diagram.order), diagram.steps())]
    for level in adjacent_swaps(len(names)):
        diagram.swap(level)
        orders.append((list(diagram.order), diagram.steps()))
    # A filter in first place removes all that fail it, in last place those that fail nothing else.
    fails, alone, shapley = {}, {}, dict.fromkeys(range(len(names)), 0)
    for _, steps in orders:
        fails[steps[0][0]], alone[steps[-1][0]] = steps[0][1][0], steps[-1][1][0]
        for variable, removed, _ in steps:
            shapley[variable] += removed[0]
    return [
        ("".join(names[v] for v in order), place, left[0], removed[0], fails[v] - removed[0], alone[v], removed[1], removed[2], shapley[v])
        for order, steps in orders
        for place, (v, removed, left) in enumerate(steps, 1)
    ]


def interactions(masks: DataFrame, names: str) -> DataFrame:
    """What every filter removes at every place of every order, for each part.

    ``masks`` holds one row per document: part, mask (bit i set: it fails filter i, named by the letter at i), good and toxic (0 or 1). Counts are combined
    before the shuffle, so a part with most of the rows sends at most 2**k rows per task. A part has k * k! rows, those without a document
    among them; no rows give none. ``shapley`` is the sum of ``removed`` over all orders.
    """
    if not 1 <= len(names) <= MOST_FILTERS or len(set(names)) != len(names):
        raise ValueError(f"1 to {MOST_FILTERS} filters with different names")
    counts = masks.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic")
    )

    def of_part(group: pd.DataFrame) -> pd.DataFrame:
        weights = {int(row.mask): tuple(int(getattr(row, w)) for w in WEIGHTS) for row in group.itertuples()}
        found = [(group["part"].iloc[0], *row) for row in order_steps(names, weights)]
        return pd.DataFrame(found, columns=[c.split()[0] for c in STEPS.split(", ")])

    return counts.groupBy("part").applyInPandas(of_part, STEPS)


def text_conditions(text: Column) -> dict[str, Column]:
    """The failure conditions that a text decides alone: A under 100 words, B fewer than 80 % distinct words, C more than 10 % of the
    characters in A-Z, D one of ``#$%&*|``. An empty text fails A alone."""
    inner = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    words = F.split(inner, r"[\x20\x09-\x0D]+")
    n = F.when(inner == "", 0).otherwise(F.size(words))
    distinct = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words)))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": n < 100,
        "B": F.lit(100) * distinct < F.lit(80) * n,
        "C": F.lit(100) * capitals > F.lit(10) * F.char_length(text),
        "D": text.rlike(r"[#$%&*|]"),
    }


def failure_masks(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """(part, mask, good, toxic) of every row of ``documents``: the conditions of :func:`text_conditions`, and E, a text identical to that of a smaller id.

    Null texts are empty, null parts the part ''. Rows that repeat an id and its text are not copies of one another. A row with a null id fails E never,
    nor makes another one fail it; it has no labels. An id with several rows of labels is good or toxic if one of them says so.

    Texts meet by SHA-256, and only the smallest id of a text goes back to the documents: both joins are by document id, so a text with a third of all rows
    is spread over its ids.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    conditions = text_conditions(F.col("text"))
    bits = [F.when(condition, 1 << i).otherwise(0) for i, condition in enumerate(conditions.values())]
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"), text.alias("text")).select(
        "id", "part", F.unhex(F.sha2("text", 256)).alias("key"), reduce(Column.__add__, bits).alias("mask")
    )
    known = rows.where("id IS NOT NULL")
    first = known.groupBy("key").agg(F.min("id").alias("first_id")).withColumnRenamed("key", "first_key")
    marks = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("label_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    joined = known.join(first, (F.col("id") == F.col("first_id")) & (F.col("key") == F.col("first_key")), "left")
    joined = joined.join(marks, F.col("id") == F.col("label_id"), "left")
    copy = F.when(F.col("first_id").isNull(), 1 << len(bits)).otherwise(0)
    of_known = joined.select(
        "part", (F.col("mask") + copy).alias("mask"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    )
    nameless = rows.where("id IS NULL").select("part", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return of_known.unionByName(nameless)


def filter_audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The five filters A to E over ``documents``, in all 120 orders, for each language. Only doc_id, text and lang are read, of ``labels`` doc_id, quality
    and toxic. Long texts are taken whole."""
    return interactions(failure_masks(documents, labels), ascii_uppercase[:5])
