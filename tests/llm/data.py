"""Small tables with every kind of awkward row, and plain versions of what the operators share."""

from __future__ import annotations

import random
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"

# Names that the operators use inside, here as columns of the input.
CLASHING = "id row line key node rep component digest signature n label vector size chunk ids bundle word toxic part shard kept _gone _kept_id".split()


def rows(df: DataFrame) -> list[dict]:
    return [row.asDict(recursive=True) for row in df.collect()]


def clash(df: DataFrame) -> DataFrame:
    have = {c.lower() for c in df.columns}
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHING if c not in have})


def texts(seed: int = 1) -> list[tuple[int | None, str | None]]:
    """Copies, near copies, blanks, nulls, one word, a very long text, other scripts, repeated rows and null ids."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdefghij", k=pick.randint(1, 7))) for _ in range(300)]
    sentence = lambda n: " ".join(pick.choices(vocabulary, k=n))
    base, long = sentence(120), sentence(60_000)
    near = base.split()
    near[7] = "changed"
    found = [(i, sentence(pick.randint(2, 90))) for i in range(40)]
    found += [(100, base), (101, base.upper()), (102, " ".join(near)), (103, base + " tail"), (104, base.replace(" ", "\n\t"))]
    found += [(110, None), (111, None), (112, ""), (113, " \n "), (114, "word"), (115, "WORD"), (116, "ÄÖ éà 漢字 😀 ß"), (117, "123 456 !?")]
    found += [(120, long), (121, long + " x"), (122, "nospace" * 20_000)]
    found += [(130, sentence(30))] * 3 + [(None, "null id"), (None, "null id"), (None, None)]
    return found


def documents(spark: SparkSession, found: list | None = None) -> DataFrame:
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    data = [(i, t, None if (i or 0) % 7 == 3 else ("en", "de", "fr")[(i or 0) % 3], None, None) for i, t in (texts() if found is None else found)]
    return clash(spark.createDataFrame(data, schema))


class Forest:
    """Connected components with the smallest member as name."""

    def __init__(self):
        self.up: dict = {}

    def of(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b) -> None:
        a, b = self.of(a), self.of(b)
        self.up[max(a, b)] = min(a, b)


def grouped(pairs) -> dict:
    found = defaultdict(list)
    for key, value in pairs:
        found[key].append(value)
    return found
