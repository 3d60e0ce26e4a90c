"""Exact duplicates by recipes of content-defined chunks.

Every text is cut where its own content says so; a text is then the ordered list of its chunks. Chunks are deduplicated
to verified identifiers, and texts are equal when their lists of identifiers are. Only digests and identifiers are
shuffled, never a text, so a long document is read once and not moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from string import ascii_lowercase, ascii_uppercase

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch, slices

MIN_CHUNK, MEAN_BITS, MAX_CHUNK = 1024, 12, 32768
RECIPE = "row long, text_sha256 string, chunks array<struct<mark:long,size:int,proof:binary>>"

_GEAR = np.random.default_rng(20240131).integers(0, 2**32, 256, dtype=np.uint32)


def cut_points(data: bytes, least: int = MIN_CHUNK, bits: int = MEAN_BITS, most: int = MAX_CHUNK) -> list[int]:
    """Ends of the chunks of ``data``: where a hash of the last 32 bytes has ``bits`` leading zeros, at
    least ``least`` and at most ``most`` bytes apart. None for empty data."""
    n = len(data)
    if n <= least:
        return [n] if n else []
    roll = _GEAR[np.frombuffer(data, np.uint8)]
    for step in (1, 2, 4, 8, 16):  # doubles the window: roll[i] covers the bytes up to i
        wider = roll.copy()
        wider[step:] += roll[:-step] << np.uint32(step)
        roll = wider
    marks = np.flatnonzero(roll >> np.uint32(32 - bits) == 0) + 1
    ends, start = [], 0
    while n - start > least:
        i = np.searchsorted(marks, start + least)
        end = int(marks[i]) if i < len(marks) else n
        start = min(end, start + most, n)
        ends.append(start)
    if start < n:
        ends.append(n)
    return ends


def recipe(data: bytes) -> list[tuple[int, int, bytes]]:
    """(64-bit mark, size, SHA-256) of each chunk in order; the mark names a chunk, the rest proves it."""
    found, start = [], 0
    for end in cut_points(data):
        piece = data[start:end]
        mark = xxhash.xxh3_64_intdigest(piece)
        found.append((mark - (mark >> 63 << 64), end - start, hashlib.sha256(piece).digest()))
        start = end
    return found


def _recipes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in slices(batches):
        rows = []
        for row, text in zip(batch["row"], batch["text"], strict=True):
            data = (text or "").encode().lower()  # bytes.lower touches A-Z only
            rows.append((row, hashlib.sha256(data).hexdigest(), recipe(data)))
        yield pd.DataFrame(rows, columns=["row", "text_sha256", "chunks"])


def chunk_ids(chunks: DataFrame) -> DataFrame:
    """(mark, size, proof, chunk): an identifier for each distinct chunk.

    Chunks of one mark get one identifier only if size and SHA-256 agree too; otherwise each distinct one
    gets its own, numbered within the mark. Copies are combined before the shuffle.
    """
    proofs = chunks.groupBy("mark", "size", "proof").agg(F.count("*").alias("uses"))
    known = proofs.groupBy("mark").agg(F.sort_array(F.collect_list(F.struct("size", "proof"))).alias("known"))
    return known.select("mark", F.posexplode("known").alias("nth", "p")).select(
        "mark", "p.size", "p.proof", F.struct("mark", "nth").alias("chunk")
    )


def exact_groups(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after A-Z are lower-cased; null counts as empty, and empty texts form one group.
    The largest id of a group stays; a null id is below every other. Rows repeated with the same id are all
    counted, and all of them are kept if their id is; so is a group whose ids are all null. Other columns are not read.
    """
    spark = documents.sparkSession
    scratch = Scratch(spark, "exact")
    rows = documents.select(F.col(id_col).alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    recipes = scratch.keep(rows.mapInPandas(_recipes, RECIPE.replace("row long", f"row {kind}")))
    recipes = recipes.withColumn("line", F.monotonically_increasing_id())  # stable: the table is written
    recipes = scratch.keep(recipes)
    parts = recipes.select("line", F.posexplode("chunks").alias("pos", "c")).select("line", "pos", "c.*")
    named = parts.join(chunk_ids(parts), ["mark", "size", "proof"])
    lists = named.groupBy("line").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "chunk"))), lambda x: x["chunk"]).alias("ids")
    )
    whole = recipes.select("line", "row", "text_sha256").join(lists, "line", "left")
    whole = scratch.keep(whole.withColumn("ids", F.coalesce("ids", F.expr("cast(array() as array<struct<mark:long,nth:int>>)"))))
    scratch.only(whole)
    groups = whole.groupBy("ids").agg(F.max("row").alias("keep_id"), F.count("*").alias("group_size"))
    return whole.join(groups, "ids").select(
        F.col("row").alias(id_col), "keep_id", "group_size",
        F.col("row").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256",
    )


def drop_exact(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``documents`` that stay, all columns as they are. Copies repeated under the id that stays
    come back once each, with the text of that row. An id with several texts stays only where its text's group keeps it."""
    kept = exact_groups(documents, id_col, text_col).where("kept")
    kept = kept.select(F.col(id_col).alias("_kept_id"), F.col("text_sha256").alias("_kept_sha256")).distinct()
    name = "_text_sha256"
    while name in (c.lower() for c in documents.columns):
        name += "_"
    lower = F.translate(F.coalesce(F.col(text_col), F.lit("")), ascii_uppercase, ascii_lowercase)
    marked = documents.withColumn(name, F.sha2(lower, 256))
    same = marked[id_col].eqNullSafe(kept["_kept_id"]) & (marked[name] == kept["_kept_sha256"])
    return marked.join(kept, same, "left_semi").drop(name)
