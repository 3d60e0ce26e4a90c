"""Near-duplicate texts: b-bit minwise signatures, a multi-index Hamming join, and a check on full shingle sets.

A signature has CHUNKS chunks of WIDTH symbols of 8 bits. Two signatures that differ in at most
CHUNKS * (ERRORS + 1) - 1 symbols have, by pigeonhole, a chunk with at most ERRORS differing symbols. Each chunk is therefore
indexed under every choice of ERRORS symbols left out: an equi-join on these keys finds every pair within that distance.
At a similarity of 0.8 a symbol differs with probability 0.2, and a pair is missed by all chunks with probability
below 1e-5, at 0.9 below 1e-11.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch, components, slices

CHUNKS, WIDTH, ERRORS = 12, 6, 1  # keys() leaves out one symbol; a chunk fills the low 48 bits of a long
SYMBOLS = CHUNKS * WIDTH
RADIUS = CHUNKS * (ERRORS + 1) - 1
# Candidates also get a sketch: the symbols, and the set of the leading bits of their shingles. Two such sets bound the shingles that two texts can
# share, so a pair that the index found is left out only where its full sets cannot be alike.
BITS = 4096
FIRST = 30  # differing symbols up to which a member is compared with its bucket's centre first; the later steps take up all others
BLOCK = 1024  # rows of one bucket compared in one task with as many others

_rng = np.random.default_rng(8)
_MUL = _rng.integers(0, 2**32, SYMBOLS, dtype=np.uint32) | np.uint32(1)
_ADD = _rng.integers(0, 2**32, SYMBOLS, dtype=np.uint32)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64: spreads every input bit over the output."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words`` words; of a shorter text the one run it is."""
    found = (text or "").encode().lower().split()  # bytes: A-Z and ASCII white space only
    if not found:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    runs = max(1, len(hashed) - words + 1)
    total = np.zeros(runs, np.uint64)
    for k in range(min(words, len(hashed))):
        total = _mixed(total + hashed[k : k + runs] + np.uint64(k + 1))
    return np.unique(total)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def symbols(sets: list[np.ndarray]) -> np.ndarray:
    """A row of symbols for each set: for each hash function the low byte of the set's smallest value; no set may be empty."""
    high = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    return np.stack([np.minimum.reduceat(high * _MUL[k] + _ADD[k], starts).astype(np.uint8) for k in range(SYMBOLS)], axis=1)


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of bytes for each set: its symbols, then a bit for each of BITS equal ranges of hashes, set where the set has one in it."""
    bits = np.zeros((len(sets), BITS), bool)
    for row, found in zip(bits, sets, strict=True):
        row[found >> np.uint64(64 - (BITS - 1).bit_length())] = True
    return np.hstack([symbols(sets), np.packbits(bits, axis=1)])


def most_shared(n_x: int, x: np.ndarray, n_y: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The most shingles that a set of ``n_x``, its ranges ``x``, can share with each of the sets of ``n_y``, their ranges the rows of ``y``.
    Every range that one set reaches and the other does not holds a shingle that they do not share."""
    count = lambda bits: np.bitwise_count(bits).sum(-1, dtype=np.int64)
    return count(x & y) + np.minimum(n_x - count(x), n_y - count(y))


def _signatures(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            sets = [shingle_set(t, words) for t in batch["text"]]
            sizes = np.array([len(s) for s in sets])
            full = np.flatnonzero(sizes)
            packed = np.zeros((len(sets), CHUNKS), np.uint64)
            if len(full):
                found = symbols([sets[i] for i in full]).astype(np.uint64)
                for k in range(SYMBOLS):
                    packed[full, k // WIDTH] |= found[:, k] << np.uint64(8 * (k % WIDTH))
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "n_shingles": sizes,
                    "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
                    "signature": list(_signed(packed)),
                }
            )

    return run


def _sets(words: int):
    """(node, shingles, sketch) of the rows whose set is that of their node; a row with the id of a node but another text is not."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            nodes, sets = [], []
            for node, digest, text in zip(batch["node"], batch["digest"], batch["text"], strict=True):
                found = shingle_set(text, words)
                if xxhash.xxh3_128_digest(found.tobytes()) == bytes(digest):
                    nodes.append(node)
                    sets.append(found)
            found = [row.tobytes() for row in sketches(sets)] if sets else []
            yield pd.DataFrame({"node": np.array(nodes, np.int64), "shingles": list(map(_signed, sets)), "sketch": found})

    return run


def keys(signature: str = "signature") -> Column:
    """The index keys of a signature: chunk and place left out in the high bits, the other symbols below."""
    places = F.array(*[F.lit(k) for k in range(SYMBOLS)])
    return F.transform(
        places,
        lambda k: F.expr(f"cast({signature} as array<bigint>)")[(k / WIDTH).cast("int")].bitwiseAND(
            F.bitwise_not(F.array(*[F.lit(255 << 8 * j) for j in range(WIDTH)])[k % WIDTH])
        )
        + k.cast("bigint") * F.lit(1 << 48),
    )


def distance(a: str, b: str) -> Column:
    """Symbols in which two signatures differ, by bit operations on whole chunks."""
    low, high = 0x7F7F7F7F7F7F, 0x808080808080
    parts = []
    for i in range(CHUNKS):
        x = f"({a}[{i}] ^ {b}[{i}])"
        parts.append(f"bit_count(((({x} & {low}L) + {low}L) | {x}) & {high}L)")
    return F.expr(" + ".join(parts))


def first_shared(key: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the key that the symbols of x and y (rows) share is the first they share. A pair then comes from one bucket only."""
    place = key >> 48
    errors = (x[:, :SYMBOLS] != y[:, :SYMBOLS]).reshape(len(x), CHUNKS, WIDTH).sum(2)
    chunk = place // WIDTH
    return ((errors <= ERRORS).argmax(1) == chunk) & ((errors[np.arange(len(x)), chunk] > 0) | (place % WIDTH == 0))


def _across(percent: int, nearest: bool):
    """Of the rows of a bucket's two blocks, the pairs (a, b) of different components that may link, or of every row the ``nearest``
    such pair alone. Rows come sorted by bucket and blocks; a group may go on in the next Arrow batch, so the last of a batch waits for it."""

    def pairs(group: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        sides = [group[group["block"] == i], group[group["block"] == j]] if i != j else [group, group]
        if not len(sides[0]) or not len(sides[1]):
            return
        node, component, n = ([side[c].to_numpy() for side in sides] for c in ("node", "component", "n"))
        x, y = (np.frombuffer(b"".join(side["sketch"]), np.uint8).reshape(len(side), -1) for side in sides)
        bits_x, bits_y = (np.ascontiguousarray(z[:, SYMBOLS:]).view(np.uint64) for z in (x, y))
        key = group["key"].iloc[0]
        for row in range(len(x)):
            sizes = 100 * np.minimum(n[0][row], n[1]) >= percent * np.maximum(n[0][row], n[1])
            at = np.flatnonzero(sizes & (component[0][row] != component[1]))
            if i == j:
                at = at[at > row]
            if len(at):
                total = n[0][row] + n[1][at]
                shared = most_shared(n[0][row], bits_x[row], n[1][at], bits_y[at])
                near = [(shared / total).argmax()] if nearest else slice(None)
                at = at[near][((100 + percent) * shared >= percent * total)[near]]
            if len(at):
                other = y[at]
                first = first_shared(np.full(len(at), key), np.broadcast_to(x[row], other.shape), other)
                yield np.full(first.sum(), node[0][row]), node[1][at[first]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting = None
        for batch in batches:
            rows = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            ids = rows[["key", "i", "j"]].to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero((ids[1:] != ids[:-1]).any(1)) + 1]) if len(rows) else [0]
            found = [p for a, b in zip(cuts[:-1], cuts[1:], strict=True) for p in pairs(rows.iloc[a:b])]
            waiting = rows.iloc[cuts[-1] :]
            yield _as_pairs(found)
        if waiting is not None and len(waiting):
            yield _as_pairs(list(pairs(waiting)))

    return run


def _as_pairs(found: list) -> pd.DataFrame:
    empty = [np.empty(0, np.int64)]
    return pd.DataFrame({"a": np.concatenate([p for p, _ in found] or empty), "b": np.concatenate([q for _, q in found] or empty)})


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b) those with 100 * intersection >= percent * union. The set of ``a`` travels with the pair;
    that of ``b``, the side that may be shared by many, is only met in the join."""
    a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def near_duplicates(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Links hold between texts with 100 * intersection >= percent * union of their sets of ``words``-word shingles, A-Z in lower case,
    words split at ASCII white space. A component's smallest id stays. Null, empty and blank texts
    have empty sets and link with nothing; equal sets link. Rows with a null id link with nothing and are kept, with a null
    component. Rows that repeat an id are one node, with the links of all its texts. Other columns are not read.

    Equal sets become one representative first. Every bucket of the index then links its members to one of them, and each
    to its nearest in another component; confirmed links merge most copies. What remains is every pair of a bucket that lies in different components
    and whose sketches do not rule a link out: all are confirmed too, so no link that could join two components is left out.
    """
    scratch = Scratch(documents.sparkSession, "minhash")
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    signed = scratch.keep(
        rows.mapInPandas(
            _signatures(words), f"id {kind}, n_shingles long, digest binary, signature array<bigint>"
        )
    )
    used = signed.where("n_shingles > 0 AND id IS NOT NULL")
    classes = used.groupBy("digest").agg(
        F.min("id").alias("rep"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")
    )
    # Numbers of the classes, safe to use since the table is written: the index holds two longs a row.
    classes = scratch.keep(classes.withColumn("node", F.monotonically_increasing_id()))
    same = used.join(classes.select("digest", "rep"), "digest").where("id <> rep")
    same = same.select(F.col("id").alias("a"), F.col("rep").alias("b"))

    index = classes.select("node", F.explode(keys()).alias("key"))
    shared = index.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    found = scratch.keep(index.join(shared, "key"))

    wanted = found.select("node").distinct().join(classes.select("node", "rep", "digest"), "node")
    texts = rows.join(wanted, rows["id"] == wanted["rep"]).select("node", "digest", "text")
    sets = scratch.keep(texts.mapInPandas(_sets(words), "node long, shingles array<bigint>, sketch binary"))

    # The centre of a bucket is the member that meets most others over all its buckets: of an original and its changed copies, the original.
    met = found.groupBy("node").agg(F.sum("members").alias("met"))
    centres = found.join(met, "node").groupBy("key").agg(F.max(F.struct("met", "node"))["node"].alias("centre"))
    signatures = classes.select("node", "n", "signature")
    star = found.join(centres, "key").where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    star = scratch.keep(_near(star, signatures, percent))
    first = scratch.keep(_confirmed(star, sets, percent))
    links = first
    for nearest in (True, False):
        merged = scratch.keep(components(scratch, links).withColumnRenamed("node", "member"))
        rest = _open_buckets(found, merged, sets)
        across = scratch.keep(rest.mapInPandas(_across(percent, nearest), "a long, b long"))
        links = links.union(scratch.keep(_confirmed(across.distinct() if nearest else across, sets, percent)))

    # Components in terms of ids: a class is named by its smallest one.
    reps = classes.select("node", "rep")
    links = links.join(reps.withColumnRenamed("node", "a"), "a").select("b", F.col("rep").alias("x"))
    links = links.join(reps.withColumnRenamed("node", "b"), "b").select(F.col("x").alias("a"), F.col("rep").alias("b"))
    joined = scratch.keep(components(scratch, same.union(links)))
    scratch.only(signed, joined)
    out = signed.join(joined, signed["id"] == joined["node"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("component", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def _open_buckets(found: DataFrame, merged: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of the buckets whose members lie in more than one component, in blocks: every row meets each block of its bucket."""
    placed = found.join(merged, found["node"] == merged["member"], "left").select(
        "key", "node", "members", F.coalesce("component", "node").alias("component")
    )
    split = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    rest = placed.join(split.select("key"), "key", "left_semi").withColumn("block", F.pmod(F.xxhash64("node", "key"), blocks).cast("int"))
    rest = rest.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rest = rest.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    rest = rest.join(sets.select("node", F.size("shingles").alias("n"), "sketch"), "node").drop("members", "other")
    return rest.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _may_link(percent: int) -> Column:
    """Sizes that allow the similarity, and signatures near enough, of sides a and b."""
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return sizes & (distance("signature_a", "signature_b") <= FIRST)


def _near(pairs: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link."""
    for end in ("a", "b"):
        pairs = pairs.join(signatures.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"), F.col("signature").alias(f"signature_{end}")), end)
    return pairs.where(_may_link(percent)).select("a", "b")


def drop_near(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents`` that stay: one of each group of near copies, all columns as they are."""
    gone = near_duplicates(documents, id_col, text_col, words, percent).where("NOT kept")
    gone = gone.select(F.col(id_col).alias("_gone")).distinct()
    return documents.join(gone, documents[id_col] == gone["_gone"], "left_anti")
