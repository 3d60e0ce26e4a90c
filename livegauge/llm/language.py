"""Language of a text by hierarchical discrimination with linear support vector machines.

First the language family is predicted, then the language within it. Machines at both levels are one-versus-one
over hashed byte trigrams (A-Z in lower case, one space added on either side). All of them are linear in relative
frequencies, so one pass over the bytes of a text gives every margin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import slices

DIMENSIONS = 1 << 12
BLOCK = 400  # labelled rows of either side of a duel, on average, that one task learns from at a time
MERGED = 64  # weights of as many blocks are added up at a time
FIXED = 1 << 24  # weights are added up in whole parts of one in as many, so that their sum does not depend on the order
SURE_BY = 200  # learned texts at which the least score of a text in some language counts half
UNDECIDED = 0.3  # a text that a family's and a language's machines both leave undecided scores about a quarter; no text above this is taken for one of no language
SLICE = 1 << 20  # bytes of one text taken at a time, so that memory does not follow a text's length

# Families of ISO 639-1 codes. A code not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "semitic": "ar he mt am",
    "indic": "hi bn mr gu pa ur ne",
}

_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = regex.compile(r"\p{L}")


def has_letter(text: str | None) -> bool:
    return bool(text) and _LETTER.search(text) is not None


def _codes(data: np.ndarray) -> np.ndarray:
    """The hashed trigram that starts at each byte but the last two."""
    wide = data.astype(np.uint32)
    gram = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    return (gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - 12)


def _slices(text: str) -> Iterator[np.ndarray]:
    data = np.frombuffer(b" " + text.encode().lower() + b" ", np.uint8)
    for start in range(0, max(1, len(data) - 2), SLICE):
        yield data[start : start + SLICE + 2]


def margins(texts: list[str], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Margin of each machine (column) for each text: mean weight of its trigrams plus bias."""
    sums, counts = np.zeros((len(texts), len(weights))), np.zeros(len(texts))
    padded = np.hstack([weights, np.zeros((len(weights), 1))])  # the last entry stands for no trigram
    buffer: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        if not buffer:
            return
        lengths = np.array([len(b) for b in buffer])
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        codes = np.append(_codes(np.concatenate(buffer)), [DIMENSIONS] * 2).astype(np.intp)
        ends = starts + lengths
        codes[ends - 1] = codes[ends - 2] = DIMENSIONS  # those would reach into the next text
        for k in range(len(padded)):
            np.add.at(sums[:, k], owners, np.add.reduceat(padded[k][codes], starts))
        np.add.at(counts, owners, lengths - 2)
        buffer.clear()
        owners.clear()

    held = 0
    for i, text in enumerate(texts):
        for piece in _slices(text):
            buffer.append(piece)
            owners.append(i)
            held += len(piece)
            if held >= SLICE:
                flush()
                held = 0
    flush()
    return sums / np.maximum(counts, 1)[:, None] + bias


def _counted(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The bins of a text's trigrams, sorted, and how often it has each."""
    total = np.zeros(DIMENSIONS, np.int64)
    for piece in _slices(text):
        total += np.bincount(_codes(piece), minlength=DIMENSIONS)
    used = np.flatnonzero(total)
    return used, total[used]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The trigrams of each text, as bins and their counts in the smallest type that holds them."""
    for batch in slices(batches):
        bins, counts = [], []
        for text in batch.column("text"):
            used, found = _counted(text.as_py())
            bins.append(used.astype(np.uint16).tobytes())
            counts.append(found.astype(np.min_scalar_type(found.max())).tobytes())
        binary = [pa.array(x, pa.binary()) for x in (bins, counts)]
        yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("place"), *binary], ["lang", "place", "bins", "counts"])


def _shares(bins: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The bins of a text and their shares of its trigrams."""
    found = np.frombuffer(counts, f"u{2 * len(counts) // len(bins)}")
    return np.frombuffer(bins, np.uint16), found / found.sum()


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summed shares of each trigram in the texts of a language, in whole parts, and the number of texts as the bin behind the last."""
    sums: dict[str, np.ndarray] = {}

    def found() -> Iterator[pa.RecordBatch]:
        for lang, total in sums.items():
            used = np.flatnonzero(total)
            arrays = [pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["lang", "bin", "total"])
        sums.clear()

    for batch in slices(batches):
        for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
            total = sums.setdefault(lang.as_py(), np.zeros(DIMENSIONS + 1, np.int64))
            used, counts = _counted(text.as_py())
            total[used] += np.rint(counts / counts.sum() * FIXED).astype(np.int64)
            total[DIMENSIONS] += 1
        if len(sums) > MERGED:
            yield from found()
    yield from found()


def train_svm(
    x: np.ndarray, y: np.ndarray, strength: float = 1e-3, steps: int = 120, copies: np.ndarray | None = None
) -> tuple[np.ndarray, float]:
    """Linear support vector machine: squared hinge loss with L2 penalty, both classes weighing alike, by
    accelerated gradient steps. y is +1 or -1; rows count as often as their copies say, once by default. The last step's weights and bias."""
    copies = np.ones(len(y)) if copies is None else copies
    weight = copies * np.where(y > 0, 0.5 / max(1, copies[y > 0].sum()), 0.5 / max(1, copies[y < 0].sum()))
    rate = 1 / (2 * (np.einsum("ij,ij->i", x, x) + 1).max() + strength)
    w, b = np.zeros(x.shape[1]), 0.0
    pw, pb, t = w, b, 1.0
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ pw.astype(x.dtype) + pb)) * weight * y
        nw = pw + rate * (2 * (slack.astype(x.dtype) @ x) - strength * pw)
        nb = pb + rate * 2 * slack.sum()
        nt = (1 + math.sqrt(1 + 4 * t * t)) / 2
        pw, pb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


@dataclass
class LanguageModel:
    """Machines (level, positive name, negative name) with their weights; the families that training saw."""

    families: dict[str, list[str]]
    machines: list[tuple[str, str, str]]
    weights: np.ndarray
    bias: np.ndarray
    floor: float = 0.0  # texts that score less are in none of the languages, see ``calibrated``

    def _best(self, level: str, names: list[str], margin: np.ndarray) -> tuple[list[str], np.ndarray]:
        """By votes, then by summed margins, then the first by name. The score is the least certain duel of the winner."""
        n = len(margin)
        votes, total, least = (np.zeros((n, len(names))) for _ in range(3))
        least += 1
        for k, (where, a, b) in enumerate(self.machines):
            if where == level:
                i, j, m = names.index(a), names.index(b), margin[:, k]
                votes[:, i] += m >= 0
                votes[:, j] += m < 0
                total[:, i] += m
                total[:, j] -= m
                sure = 1 / (1 + np.exp(-np.clip(4 * m, -50, 50)))
                least[:, i] = np.minimum(least[:, i], sure)
                least[:, j] = np.minimum(least[:, j], 1 - sure)
        best = (votes + 1e-3 * np.tanh(total)).argmax(1)
        return [names[i] for i in best], least[np.arange(n), best]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """(language, score from 0 to 1) of each whole text; ``und`` and 0 without a letter, or if nothing was learned."""
        names, score = ["und"] * len(texts), np.zeros(len(texts))
        usable = [i for i, t in enumerate(texts) if has_letter(t)] if self.families else []
        if not usable:
            return names, score
        langs, sure = self.decide(margins([texts[i] for i in usable], self.weights, self.bias))
        for i, lang, s in zip(usable, langs, sure, strict=True):
            names[i], score[i] = lang, s
        return names, score

    def decide(self, margin: np.ndarray) -> tuple[list[str], np.ndarray]:
        """(language, score) for each row of margins: the family first, then the language within it; the score is the product of both."""
        family, sure = self._best("", sorted(self.families), margin)
        family = np.array(family, dtype=object)
        names, score = [""] * len(margin), np.zeros(len(margin))
        for name, members in self.families.items():
            at = np.flatnonzero(family == name)
            if len(at):
                langs, inner = self._best(name, members, margin[at])
                for k, lang, s in zip(at, langs, inner * sure[at], strict=True):
                    names[k], score[k] = lang, s
        return names, score


def calibrated(least: float, count: int) -> float:
    """The score below which a text is in none of the learned languages: a little less than the least that any of ``count`` learned texts gets, the less the
    fewer they are, for the least of few says little, and ``UNDECIDED`` at most."""
    return min(UNDECIDED, 0.95 * least * count / (count + SURE_BY))


def families_of(means: dict[str, np.ndarray]) -> dict[str, list[str]]:
    """The families and their languages, for languages with their mean vectors.

    Languages of no listed family are put into groups by the closeness of their vectors, about as many as the square root of their number, so that the number of duels stays
    far below all pairs. The first of each group is the language least like those before it; every other one joins the group whose
    first it is most like, of those that are not twice as large as the average yet.
    """
    families: dict[str, list[str]] = {}
    for lang in sorted(means):
        if lang in _FAMILY_OF:
            families.setdefault(_FAMILY_OF[lang], []).append(lang)
    own = sorted(lang for lang in means if lang not in _FAMILY_OF)
    if not own:
        return families
    x = np.array([means[lang] for lang in own])
    x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    groups = math.isqrt(len(own) - 1) + 1
    first = [0]
    like = x @ x[0]
    while len(first) < groups:
        like[first] = np.inf
        first.append(int(like.argmin()))
        like = np.maximum(like, x @ x[first[-1]])
    members = {f: [f] for f in first}
    likeness = x @ x[first].T
    for i in np.argsort(-likeness.max(1), kind="stable").tolist():
        if i not in members:
            open_ = [g for g, f in enumerate(first) if len(members[f]) < 2 * groups]
            members[first[max(open_, key=lambda g: (likeness[i, g], -g))]].append(i)
    for f, held in members.items():
        families.setdefault(own[f], []).extend(own[i] for i in held)
    return {family: sorted(langs) for family, langs in families.items()}


def _trained(batches: Iterator[pd.DataFrame], scale: np.ndarray) -> Iterator[pd.DataFrame]:
    """The machine that learns from one block of a duel, in whole parts; none if a side is missing. Equal rows are held once, with their number."""
    copies: dict[tuple, int] = {}
    duel = block = 0
    for batch in batches:
        duel, block = batch["duel"].iloc[0], batch["block"].iloc[0]
        for row in zip(batch["side"], batch["bins"], batch["counts"], strict=True):
            copies[row] = copies.get(row, 0) + 1
    rows = sorted(copies)
    y = np.array([side for side, *_ in rows], float)
    if (y > 0).any() and (y < 0).any():
        x = np.zeros((len(rows), DIMENSIONS), np.float32)
        for row, (_, bins, counts) in zip(x, rows, strict=True):
            used, share = _shares(bins, counts)
            row[used] = share * scale[used]
        w, b = train_svm(x, y, copies=np.array([copies[row] for row in rows], float))
        machine = np.rint(np.append(w * scale, b) * FIXED).astype(np.int64)
        yield pd.DataFrame({"duel": [duel], "block": [block], "machine": [machine.tobytes()], "blocks": [1]})


def _merged(machines: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(m, np.int64) for m in machines["machine"])
    return pd.DataFrame(
        {"duel": machines["duel"].iloc[:1], "block": machines["block"].iloc[:1], "machine": [total.tobytes()], "blocks": [machines["blocks"].sum()]}
    )


def _learned(found: DataFrame, sides: list[tuple], scale: np.ndarray) -> DataFrame:
    """(duel, machine, blocks): the summed machines of the blocks of each duel, and their number.

    ``found`` holds the trigrams of every row, ``sides`` (lang, duel, side, blocks, times) in how many of a duel's blocks a row of a language is. Blocks follow
    from the rows' ``place`` alone. What a task holds at a time is one block.
    """
    spark = found.sparkSession
    # One row for each language and its duels may be broadcast.
    part = F.broadcast(spark.createDataFrame(sides, "lang string, duel int, side int, of long, times long"))
    rows = found.join(part, "lang").withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    rows = rows.select("duel", F.expr("pmod(pmod(place, of) + nth, of)").alias("block"), "side", "bins", "counts")
    of = {duel: blocks for _, duel, _, blocks, _ in sides}
    # A task takes a few blocks, however many there are.
    tasks = max(min(sum(of.values()), 4 * spark.sparkContext.defaultParallelism), sum(of.values()) // 4)

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _trained(batches, scale)

    schema = "duel int, block long, machine binary, blocks long"
    machines = rows.repartition(tasks, "duel", "block").groupBy("duel", "block").applyInPandas(train, schema)
    left = max(of.values())
    while left > 1:
        left = -(-left // MERGED)
        machines = machines.withColumn("block", F.expr(f"block div {MERGED}")).groupBy("duel", "block").applyInPandas(_merged, schema)
    return machines.select("duel", "machine", "blocks")


def train_language_model(rows: DataFrame, per_language: int = BLOCK, floor: bool = True) -> LanguageModel:
    """Learn from all of ``rows`` (id, text, lang).

    Every language is learned, see ``families_of``. Texts that tie in votes go to the larger sum of margins, then to the first by name. Rows with a null language or no letter in the text teach nothing.
    A duel's rows are dealt to blocks by a hash of id and text, about ``per_language`` of either side to each; where a side is so rare that it would have less than a quarter of that
    in a block, its rows are in several, each in as many. Every block teaches one machine, and the duel's machine is their mean, so each row has its part in it, whatever their
    number. Blocks and sums do not depend on how the rows lie. With ``floor`` the model's floor is set, from the scores of all these texts.
    Only summed frequencies of each language and the machines come to the driver.
    """
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("place", F.xxhash64("id", "text"))
    rows = rows.select("lang", "place", "text")
    totals = rows.mapInArrow(_totals, "lang string, bin int, total long").groupBy("lang", "bin").agg(F.sum("total").alias("total")).toPandas()
    if not len(totals):
        return LanguageModel({}, [], np.zeros((0, DIMENSIONS)), np.zeros(0))
    sums = {lang: np.zeros(DIMENSIONS + 1) for lang in sorted(set(totals["lang"]))}
    for lang, part in totals.groupby("lang"):
        sums[lang][part["bin"]] = part["total"]
    texts = {lang: int(total[DIMENSIONS]) for lang, total in sums.items()}
    total = sum(sums.values())[:DIMENSIONS] / FIXED
    scale = 1 / np.sqrt(total / sum(texts.values()) + 1e-6)  # frequent trigrams would outweigh the rest
    families = families_of({lang: found[:DIMENSIONS] * scale for lang, found in sums.items()})
    duels = [("", a, b) for a, b in combinations(sorted(families), 2)]
    duels += [(f, a, b) for f, members in families.items() for a, b in combinations(members, 2)]
    sides = []
    for k, (level, *names) in enumerate(duels):
        members = [[name] if level else families[name] for name in names]
        counts = [sum(texts[lang] for lang in langs) for langs in members]
        blocks = max(1, round(sum(counts) / (2 * per_language)))
        for side, langs, count in zip((1, -1), members, counts, strict=True):
            times = min(blocks, math.ceil(blocks * per_language / 4 / count))
            sides += [(lang, k, side, blocks, times) for lang in langs]
    weights, bias = np.zeros((len(duels), DIMENSIONS)), np.zeros(len(duels))
    if duels:
        found = rows.mapInArrow(_frequencies, "lang string, place long, bins binary, counts binary")
        for k, machine, blocks in _learned(found, sides, scale).toPandas().itertuples(index=False):
            mean = np.frombuffer(machine, np.int64) / (FIXED * blocks)
            weights[k], bias[k] = mean[:-1], mean[-1]
    model = LanguageModel(families, duels, weights, bias)
    if floor:
        model.floor = calibrated(*_least(rows, model))
    return model


def _least(rows: DataFrame, model: LanguageModel) -> tuple[float, int]:
    """The least score of all texts, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, score = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_pydict({"least": [float(score.min())], "texts": [len(score)]})

    return tuple(rows.select("text").mapInArrow(run, "least double, texts long").agg(F.min("least"), F.sum("texts")).first())


def predict_languages(documents: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score. Only the text is looked at, from its first to its last byte.

    A null text, or one without a letter, is ``und`` with score 0. Repeated rows give repeated rows; an empty table gives none.
    """
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            names, score = model.predict(list(batch["text"]))
            yield pd.DataFrame({"id": batch["id"], "lang_pred": names, "score": score})

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, lang_pred string, score double").withColumnRenamed("id", id_col)


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(by))


def identify(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Train on the rows whose ``remainder`` by 5 is not 0 (null ids are not trained on), then predict every row:
    id, held_out, lang_pred, score. held_out is null for a null id."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train_language_model(rows.where(remainder("id", 5) != 0), floor=False)
    found = predict_languages(documents, model, id_col, text_col)
    return found.select(id_col, (remainder(id_col, 5) == 0).alias("held_out"), "lang_pred", "score")


def keep_known(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``documents`` in one of the languages learned from their labelled rows, all columns as they are: those whose text has a letter and scores at least
    the model's floor. Trained as :func:`identify` is; without a label to learn from the letter alone decides."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    model = train_language_model(rows.where(remainder("id", 5) != 0))
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(place).to_pylist()
            names, score = model.predict(texts)
            if model.families:
                kept = [name != "und" and s >= model.floor for name, s in zip(names, score, strict=True)]
            else:
                kept = [has_letter(text) for text in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
