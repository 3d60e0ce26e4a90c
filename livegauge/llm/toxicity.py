"""Toxicity by non-negative positive-unlabelled learning.

Only confirmed toxic texts carry a label; all other texts count as unlabelled. A logistic model over the words of a text and
the first letters of its words is fitted to the class-prior-corrected risk

    prior * loss(toxic, +1) + max(0, loss(unlabelled, -1) - prior * loss(toxic, -1))

whose second term estimates the loss on clean text and must not turn negative: where it does, the step undoes that
instead (Kiryo and others, 2017).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import slices
from livegauge.llm.language import remainder

TOXIC_SAMPLE, UNLABELLED_SAMPLE = 2_000, 6_000  # texts that training reads, at most
DEVIATIONS = 4  # how surely toxic texts must have a feature more often than unlabelled ones
PREFIX = 4
THRESHOLD = 0.7

_WORD = re.compile(r"[^\W_]+")
_SPAN = 1 << 20


def _words(text: str) -> set[str]:
    """Distinct words of the whole text. A long text is read in spans that end at a space where there is one."""
    if len(text) <= _SPAN:
        return set(_WORD.findall(text.lower()))
    found, start = set(), 0
    while start < len(text):
        end = text.find(" ", start + _SPAN)
        end = len(text) if end < 0 else end
        found.update(_WORD.findall(text[start:end].lower()))
        start = end
    return found


def features(text: str | None) -> np.ndarray:
    """Hashes of the distinct words and of the distinct word beginnings of ``PREFIX`` letters."""
    words = _words(text or "")
    named = [w.encode() for w in words]
    named += [b"^" + p.encode() for p in {w[:PREFIX] for w in words if len(w) > PREFIX}]
    return np.fromiter(map(xxhash.xxh3_64_intdigest, named), np.uint64, len(named))


def _feature_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in slices(batches):
        yield pd.DataFrame(
            {"toxic": batch["toxic"], "copies": batch["copies"], "features": [np.sort(features(t)).tobytes() for t in batch["text"]]}
        )


class _Rows:
    """Texts as lists of known features."""

    def __init__(self, found: list[np.ndarray], known: np.ndarray):
        self.lengths = np.array([len(f) for f in found], dtype=np.intp)
        every = np.concatenate(found) if found else np.empty(0, np.uint64)
        at = np.minimum(np.searchsorted(known, every), max(0, len(known) - 1))
        hit = known[at] == every if len(known) else np.zeros(len(every), bool)
        self.feature = at[hit]
        self.row = np.repeat(np.arange(len(found)), self.lengths)[hit]
        self.count = len(found)

    def score(self, weights: np.ndarray, bias: float) -> np.ndarray:
        return np.bincount(self.row, weights[self.feature], self.count) + bias

    def gradient(self, slope: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(self.feature, slope[self.row], size)


@dataclass
class ToxicityModel:
    known: np.ndarray
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Probability of toxic for each whole text; an empty or null one gets the score of a text without known words."""
        z = _Rows([features(t) for t in texts], self.known).score(self.weights, self.bias)
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _uses(found: list[np.ndarray], copies: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct features, sorted, and the number of rows that have each."""
    names, at = np.unique(np.concatenate(found), return_inverse=True)
    return names, np.bincount(at, np.repeat(copies, [len(f) for f in found]), len(names))


def telling_features(
    toxic: list[np.ndarray], unlabelled: list[np.ndarray], toxic_copies: np.ndarray | None = None, unlabelled_copies: np.ndarray | None = None
) -> np.ndarray:
    """The features, sorted, that toxic texts have more often than unlabelled ones, by ``DEVIATIONS`` standard deviations of what
    chance would give. A part of the unlabelled texts is toxic too, so a toxic word is enriched by 1 / prior at most: how much more
    often is left to the risk. Texts count once each, or as often as their copies say. The samples bound the number of features."""
    toxic_copies = np.ones(len(toxic)) if toxic_copies is None else toxic_copies
    unlabelled_copies = np.ones(len(unlabelled)) if unlabelled_copies is None else unlabelled_copies
    names, uses = _uses(toxic, toxic_copies)
    others, other_uses = _uses(unlabelled, unlabelled_copies)
    at = np.minimum(np.searchsorted(others, names), max(0, len(others) - 1))
    seen = np.where(others[at] == names, other_uses[at], 0) if len(others) else np.zeros(len(names))
    n, total = toxic_copies.sum(), unlabelled_copies.sum()
    chance = n * seen / total
    telling = uses - chance >= DEVIATIONS * np.sqrt(chance * (1 - seen / total) * (1 + n / total) + 1)
    return names[telling]


def fit(
    toxic: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, steps: int = 300, l2: float = 2e-5,
    toxic_copies: np.ndarray | None = None, unlabelled_copies: np.ndarray | None = None,
) -> ToxicityModel:
    """The model of least non-negative risk, by Adam over whole samples. Texts weigh the same; only where they are too few for any
    feature to tell, as when all toxic rows are copies of one text, the numbers of their copies choose the features."""
    if not toxic or not unlabelled:
        return ToxicityModel(np.empty(0, np.uint64), np.empty(0), -5.0)
    known = telling_features(toxic, unlabelled)
    if not len(known):
        known = telling_features(toxic, unlabelled, toxic_copies, unlabelled_copies)
    p, u = _Rows(toxic, known), _Rows(unlabelled, known)
    prior = min(max(prior, 1e-3), 0.999)
    w, b = np.zeros(len(known)), np.log(prior / (1 - prior))
    m, v = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, steps + 1):
        zp, zu = p.score(w, b), u.score(w, b)
        sp, su = (1 / (1 + np.exp(-np.clip(z, -500, 500))) for z in (zp, zu))
        clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        on_p, on_u = -prior * sp / p.count, su / u.count  # slopes of the clean risk
        if clean >= 0:
            on_p = on_p - prior * (1 - sp) / p.count
        else:
            on_p, on_u = -on_p, -on_u
        g = np.append(p.gradient(on_p, len(w)) + u.gradient(on_u, len(w)) + l2 * w, on_p.sum() + on_u.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return ToxicityModel(known, w, b)


def train_toxicity(rows: DataFrame, labels: DataFrame, toxic_sample: int = TOXIC_SAMPLE, unlabelled_sample: int = UNLABELLED_SAMPLE) -> ToxicityModel:
    """Learn from ``rows`` (id, text) and ``labels`` (id, toxic).

    Equal texts are one text, so that copies neither fill a sample nor shift the prior, the share of toxic among the labelled texts of
    ``rows``. At most ``toxic_sample`` toxic and ``unlabelled_sample`` other texts are read, picked by a hash of the text; only their features
    come to the driver. Ids with a null label are not labelled; an id or text labelled both ways is toxic. Without a toxic text every
    score is the same, near 0.
    """
    known = labels.where("id IS NOT NULL AND toxic IS NOT NULL").groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL").withColumn("digest", F.xxhash64("text"))
    texts = rows.select("id", "digest")
    picked = [F.min("id").alias("id"), F.count("*").alias("copies")]
    labelled = texts.join(known, "id").groupBy("digest").agg(F.max("toxic").alias("toxic"), *picked)
    prior = labelled.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not prior:
        return fit([], [], 0)
    place = F.pmod(F.col("digest"), F.lit(1 << 30))
    positive = labelled.where("toxic = 1").orderBy(place, "digest").limit(toxic_sample).select("digest", "toxic", "id", "copies")
    # The count only bounds what is sorted, so it may be off by some hundredths.
    count = texts.agg(F.approx_count_distinct("digest", 0.02)).first()[0]
    bound = min(1 << 30, int(1.5 * unlabelled_sample / count * (1 << 30)) + 1)
    other = texts.where(place < bound).groupBy("digest").agg(F.lit(0).alias("toxic"), *picked)
    other = other.orderBy(place, "digest").limit(unlabelled_sample)
    # Both samples are bounded by their parameters, so they may be broadcast.
    wanted = positive.union(other.select(*positive.columns))
    one = rows.join(F.broadcast(wanted), ["digest", "id"]).groupBy("digest", "toxic").agg(F.first("copies").alias("copies"), F.min("text").alias("text"))
    found = one.select("toxic", "copies", "text").mapInPandas(_feature_rows, "toxic int, copies long, features binary").toPandas()
    found = found.sort_values(["toxic", "features", "copies"])
    parts = {t: found[found["toxic"] == t] for t in (0, 1)}
    split = {t: [np.frombuffer(f, np.uint64) for f in part["features"]] for t, part in parts.items()}
    copies = {t: part["copies"].to_numpy(float) for t, part in parts.items()}
    return fit(split[1], split[0], prior, toxic_copies=copies[1], unlabelled_copies=copies[0])


def score_toxicity(documents: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: id, score, predicted. Only the text is looked at, all of it; null counts as empty.
    Repeated rows give repeated rows; an empty table gives none."""
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in slices(batches):
            score = model.scores(list(batch["text"]))
            yield pd.DataFrame({"id": batch["id"], "score": score, "predicted": (score >= threshold).astype(np.int32)})

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInPandas(run, f"id {kind}, score double, predicted int").withColumnRenamed("id", id_col)


def _trained(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> ToxicityModel:
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    known = labels.select(F.col(id_col).alias("id"), F.col("toxic"))
    learn = remainder("id", 3) != 1
    return train_toxicity(rows.where(learn), known.where(learn))


def rate(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on ids whose ``remainder`` by 3 is not 1 (null ids are not trained on), then score every row: id, held_out, score, predicted. held_out is null for a
    null id. A text's score follows from its own words alone, so equal texts have equal scores."""
    scored = score_toxicity(documents, _trained(documents, labels, id_col, text_col), id_col, text_col)
    return scored.select(id_col, (remainder(id_col, 3) == 1).alias("held_out"), "score", "predicted")


def keep_clean(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``documents`` that score below the threshold, each kept or not where it is read, all columns as they are."""
    model = _trained(documents, labels, id_col, text_col)
    place = documents.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(model.scores(batch.column(place).to_pylist()) < threshold))

    return documents.mapInArrow(run, documents.schema)
