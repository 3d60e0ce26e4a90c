"""SentencePiece encoding and decoding as a relational lattice.

The pieces are a table. Text is cut into words at places no piece spans; the substrings of every distinct word, as long as the longest piece at most, are
exploded and joined with the pieces by equality. The joined rows are the edges of the word's lattice; grouped by word, they are folded by
a higher-order aggregate into one path:

* unigram vocabularies: Viterbi, the path of the largest sum of scores;
* byte-pair vocabularies: the path that merging leads to. Their scores are ranks of merges, and the path of the largest sum is another one than
  SentencePiece's. Edges taken in order of rank, then from the left, each merge the two parts they span if just two
  are left there, which gives SentencePiece's own ids.

Characters without a piece become their UTF-8 bytes' pieces. A run of characters without a space that is longer than ``LATTICE_CHARS`` would
be a lattice too large for a row, and in runs of spaces the given vocabulary's ranks are not in the order of merges; for such words the path is
found where they stand, by ``PlainWords``.

The lattice holds every distinct word once. Documents are cut into words once and stored as bundles of word numbers; a bundle sends its distinct words, packed by the slot
that a word's checksum falls into, and gets back, packed in the same order, their ids. A word that is in every bundle is thus one word
in one lattice, and neither words nor ids travel as rows of their own.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch
from livegauge.llm.files import opened, own_name
from livegauge.storage import new_path

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
LATTICE_CHARS = 64  # words up to this length go through the lattice, whose fold holds a word's edges in one row
BUNDLE_CHARS = 24 << 20  # text of one bundle; a longer text is a bundle of its own
SLOTS = 8  # slots for each bundle, over which its words are spread: their edges are some hundred times as large
MOST_SLOTS = 100_000


@dataclass(frozen=True)
class Pieces:
    """A vocabulary: piece texts with ids and scores, ids of the 256 byte pieces, and its kind."""

    texts: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    unknown: int
    unigram: bool

    def table(self, spark: SparkSession) -> DataFrame:
        """(piece, id, score, rank): lower ranks merge first, equal scores share a rank."""
        order = {s: k for k, s in enumerate(sorted(set(self.scores), reverse=True))}
        rows = list(zip(self.texts, self.ids, self.scores, (order[s] for s in self.scores), strict=True))
        return spark.createDataFrame(pd.DataFrame(rows, columns=["piece", "id", "score", "rank"]), "piece string, id int, score double, rank int")

    @property
    def longest(self) -> int:
        return max(map(len, self.texts))

    @property
    def characters(self) -> str:
        return "".join(sorted({t for t in self.texts if len(t) == 1} - {SPACE}))

    def classes(self) -> list[str]:
        """The characters in classes that no piece mixes, the largest first; the last one holds those that stand beside no other character in any piece."""
        up = {c: c for c in self.characters}

        def of(c: str) -> str:
            while up[c] != c:
                up[c] = c = up[up[c]]
            return c

        paired = set()
        for text in self.texts:
            for a, b in zip(text, text[1:]):
                if SPACE not in (a, b):
                    paired |= {a, b}
                    up[of(a)] = of(b)
        found: dict[str, list[str]] = {}
        for c in self.characters:
            found.setdefault(of(c) if c in paired else "", []).append(c)
        alone = "".join(found.pop("", []))
        return [*sorted(map("".join, found.values()), key=lambda cs: (-len(cs), cs)), alone]

    def unordered(self) -> tuple[str, ...]:
        """The pieces of a byte-pair vocabulary that no two pieces of earlier rank make up, without those that contain another one. Rank order is not
        the order of merges in a word that holds one."""
        if self.unigram:
            return ()
        rank = {t: -s if len(t) > 1 else float("-inf") for t, s in zip(self.texts, self.scores, strict=True)}
        late = float("inf")
        made = {
            t: min((max(rank.get(t[:k], late), rank.get(t[k:], late)) for k in range(1, len(t))), default=float("-inf"))
            for t in self.texts
        }
        found = sorted((t for t in self.texts if len(t) > 1 and made[t] >= rank[t]), key=len)
        return tuple(t for k, t in enumerate(found) if not any(u in t for u in found[:k]))


def load_pieces(path: str | None = None) -> Pieces:
    """A model file's vocabulary. Only models that leave the text as it is, with spaces escaped and one put in front, are taken, and none whose
    pieces hold a space after another character: words could not be cut there."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path or public_tokenizers.path(MODEL), "rb") as file:
        model.ParseFromString(file.read())
    rule = model.normalizer_spec
    if rule.precompiled_charsmap or rule.remove_extra_whitespaces or not (rule.add_dummy_prefix and rule.escape_whitespaces):
        raise ValueError("the model changes the text before encoding it")
    normal = [(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type == 1]
    if any(re.search(f"[^{SPACE}]{SPACE}", text) for text, _, _ in normal):
        raise ValueError("a piece spans words")
    byte_ids = tuple(i for i, p in enumerate(model.pieces) if p.type == 6)
    texts, ids, scores = zip(*normal, strict=True)
    return Pieces(texts, ids, scores, byte_ids, model.trainer_spec.unk_id, model.trainer_spec.model_type == 1)


class Words:
    """Cuts escaped text into words: spaces and the known characters of one class behind them, or one unknown character. No piece spans two words."""

    def __init__(self, pieces: Pieces):
        *classes, alone = pieces.classes()
        known = "|".join([*(f"[{re.escape(c)}]+" for c in classes), *([f"[{re.escape(alone)}]"] if alone else [])])
        self._word = re.compile(f"{SPACE}*(?:{known})|{SPACE}+|[^{SPACE}]")
        self._known = frozenset(pieces.characters + SPACE)
        self._bytes, self._unknown = pieces.byte_ids, pieces.unknown
        self._unordered = re.compile("|".join(map(re.escape, pieces.unordered())) or "(?!)")

    def of(self, text: str | None) -> list[str]:
        """The words of a whole text; none for an empty one."""
        return self._word.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def is_unknown(self, word: str) -> bool:
        return len(word) == 1 and word not in self._known

    def fits_lattice(self, word: str) -> bool:
        return len(word) <= LATTICE_CHARS and not self.is_unknown(word) and not self._unordered.search(word)

    def unknown_ids(self, word: str) -> list[int]:
        return [self._bytes[b] for b in word.encode()] if self._bytes else [self._unknown]


class PlainWords:
    """The ids of any word, one at a time: by merging or by Viterbi as the vocabulary asks for."""

    def __init__(self, pieces: Pieces):
        self._pieces = {t: (i, s) for t, i, s in zip(pieces.texts, pieces.ids, pieces.scores, strict=True)}
        self._longest, self._unigram = pieces.longest, pieces.unigram

    def ids(self, word: str) -> list[int]:
        return self._best(word) if self._unigram else self._merged(word)

    def _best(self, word: str) -> list[int]:
        best: list[tuple[float, int] | None] = [(0.0, 0)] + [None] * len(word)
        for stop in range(1, len(word) + 1):
            for start in range(max(0, stop - self._longest), stop):
                found = self._pieces.get(word[start:stop])
                if found and best[start] and (best[stop] is None or best[start][0] + found[1] > best[stop][0]):
                    best[stop] = (best[start][0] + found[1], start)
        ids, stop = [], len(word)
        while stop:
            start = best[stop][1]
            ids.append(self._pieces[word[start:stop]][0])
            stop = start
        return ids[::-1]

    def _merged(self, word: str) -> list[int]:
        n = len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # neighbours of the part that starts at a place
        gone, queue = [False] * n, []

        def offer(start: int) -> None:
            middle = after[start]
            if middle < n:
                found = self._pieces.get(word[start : after[middle]])
                if found:
                    heapq.heappush(queue, (-found[1], start, middle, after[middle]))

        for start in range(n - 1):
            offer(start)
        while queue:
            _, start, middle, stop = heapq.heappop(queue)
            if gone[start] or after[start] != middle or after[middle] != stop:
                continue
            gone[middle], after[start] = True, stop
            if stop < n:
                before[stop] = start
            offer(start)
            if before[start] >= 0:
                offer(before[start])
        ids, start = [], 0
        while start < n:
            ids.append(self._pieces[word[start : after[start]]][0])
            start = after[start]
        return ids


def lattice(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """The edges (word and any other columns of ``words``, start, stop, id, score, rank) of every word's lattice. The pieces are a vocabulary of fixed size and are
    broadcast; ``words`` keeps its partitioning, so that grouping by word needs no further shuffle."""
    size = F.length("word")
    spans = words.withColumn("start", F.explode(F.sequence(F.lit(0), size - 1)))
    spans = spans.withColumn("stop", F.explode(F.sequence(F.col("start") + 1, F.least(size, F.col("start") + longest))))
    text = F.col("word").substr(F.col("start") + 1, F.col("stop") - F.col("start"))
    return spans.withColumn("piece", text).join(F.broadcast(pieces), "piece").drop("piece")


# Fold over edges by end: for every place of the word the best (score, start, id) that reaches it. A place not reached has a null score.
_VITERBI = """
    aggregate(
      array_sort(edges, (x, y) -> CASE WHEN x.stop <> y.stop THEN x.stop - y.stop ELSE y.start - x.start END),
      transform(sequence(0, length(word)), i -> named_struct('score', IF(i = 0, 0D, CAST(NULL AS DOUBLE)), 'start', -1, 'id', -1)),
      (best, e) -> IF(best[e.start].score IS NOT NULL
                      AND (best[e.stop].score IS NULL OR best[e.start].score + e.score > best[e.stop].score),
                      transform(best, (b, i) -> IF(i = e.stop,
                                named_struct('score', best[e.start].score + e.score, 'start', e.start, 'id', e.id), b)),
                      best))
"""
_VITERBI_PATH = """
    reverse(aggregate(
      reverse(sequence(1, length(word))),
      named_struct('at', length(word), 'ids', CAST(array() AS array<int>)),
      (s, i) -> IF(i = s.at, named_struct('at', best[i].start, 'ids', array_append(s.ids, best[i].id)), s)).ids)
"""
# Fold over edges in their order, by rank and start: ``cuts`` has a character for every place, 1 where two parts meet.
_MERGED = """
    aggregate(
      filter(edges, e -> e.stop - e.start > 1),
      repeat('1', length(word) + 1),
      (cuts, e) -> IF(substr(cuts, e.start + 1, 1) = '1' AND substr(cuts, e.stop + 1, 1) = '1'
                      AND length(replace(substr(cuts, e.start + 2, e.stop - e.start - 1), '0', '')) = 1,
                      concat(substr(cuts, 1, e.start + 1), repeat('0', e.stop - e.start - 1), substr(cuts, e.stop + 1)),
                      cuts))
"""
_MERGED_PATH = """
    transform(
      sort_array(transform(filter(edges, e -> substr(cuts, e.start + 1, 1) = '1' AND substr(cuts, e.stop + 1, 1) = '1'
                                              AND instr(substr(cuts, e.start + 2, e.stop - e.start - 1), '1') = 0),
                           e -> named_struct('start', e.start, 'id', e.id))),
      e -> e.id)
"""


def encode_words(words: DataFrame, pieces: DataFrame, longest: int, unigram: bool) -> DataFrame:
    """Each row of ``words`` (word, and other columns) with its ``ids``. Rows must be distinct, and words fit the lattice
    (``Words.fits_lattice``)."""
    others = [c for c in words.columns if c != "word"]
    edge = F.struct("start", "stop", "id", "score") if unigram else F.struct("rank", "start", "stop", "id")
    grouped = lattice(words, pieces, longest).groupBy(*others, "word").agg(F.sort_array(F.collect_list(edge)).alias("edges"))
    state, name, path = (_VITERBI, "best", _VITERBI_PATH) if unigram else (_MERGED, "cuts", _MERGED_PATH)
    return grouped.withColumn(name, F.expr(state)).select("word", F.expr(path).alias("ids"), *others)


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def _bundles(folder: str, limit: int, words_of: Words):
    """Cuts documents into words and stores them in bundles: files of the documents' ids and numbers of words, of the numbers of these words, and
    of the bundle's different words, each with its checksum and whether the lattice takes it. Returns the bundles' numbers and paths."""

    def store(path: str, table: pa.Table) -> None:
        with opened(path, "write") as file, pa.ipc.new_file(file, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size, number, partition = [], [], 0, 0, TaskContext.get().partitionId()
        numbers, lengths = _Numbers(), []

        def flush() -> pa.RecordBatch:
            nonlocal ids, texts, size, number, numbers, lengths
            path, words = own_name(folder, number, ".arrow"), list(numbers)
            store(path, pa.table({"id": pa.chunked_array(ids), "n_words": pa.array(lengths, pa.int64(), mask=np.array(lengths) < 0)}))
            with opened(f"{path}.numbers", "write") as file:
                file.write(_squeezed(np.concatenate([np.zeros(0, "<u4"), *texts])))
            store(
                f"{path}.words",
                pa.table({
                    "word": pa.array(words, pa.large_string()),
                    "sum": pa.array([zlib.crc32(w.encode()) for w in words], pa.uint32()),
                    "fits": pa.array([words_of.fits_lattice(w) for w in words], pa.bool_()),
                }),
            )
            ids, texts, size, numbers, lengths, number = [], [], 0, _Numbers(), [], number + 1
            return pa.record_batch({"bundle": pa.array([(partition << 32) + number], pa.int64()), "path": [path]})

        for batch in batches:
            start = 0
            for i in range(len(batch)):
                text = batch.column(1)[i].as_py()
                found = words_of.of(text)
                texts.append(np.fromiter(map(numbers.__getitem__, found), "<u4", len(found)))
                lengths.append(-1 if text is None else len(found))
                size += len(text or "")
                if size >= limit:
                    ids.append(batch.column(0).slice(start, i + 1 - start))
                    start = i + 1
                    yield flush()
            if start < len(batch):
                ids.append(batch.column(0).slice(start))
        if ids:
            yield flush()

    return run


def _squeezed(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers: all their lowest bytes first, then the next ones, which are mostly alike."""
    return zstandard.ZstdCompressor(level=3).compress(numbers.astype("<u4").view("u1").reshape(-1, 4).T.tobytes())


def _expanded(data: bytes) -> np.ndarray:
    plain = zstandard.ZstdDecompressor().decompress(data)
    return np.ascontiguousarray(np.frombuffer(plain, "u1").reshape(4, -1).T).view("<u4").reshape(-1)


def _read(path: str) -> pa.Table:
    with opened(path, "read") as file:
        return pa.ipc.open_file(file).read_all()


def _in_slots(known: pa.Table, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, slots) of the bundle's words that the lattice takes, in the order in which they are sent and their ids come back."""
    numbers = np.flatnonzero(known["fits"].to_numpy())
    slot = known["sum"].to_numpy()[numbers].astype(np.int64) % slots
    order = np.argsort(slot, kind="stable")
    return numbers[order], slot[order]


def _send(slots: int):
    """The words of each bundle, packed by slot. A word that the lattice takes holds no line break."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for bundle, path in zip(batch["bundle"], batch["path"], strict=True):
                known = _read(f"{path}.words")
                numbers, slot = _in_slots(known, slots)
                words = known["word"].take(pa.array(numbers)).to_pylist()
                starts = np.flatnonzero(np.diff(slot, prepend=-1))
                packed = ["\n".join(words[a:b]) for a, b in zip(starts, [*starts[1:], len(words)], strict=True)]
                yield pd.DataFrame({"slot": slot[starts], "bundle": bundle, "words": packed})

    return run


def _answer(encoded: pd.DataFrame, uses: pd.DataFrame) -> pd.DataFrame:
    """The ids of the words that each bundle sent to a slot, in their order: for each word their number, then the ids of all."""
    place = {w: i for i, w in enumerate(encoded["word"])}
    ids = [np.asarray(x, "<u4") for x in encoded["ids"]]
    lengths = np.array([len(x) for x in ids], "<u4")
    flat, starts = np.concatenate([np.zeros(0, "<u4"), *ids]), np.cumsum(lengths, dtype=np.int64) - lengths
    packed = []
    for words in uses["words"]:
        try:
            at = np.array([place[w] for w in words.split("\n")], np.int64)
        except KeyError as lost:
            raise RuntimeError(f"the lattice did not deliver the word {lost}") from None
        chosen = flat[_ranges(starts[at], lengths[at])]
        packed.append(_squeezed(np.concatenate([lengths[at], chosen])))
    return pd.DataFrame({"bundle": uses["bundle"], "slot": uses["slot"], "ids": packed})


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places from each start on, as many as its length."""
    ends = np.cumsum(lengths, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


def _encoded(documents: DataFrame, pieces: Pieces, finish, schema: str, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: id and what ``finish`` makes of the ids of all texts of a bundle (a list of arrays, None for a null text)."""
    spark = documents.sparkSession
    kind = documents.schema[id_col].dataType.simpleString()
    folder, words_of = new_path(spark, "sentencepiece"), Words(pieces)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    bundles = Scratch(spark, "bundles").keep(rows.mapInArrow(_bundles(folder, BUNDLE_CHARS, words_of), "bundle long, path string"))
    count = bundles.count()
    slots = max(1, min(SLOTS * count, MOST_SLOTS))

    # Numbers of partitions that adaptive execution leaves as they are: what it sees is a small part of the work.
    sent = bundles.repartition(max(1, min(count, 10_000))).mapInPandas(_send(slots), "slot long, bundle long, words string")
    sent = sent.repartition(slots, "slot")
    # The least bundle is asked for so that both readers of what was sent want the same columns, and share one shuffle.
    words = sent.select(F.col("slot").alias("at"), "bundle", F.explode(F.split("words", "\n")).alias("word"))
    distinct = words.groupBy("at", "word").agg(F.min("bundle").alias("bundle")).where("bundle IS NOT NULL").select("at", "word")
    encoded = encode_words(distinct, pieces.table(spark), pieces.longest, pieces.unigram)
    answers = encoded.groupBy("at").cogroup(sent.groupBy("slot")).applyInPandas(_answer, "bundle long, slot long, ids binary")
    # One row more for each bundle, with its path; a bundle without a word for the lattice still has its documents.
    answers = answers.withColumn("path", F.lit(None).cast("string"))
    asked = bundles.select("bundle", F.lit(-1).cast("long").alias("slot"), F.lit(None).cast("binary").alias("ids"), "path")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("slot")
        path = group["path"].iloc[0]
        known, table, plain_words = _read(f"{path}.words"), _read(path), PlainWords(pieces)
        numbers, slot = _in_slots(known, slots)
        if set(group["slot"].iloc[1:]) != set(slot.tolist()):
            raise RuntimeError("the lattice did not deliver all words of a bundle")
        counts = np.bincount(np.searchsorted(group["slot"].to_numpy()[1:], slot), minlength=len(group) - 1)
        lengths, ids = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for data, n in zip(group["ids"].iloc[1:], counts, strict=True):
            answer = _expanded(data)
            lengths.append(answer[:n])
            ids.append(answer[n:])
        others = np.flatnonzero(~known["fits"].to_numpy())
        plain = [
            np.array(words_of.unknown_ids(w) if words_of.is_unknown(w) else plain_words.ids(w), "<u4")
            for w in known["word"].take(pa.array(others)).to_pylist()
        ]
        size = np.zeros(len(known), np.int64)
        size[numbers], size[others] = np.concatenate(lengths), [len(x) for x in plain]
        flat, first = np.concatenate([*ids, *plain]), np.zeros(len(known), np.int64)
        arrived = np.concatenate([numbers, others])
        first[arrived] = np.cumsum(size[arrived]) - size[arrived]
        with opened(f"{path}.numbers", "read") as file:
            codes = _expanded(file.read())
        of_texts, start = [], 0
        for n in table["n_words"].to_pylist():
            own = codes[start : start + (n or 0)]
            start += len(own)
            of_texts.append(None if n is None else flat[_ranges(first[own], size[own])])
        ids_of = table["id"].to_pandas(types_mapper={pa.int64(): pd.Int64Dtype(), pa.int32(): pd.Int32Dtype()}.get)
        return pd.DataFrame({"id": ids_of, **finish(of_texts)})

    found = answers.unionByName(asked).groupBy("bundle").applyInPandas(run, f"id {kind}, {schema}")
    return found.withColumnRenamed("id", id_col)


def encode(documents: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, ids (array<int>), as SentencePiece gives them for the whole text. A null text has null ids, an
    empty one none. Repeated rows give repeated rows; an empty table gives none. Other columns are not read."""
    finish = lambda texts: {"ids": [None if ids is None else ids.astype(np.int32) for ids in texts]}
    return _encoded(documents, pieces, finish, "ids array<int>", id_col, text_col)


def decoder(pieces: Pieces) -> dict[int, bytes]:
    """The UTF-8 bytes that each id stands for."""
    known = {i: t.replace(SPACE, " ").encode() for t, i in zip(pieces.texts, pieces.ids, strict=True)}
    return known | {i: bytes([b]) for b, i in enumerate(pieces.byte_ids)}


def text_of(ids, known: dict[int, bytes]) -> str:
    return b"".join([known.get(i, b"") for i in ids]).decode("utf-8", "replace").removeprefix(" ")


def decode(encoded: DataFrame, pieces: Pieces, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: id, text. Pieces are put together, runs of byte pieces decoded as UTF-8 (a byte that is not valid there becomes U+FFFD), and
    the space in front removed. Null ids give a null text; an id that is no piece of text gives nothing."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = decoder(pieces)
        for batch in batches:
            texts = [None if ids is None else text_of(ids, known) for ids in batch["ids"]]
            yield pd.DataFrame({"id": batch["id"], "text": texts})

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return rows.mapInPandas(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def round_trip(documents: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_ids, ids_crc32 (of the ids as little-endian 32-bit numbers, unsigned), decoded_sha256. Texts are encoded as by
    :func:`encode`, and the ids decoded where they arise as by :func:`decode`. All null for a null text."""

    def finish(texts: list) -> dict:
        known = decoder(pieces)
        rows = [
            (None,) * 3 if ids is None else (len(ids), zlib.crc32(ids.astype("<u4").tobytes()), hashlib.sha256(text_of(ids.tolist(), known).encode()).hexdigest())
            for ids in texts
        ]
        n_ids, sums, shas = zip(*rows, strict=True)
        return {"n_ids": pd.array(n_ids, "Int64"), "ids_crc32": pd.array(sums, "Int64"), "decoded_sha256": list(shas)}

    return _encoded(documents, pieces, finish, "n_ids long, ids_crc32 long, decoded_sha256 string", id_col, text_col)
