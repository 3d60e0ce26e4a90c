"""Harmonic packing of tokenized documents into sequences of fixed capacity.

Class j holds pieces longer than capacity / (j + 1) and at most capacity / j tokens; a full sequence of class j is any j
of them. Which pieces share a sequence follows from counting alone, so every worker fills its classes by
itself: a piece's number within its class is its number in its partition plus the pieces of the partitions before.
A document is cut so that its pieces nearly fill their class. The fewer than j pieces that are left of each class, a
number that does not depend on the corpus, are packed at the end, some thousand together.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch, slices

CAPACITY = 4096
TOGETHER = 2048  # pieces left of their classes that are packed together, at least, and at most so many more than one class may leave
SLACK = 0.02  # share of a sequence that a piece's class may leave empty before the piece is cut
END = 2  # id after every document
VOCABULARY = "word_bpe_49k.json"


# The steps before the model of the tokenizer file that may be cut into words, as it states them.
STEPS = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
    "truncation": None,
    "padding": None,
}


def by_words(content: str) -> bool:
    """Whether a tokenizer file's ids of a text are those of its words in turn: its steps are ``STEPS``, its model is plain byte-pair, and its added tokens hold ``<|`` and
    no white space and are taken as they stand."""
    file = json.loads(content)
    model = file["model"]
    plain = model["type"] == "BPE" and not any(
        model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
    )
    added = all(
        "<|" in t["content"] and not re.search(r"\s", t["content"]) and not any(t[k] for k in ("lstrip", "rstrip", "normalized", "single_word"))
        for t in file["added_tokens"]
    )
    return plain and added and all(file.get(k) == v for k, v in STEPS.items())


class WordEncoder:
    """Ids of whole texts as little-endian 32-bit bytes, word by word.

    The tokenizer drops white space and merges only within words, so a text's ids are those of its words in turn; words
    recur, so each is encoded once. The memory for them is bounded. Of words in ASCII and Latin-1 letters, which normalization only
    lower-cases, the parts that the tokenizer's pattern splits off go to its model at once; they recur even more often, and
    the tokenizer's steps before the model take most of its time. Other words go through the whole tokenizer.

    All that holds for tokenizer files with the steps ``STEPS`` alone. With any other file whole texts go through the tokenizer.
    """

    REMEMBERED, LONGEST = 400_000, 64
    _PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    # The tokenizer's pattern for parts of a word, for those characters in lower case.
    _PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zà-öø-ÿß]+|[0-9]|[^a-zà-öø-ÿß0-9]+")
    # Byte-level vocabularies write a byte as a character: itself where it is printed, else the next from 256 on.
    _BYTES = {b: 256 + k for k, b in enumerate(b for b in range(256) if not (0x21 <= b < 0x7F or 0xA1 <= b < 0xAD or b >= 0xAE))}

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.by_words = Tokenizer.from_str(vocabulary), by_words(vocabulary)
        self.model = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None:
            shown = part.encode().decode("latin-1").translate(self._BYTES)
            found = array("I", [token.id for token in self.model.tokenize(shown)]).tobytes()
            if len(self.parts) >= self.REMEMBERED:
                self.parts.clear()
            if len(part) <= self.LONGEST:
                self.parts[part] = found
        return found

    def _encoded(self, word: bytes) -> bytes:
        text = word.decode()
        if self._PLAIN.fullmatch(text) and "<|" not in text:
            low = text.lower()
            return self._part(low) if low.isalpha() else b"".join(map(self._part, self._PARTS.findall(low)))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        if not self.by_words:
            return array("I", self.tokenizer.encode(text or "", add_special_tokens=False).ids).tobytes()
        words = (text or "").encode().split()
        known = self.known
        new = [w for w in set(words) if w not in known]
        if new:
            if len(known) + len(new) > self.REMEMBERED:
                known.clear()
                new = list(set(words))
            for word in new:
                known[word] = self._encoded(word)
        joined = b"".join([known[w] for w in words])
        for w in new:
            if len(w) > self.LONGEST:
                del known[w]
        return joined


def cut(length: int, capacity: int = CAPACITY, slack: float = SLACK) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document in order: whole sequences first, then pieces that fill a
    class exactly, until what is left fills its class but for ``slack``."""
    pieces = [(capacity, 1)] * (length // capacity)
    rest = length % capacity
    while rest:
        j = capacity // rest
        if capacity - rest * j > slack * capacity:
            j += 1
            pieces.append((capacity // j, j))
            rest -= capacity // j
        else:
            pieces.append((rest, j))
            rest = 0
    return pieces


def vocabulary(path: str | None = None) -> str:
    """The tokenizer file's content, read by the driver; its size is that of a vocabulary."""
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return file.read()


def token_pieces(documents: DataFrame, words: str, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """Every piece: id, start, length, ids_crc32, doc_tokens, class, worker, nth (its number in class and worker)."""
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, numbers, worker = WordEncoder(words), Counter(), TaskContext.get().partitionId()
        for batch in slices(batches):
            rows = []
            for row, text in zip(batch["id"], batch["text"], strict=True):
                ids = encoder.ids(text) + END.to_bytes(4, "little")
                total, start = len(ids) // 4, 0
                for length, j in cut(total, capacity):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((row, start, length, crc, total, j, worker, numbers[j]))
                    numbers[j] += 1
                    start += length
            yield pd.DataFrame(rows, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "class", "worker", "nth"])

    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = "start long, length long, ids_crc32 long, doc_tokens long, class int, worker int, nth long"
    return rows.mapInPandas(run, f"id {kind}, {schema}")


def _last_fit(capacity: int):
    """Packs the pieces left of all classes, longest first, each into the fullest sequence it fits."""

    def run(left: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values(["length", "id", "start", "ids_crc32"], ascending=[False, True, True, True])
        room: dict[int, list[int]] = {}  # sequences by free space
        place, offset, opened = [], [], 0
        for length in left["length"]:
            fits = [free for free in room if free >= length]
            if fits:
                free = min(fits)
                number = room[free].pop()
                if not room[free]:
                    del room[free]
            else:
                free, number, opened = capacity, opened, opened + 1
            place.append(number)
            offset.append(capacity - free)
            room.setdefault(free - length, []).append(number)
        return left.assign(bin=np.array(place, np.int64), offset=np.array(offset, np.int64))

    return run


def pack(documents: DataFrame, words: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every id of every document, the end id included, lies in exactly one piece; a sequence holds at most ``capacity`` ids, its pieces without gaps from
    offset 0. A null or empty text is its end id alone. Rows that repeat are packed each. ``words`` is the content of a
    tokenizer file, by default ``VOCABULARY``. Other columns are not read.
    """
    scratch = Scratch(documents.sparkSession, "packing")
    pieces = scratch.keep(token_pieces(documents, words or vocabulary(), capacity, id_col, text_col))
    held = pieces.groupBy("class", "worker").agg(F.count("*").alias("held"))
    before = Window.partitionBy("class").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)))
    # One row per class: fewer than capacity of them, in practice some hundred.
    totals = sorted((r["class"], r["total"]) for r in held.groupBy("class").agg(F.sum("held").alias("total")).collect())
    classes, base, party, together = [], 0, 0, 0
    for j, total in totals:
        classes.append(f"({j}, {base}L, {total // j}L, {party})")
        base += total // j
        together += total % j
        if together >= TOGETHER:
            party, together = party + 1, 0
    if not classes:
        classes = ["(0, 0L, 0L, 0)"]
    full = documents.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(classes)} AS v(class, base, bins, party)")
    numbered = (
        pieces.join(held.select("class", "worker", "before"), ["class", "worker"])
        .join(F.broadcast(full), "class")
        .withColumn("number", F.col("before") + F.col("nth"))
        .withColumn("bin", F.expr("number div class"))
    )
    numbered = scratch.keep(numbered.select("id", "start", "length", "ids_crc32", "doc_tokens", "class", "number", "bin", "base", "bins", "party"))
    columns = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    earlier = Window.partitionBy("sequence_id").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    whole = numbered.where("bin < bins").withColumn("sequence_id", F.col("base") + F.col("bin"))
    whole = whole.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)))
    left = numbered.where("bin >= bins").select("id", "start", "length", "ids_crc32", "doc_tokens", "party")
    kind = dict(left.dtypes)["id"]
    left = scratch.keep(
        left.groupBy("party").applyInPandas(
            _last_fit(capacity),
            f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, party int, bin long, offset long",
        )
    )
    scratch.only(numbered, left)
    # One row per party; together they hold fewer pieces than all classes can leave.
    sizes = left.groupBy("party").agg((F.max("bin") + 1).alias("size"))
    ahead = F.coalesce(F.sum("size").over(Window.orderBy("party").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = sizes.select(F.col("party").alias("of"), (ahead + F.lit(base)).alias("first"))
    left = left.join(F.broadcast(sizes), F.col("party") == F.col("of")).withColumn("sequence_id", F.col("first") + F.col("bin"))
    return whole.select(*columns).union(left.select(*columns)).withColumnRenamed("id", id_col)


def sequences(documents: DataFrame, packed: DataFrame, words: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, unpadded. Ids of documents must be unique."""
    content = words or vocabulary()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = WordEncoder(content)
        for batch in slices(batches):
            ids = [np.frombuffer(encoder.ids(t) + END.to_bytes(4, "little"), "<i4") for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "ids": ids})

    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    tokens = rows.mapInPandas(run, f"id {kind}, ids array<int>")
    parts = packed.withColumnRenamed(id_col, "id").join(tokens, "id").select(
        "sequence_id", F.struct("offset", F.expr("slice(ids, cast(start + 1 as int), cast(length as int))").alias("ids")).alias("part")
    )
    ordered = F.sort_array(F.collect_list("part"))  # at most ``capacity`` ids a group
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(ordered, lambda p: p["ids"])).alias("ids"))
