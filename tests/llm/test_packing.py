import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from livegauge.llm import packing
from livegauge.llm.packing import WordEncoder, by_words, cut, pack, sequences, vocabulary
from tokenizers import Tokenizer

from tests.llm.data import SMALL, documents, grouped, rows


def whole_ids(texts, content=None):
    tokenizer = Tokenizer.from_str(content or vocabulary())
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def check(df, capacity=4096):
    have = rows(pack(df, capacity=capacity))
    source = rows(df.select("doc_id", "text"))
    wanted = grouped((str(r["doc_id"]), ids) for r, ids in zip(source, whole_ids(r["text"] for r in source), strict=True))
    pieces = grouped((str(r["doc_id"]), r) for r in have)
    assert set(pieces) == set(wanted)
    for key, found in pieces.items():
        left = sorted((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in found)
        want = []
        for ids in wanted[key]:
            start = 0
            for length, _ in cut(len(ids), capacity):
                want.append((start, length, zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes()), len(ids)))
                start += length
            assert start == len(ids)
        assert left == sorted(want)
    places = grouped((r["sequence_id"], (r["offset"], r["length"])) for r in have)
    assert sorted(places) == list(range(len(places)))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(len(i) for ids in wanted.values() for i in ids), len(places)


def test_awkward_rows(spark):
    check(documents(spark))


@pytest.mark.parametrize("capacity", [7, 512])
def test_small_capacities(spark, capacity):
    check(documents(spark, [(i, "some words of a text " * i) for i in range(40)]), capacity)


def test_given_documents_have_little_padding(spark):
    tokens, count = check(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert tokens / (4096 * count) > 0.97


@pytest.mark.parametrize("together", [1, 5, 60])
def test_left_pieces_in_several_parties(spark, monkeypatch, together):
    monkeypatch.setattr(packing, "TOGETHER", together)
    check(documents(spark, [(i, "some words of a text " * (1 + i % 37)) for i in range(150)]), 512)


def test_other_tokenizers_give_their_own_ids(spark):
    content = vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    assert by_words(vocabulary()) and not by_words(content)
    found = [(1, "It's  we'll x\n\ny"), (2, None), (3, "é 漢字 12"), (4, "word " * 3000)]
    packed = rows(pack(documents(spark, found), words=content))
    for (i, _), ids in zip(found, whole_ids([t for _, t in found], content), strict=True):
        own = sorted((r["start"], r["length"], r["ids_crc32"]) for r in packed if r["doc_id"] == i)
        assert sum(n for _, n, _ in own) == len(ids)
        assert all(zlib.crc32(np.array(ids[a : a + n], "<u4").tobytes()) == c for a, n, c in own)


def test_no_rows(spark):
    assert pack(documents(spark, [])).count() == 0


def test_sequences_hold_the_ids(spark):
    df = documents(spark, [(i, f"text number {i} with words " * (1 + 97 * i % 500)) for i in range(30)] + [(90, None)])
    packed = pack(df)
    held = {r["sequence_id"]: r["ids"] for r in rows(sequences(df, packed))}
    for r in rows(packed):
        ids = held[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r["ids_crc32"]
    assert sum(map(len, held.values())) == sum(r["length"] for r in rows(packed))


def test_words_one_by_one_give_the_ids_of_the_whole():
    texts = ["It's  we'll <|endoftext|>x  y<|startoftext|>", "á e\ń̈ ﬁ ǅ İ Σ ΑΣ", "x\x1cy\x85z w v", "漢字 かな 12 345 6.7 -- !?", "nospace" * 3000]
    latin = "".join(map(chr, [*range(0x21, 0x7F), *range(0xA1, 0x180)]))
    pick = random.Random(2)
    texts += ["".join(pick.choices(latin + "aeinst'" * 20, k=pick.randint(1, 30))) for _ in range(300)] + [c for c in latin] + ["DON'T we'LL'D 'tis <|x|> x²½ªº µm"]
    encoder = WordEncoder(vocabulary())
    for _ in range(2):
        assert [np.frombuffer(encoder.ids(t), "<u4").tolist() + [2] for t in texts] == whole_ids(texts)
    encoder.REMEMBERED = 3
    assert [np.frombuffer(encoder.ids(t), "<u4").tolist() + [2] for t in texts] == whole_ids(texts)


def test_every_length_is_cut_into_pieces_of_its_classes():
    for length in range(1, 9000):
        pieces = cut(length)
        assert sum(n for n, _ in pieces) == length
        assert all(4096 // (j + 1) < n <= 4096 // j and 4096 - n * j <= 0.02 * 4096 + 64 for n, j in pieces)
