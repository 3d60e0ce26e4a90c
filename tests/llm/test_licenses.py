import textwrap

from livegauge.llm.licenses import (
    KNOWN, RUN_WORDS, bsd_texts, canonical, canonical_digest, document_licenses, known_digests, known_runs, scan_licenses, standard_texts,
)

from tests.llm.data import SMALL, documents, grouped, rows

MIT = KNOWN["MIT"][0]


def plain(df, known=KNOWN, runs=False):
    names = {}
    for name, texts in known.items():
        for text in texts:
            names[canonical(text)] = min(name, names.get(canonical(text), name))
    found = grouped((r["doc_id"], r["text"]) for r in rows(df.select("doc_id", "text")))
    out = []
    for i, texts in found.items():
        whole = [names.get(canonical(t)) for t in texts if t]
        lines = [names.get(canonical(line)) for t in texts if t for line in t.split("\n")]
        hits = [x for x in whole + lines if x]
        within = [n for t in texts if t and runs for form, n in names.items() if len(form.split()) >= RUN_WORDS and f" {form} " in f" {canonical(t)} "]
        out.append((i, min((x for x in whole if x), default=None), ",".join(sorted({*hits, *within})), len(hits), len(within)))
    return out


def test_wordings_that_are_the_same():
    want = canonical_digest(MIT)
    assert canonical_digest(MIT.upper()) == want
    assert canonical_digest("Copyright (c) 2020 Some One\n" + MIT.replace("\n\n", "\r\n")) == want
    assert canonical_digest(MIT.replace("MIT License", "The".replace("The", "MIT Licence")).replace('"', "“")) == want
    assert canonical_digest(MIT + "\nAll rights reserved.") == want
    assert canonical_digest(MIT.replace("copyright notice", "copyright  -- notice")) == want
    assert canonical_digest(MIT.replace("free of charge", "at a charge")) != want
    assert canonical_digest(MIT + " And more.") != want
    assert canonical_digest(None) is canonical_digest("") is canonical_digest(" .-\n") is canonical_digest("Copyright 2020 X") is None
    assert canonical("Licensed under the GNU GPL v3.") == canonical("licenced under the GNU GPL, version 3")


def test_awkward_rows(spark):
    found = [(1, MIT), (2, "Copyright 1999 by A\n" + MIT.lower()), (3, "text\nReleased under the MIT Licence.\nmore"), (4, "Released under the MIT License. not alone")]
    found += [(5, None), (6, ""), (7, " \n"), (8, "Licensed under CC BY-NC 4.0\n\nlicensed under cc-by-nc 4.0!"), (None, "MIT License"), (9, "x " * 200_000 + "\nMIT License")]
    df = documents(spark, found + [(3, "text\nReleased under the MIT Licence.\nmore"), (10, "é漢")])
    have = [tuple(r.values()) for r in rows(document_licenses(df, known_digests(spark)))]
    assert sorted(have, key=str) == sorted(plain(df), key=str)
    known = standard_texts()
    have = [tuple(r.values()) for r in rows(document_licenses(df, known_digests(spark, known), runs=known_runs(known)))]
    assert sorted(have, key=str) == sorted(plain(df, known, True), key=str)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    have = [tuple(r.values()) for r in rows(document_licenses(df, known_digests(spark)))]
    assert sorted(have, key=str) == sorted(plain(df), key=str) and any(r[3] for r in have)


def wrapped(text, width=60, mark="# "):
    return "\n".join(mark + line for line in textwrap.wrap(text, width))


def test_known_texts_anywhere_in_a_document(spark):
    """Every text of the list, wrapped anew in comments, between other lines and after a copyright line; not with a word changed, cut off at its end or grown together."""
    known = standard_texts()
    long = [(name, text) for name, texts in known.items() for text in texts if len(canonical(text).split()) >= RUN_WORDS]
    found, want = [], {}
    for i, (name, text) in enumerate(long):
        words = wrapped(text).split(" ")
        middle = len(words) // 2
        found.append((4 * i, f"import os\n# Copyright (c) 2001 Some One\n{wrapped(text)}\n\nx = 1\n"))
        found.append((4 * i + 1, "a " + " ".join([*words[:middle], "unlike", *words[middle:]]) + " b"))
        found.append((4 * i + 2, "a " + text.rstrip(" .-\n_=*")[:-1]))
        found.append((4 * i + 3, f"a {text.strip()} b {text.strip()} {text.strip()} c"))
        want[4 * i] = want[4 * i + 3] = name
    have = {r["doc_id"]: r for r in rows(document_licenses(documents(spark, found), known_digests(spark, known), runs=known_runs(known)))}
    assert all(name in have[i]["licenses"].split(",") for i, name in want.items())
    plainly = {r[0]: r for r in plain(documents(spark, found), known, True)}
    assert [tuple(have[i].values()) for i in sorted(have)] == [plainly[i] for i in sorted(plainly)]
    forms = {name: {canonical(t) for t in texts} for name, texts in known.items()}
    assert sum(len(f) for f in forms.values()) == len(set().union(*forms.values()))
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "BSD-2-Clause", "BSD-3-Clause"} <= set(known)
    assert all(len({canonical(t) for t in texts}) == len(texts) for texts in bsd_texts().values())


def test_first_words_without_the_rest(spark):
    """Many beginnings of long texts cost a look at their ends only, and nothing is found."""
    known = standard_texts()
    df = documents(spark, [(1, "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 " * 20_000), (2, None), (3, "")])
    have = rows(document_licenses(df, known_digests(spark, known), runs=known_runs(known)))
    assert sorted((r["doc_id"], r["licenses"], r["n_units"], r["n_runs"]) for r in have) == [(1, "", 0, 0), (2, "", 0, 0), (3, "", 0, 0)]


def test_units_and_no_rows(spark):
    df = documents(spark, [(1, "a\nMIT License"), (2, "MIT License")])
    have = sorted(tuple(r.values()) for r in rows(scan_licenses(df, known_digests(spark))))
    assert have == [(1, 1, "MIT"), (2, -1, "MIT"), (2, 0, "MIT")]
    assert document_licenses(documents(spark, []), known_digests(spark)).count() == 0
    assert document_licenses(df, known_digests(spark, {})).where("n_units > 0").count() == 0
