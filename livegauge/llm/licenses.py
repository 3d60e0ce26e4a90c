"""Licences by canonical digests of entire texts.

A text is brought to a canonical form: copyright lines dropped, lower case, equivalent spellings made one, punctuation and white space reduced to
single spaces. Its SHA-256 is joined with those of known licence texts and notices. Three units of a document are looked up: its whole text; each
of its lines as a text of its own, which is how licence notices stand in documents; and runs of its words, over any lines, that begin and end with the words of a
known text and are as long.

The known texts are those of ``KNOWN`` and of the files in ``texts/``, named by their SPDX identifiers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livegauge.llm.common import slices

RUN_WORDS = 20  # known texts of fewer words are looked for as whole texts and lines alone
ENDS = 6  # words at either end of a known text that a run must share before it is digested

# Spellings that licence texts use for the same word, as the licence-matching guidelines of SPDX list them.
EQUIVALENT = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "licencing": "licensing", "sub license": "sublicense",
    "favour": "favor", "honour": "honor", "organisation": "organization", "organisations": "organizations", "authorisation": "authorization",
    "recognise": "recognize", "modelled": "modeled", "acknowledgement": "acknowledgment", "fulfil": "fulfill", "whilst": "while",
    "copyright holder": "copyright owner", "copyright holders": "copyright owners", "non commercial": "noncommercial", "per cent": "percent",
    "https": "http", "v2": "version 2", "v3": "version 3",
}

# Short public licences and the notices that refer to longer ones. Copyright lines are left out.
KNOWN = {
    "MIT": [
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        'Software.\n\nTHE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
        "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
        "OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.", "Licensed under the MIT License.", "MIT License", "SPDX-License-Identifier: MIT",
    ],
    "ISC": [
        "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that "
        'the above copyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
        "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
        "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy '
        "of the License at\n\nhttp://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
        "specific language governing permissions and limitations under the License.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can "
        "obtain one at http://mozilla.org/MPL/2.0/.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.\n\nAnyone is free to copy, modify, publish, use, compile, sell, or distribute "
        "this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n\nIn jurisdictions "
        "that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We "
        "make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt "
        "act of relinquishment in perpetuity of all present and future rights to this software under copyright law.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
        "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: Unlicense",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the "
        "use of this software.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and "
        "redistribute it freely, subject to the following restrictions:\n\n1. The origin of this software must not be misrepresented; you must not claim that you "
        "wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not "
        "required.\n2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.\n3. This notice may "
        "not be removed or altered from any source distribution.",
        "SPDX-License-Identifier: Zlib",
    ],
    "BSL-1.0": [
        "Boost Software License - Version 1.0 - August 17th, 2003\n\nPermission is hereby granted, free of charge, to any person or organization obtaining a copy "
        'of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the '
        "Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the "
        "following:\n\nThe copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following "
        "disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or "
        "derivative works are solely in the form of machine-executable object code generated by a source language processor.\n\n"
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, '
        "FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR "
        "ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License, version 2.", "SPDX-License-Identifier: GPL-2.0-only", "SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: AGPL-3.0-only", "SPDX-License-Identifier: AGPL-3.0-or-later",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: LGPL-2.1-only", "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU GPL v3.", "SPDX-License-Identifier: GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
        "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under CC BY 4.0.", "SPDX-License-Identifier: CC-BY-4.0"],
    "BSD-3-Clause": ["Licensed under the BSD 3-Clause License.", "SPDX-License-Identifier: BSD-3-Clause"],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", "SPDX-License-Identifier: BSD-2-Clause"],
}

# The clauses of the BSD licences and their disclaimer, which stand numbered or not, and where the holder's name may stand.
BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
BSD_CLAUSES = [
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution.",
    "Neither the name of the {owner} nor the names of its contributors may be used to endorse or promote products derived from this software without specific "
    "prior written permission.",
]
BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE {provider} AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE {liable} OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
    "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
BSD_HOLDERS = [("COPYRIGHT HOLDERS", "COPYRIGHT OWNER"), ("COPYRIGHT HOLDERS", "COPYRIGHT HOLDERS"), ("COPYRIGHT HOLDER", "COPYRIGHT HOLDER"), ("REGENTS", "REGENTS")]
BSD_OWNERS = ["copyright holder", "copyright holders", "University"]

# Where the terms of a licence file begin and end. Titles, addresses and advice on use around them differ from copy to copy.
TERMS = {
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE", "END OF TERMS AND CONDITIONS"),
    "Artistic-1.0-Perl": ("The intent of this document", "The End"),
    "CC0-1.0": ("Statement of Purpose", None),
    "GFDL-1.2": ("0. PREAMBLE", "ADDENDUM"),
    "GFDL-1.3": ("0. PREAMBLE", "ADDENDUM"),
    "GPL-2.0": ("TERMS AND CONDITIONS FOR COPYING", "END OF TERMS AND CONDITIONS"),
    "GPL-3.0": ("TERMS AND CONDITIONS", "END OF TERMS AND CONDITIONS"),
    "LGPL-2.1": ("TERMS AND CONDITIONS FOR COPYING", "END OF TERMS AND CONDITIONS"),
    "LGPL-3.0": ("This version of the GNU Lesser", None),
    "MPL-1.1": ("1. Definitions.", "EXHIBIT A -"),
    "MPL-2.0": ("1. Definitions", "Exhibit A -"),
}

_COPYRIGHT = regex.compile(r"(?im)^[ \t]*(?:(?:copyright|\(c\)|©)[ \t]*)+(?:(?:\(c\)|©|[0-9]{4}|by\b)[^\n]*)$|^[ \t]*all rights reserved\.?[ \t]*$")
_OTHER = regex.compile(r"[^\p{L}\p{N}]+")
_SPELLINGS = regex.compile(r"\b(?:" + "|".join(sorted(EQUIVALENT, key=len, reverse=True)) + r")\b")


def canonical(text: str) -> str:
    """The canonical form: what is left differs only if the wording does."""
    words = _OTHER.sub(" ", _COPYRIGHT.sub("", text).lower()).strip()
    return _SPELLINGS.sub(lambda m: EQUIVALENT[m[0]], words)


def canonical_digest(text: str | None) -> bytes | None:
    """SHA-256 of the canonical form; None for null and for a text that has no letter or digit left."""
    form = canonical(text) if text else ""
    return hashlib.sha256(form.encode()).digest() if form else None


def bsd_texts() -> dict[str, list[str]]:
    """The BSD licences of two and three clauses, numbered or not, for each way to name the holder."""
    texts: dict[str, list[str]] = {"BSD-2-Clause": [], "BSD-3-Clause": []}
    for number in (True, False):
        clauses = [f"{k}. {clause}" if number else clause for k, clause in enumerate(BSD_CLAUSES, 1)]
        for provider, liable in BSD_HOLDERS:
            end = BSD_DISCLAIMER.format(provider=provider, liable=liable)
            texts["BSD-2-Clause"].append("\n".join([BSD_GRANT, *clauses[:2], end]))
            texts["BSD-3-Clause"] += ["\n".join([BSD_GRANT, *clauses, end]).format(owner=owner) for owner in BSD_OWNERS]
    return texts


def standard_texts() -> dict[str, list[str]]:
    """Every known text by licence: those of ``KNOWN`` and without their title, the BSD texts, the licence files and their terms alone."""
    texts = {name: list(known) for name, known in KNOWN.items()}
    for name, title in (("MIT", "MIT License\n\n"), ("ISC", "ISC License\n\n")):
        texts[name].append(texts[name][0].removeprefix(title))
    for name, known in bsd_texts().items():
        texts[name] += known
    for file in sorted((Path(__file__).parent / "texts").glob("*.txt")):
        text = file.read_text()
        first, last = TERMS[file.stem]
        start = text.index(first)
        texts.setdefault(file.stem, []).extend([text, text[start : text.index(last, start) if last else None]])
    return texts


def known_digests(spark: SparkSession, known: dict[str, list[str]] = KNOWN) -> DataFrame:
    """(digest, license) of a list of licence texts, one row per digest."""
    rows = sorted({canonical_digest(text): name for name, texts in known.items() for text in texts}.items())
    return spark.createDataFrame(rows, "digest binary, license string")


def known_runs(known: dict[str, list[str]]) -> dict[str, list[tuple[int, str]]]:
    """(length, last words) of the canonical forms of the known texts of ``RUN_WORDS`` words or more, by their first words. Its size follows the list of licences."""
    runs: dict[str, set[tuple[int, str]]] = {}
    for form in {canonical(text) for texts in known.values() for text in texts}:
        words = form.split(" ")
        if len(words) >= RUN_WORDS:
            runs.setdefault(f" {' '.join(words[:ENDS])} ", set()).add((len(form), f" {' '.join(words[-ENDS:])} "))
    return {first: sorted(ends) for first, ends in runs.items()}


def _finder(runs: dict[str, list[tuple[int, str]]]) -> ahocorasick.Automaton | None:
    if not runs:
        return None
    finder = ahocorasick.Automaton()
    for first, ends in runs.items():
        finder.add_word(first, (len(first), ends))
    finder.make_automaton()
    return finder


def run_digests(form: str, finder: ahocorasick.Automaton) -> list[bytes]:
    """Digests of the runs of a canonical form that begin and end as a known text of their length does, in order of place, each once."""
    padded, found = f" {form} ", {}
    for last, (length, ends) in finder.iter(padded):
        start = last - length + 1
        for size, tail in ends:
            end = start + size + 2  # of the run and the space on either side
            if padded.startswith(tail, end - len(tail)):
                found.setdefault(hashlib.sha256(padded[start + 1 : end - 1].encode()).digest())
    return list(found)


def _digests(runs: dict[str, list[tuple[int, str]]]):
    """(line, unit, digest): unit -1 is the whole text, others are lines counted from 0, runs count down from -2. A line that recurs is digested once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder = _finder(runs)
        for batch in slices(batches):
            lines, units, digests, seen = [], [], [], {}
            for line, text in zip(batch["line"], batch["text"], strict=True):
                if not text:
                    continue
                form = canonical(text)
                found = [(-1, hashlib.sha256(form.encode()).digest() if form else None)]
                if finder:
                    found += [(-2 - k, digest) for k, digest in enumerate(run_digests(form, finder))]
                for unit, part in enumerate(text.split("\n")):
                    if part not in seen:
                        seen[part] = canonical_digest(part)
                    found.append((unit, seen[part]))
                for unit, digest in found:
                    if digest is not None:
                        lines.append(line)
                        units.append(unit)
                        digests.append(digest)
            yield pd.DataFrame({"line": lines, "unit": units, "digest": digests})

    return run


def scan_licenses(
    documents: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: dict[str, list[tuple[int, str]]] | None = None
) -> DataFrame:
    """(id, unit, license): every unit of a document whose digest is known; unit -1 is the whole text, others are lines from 0. With ``runs``, see
    :func:`known_runs`, also -2, -3, ... for the known texts that stand somewhere in the document, over whatever lines, each once.

    ``known`` (digest, license) joins by hash, broadcast only if Spark sees that it is small; of a digest listed twice the smallest name counts. Null, empty and
    blank texts match nothing; rows that repeat match each. Other columns are not read.
    """
    kind = documents.schema[id_col].dataType.simpleString()
    rows = documents.select(F.col(id_col).alias("line"), F.col(text_col).alias("text"))
    found = rows.mapInPandas(_digests(runs or {}), f"line {kind}, unit int, digest binary")
    names = known.groupBy("digest").agg(F.min("license").alias("license"))
    return found.join(names, "digest").select(F.col("line").alias(id_col), "unit", "license")


def document_licenses(
    documents: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text", runs: dict[str, list[tuple[int, str]]] | None = None
) -> DataFrame:
    """One row per distinct id: id, text_license (of the whole text), licenses (names found in any unit, sorted, joined by commas;
    empty if none), n_units (whole texts and lines matched), n_runs (runs matched)."""
    found = scan_licenses(documents, known, id_col, text_col, runs).groupBy(F.col(id_col).alias("of")).agg(
        F.min(F.when(F.col("unit") == -1, F.col("license"))).alias("text_license"),
        F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"),
        F.count_if(F.col("unit") >= -1).alias("n_units"),
        F.count_if(F.col("unit") < -1).alias("n_runs"),
    )
    ids = documents.select(id_col).distinct()
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_units", "n_runs")]
    return ids.join(found, ids[id_col].eqNullSafe(found["of"]), "left").select(id_col, "text_license", F.coalesce("licenses", F.lit("")).alias("licenses"), *counts)
