"""License notices in texts: winnowed fingerprints find candidates, banded alignment measures them.

* **Index.** Of the word triples of a template, winnowing keeps the one with the least hash in every ``WINDOW``
  consecutive ones. Any run of ``WINDOW + 2`` template words holds one of them. They form an inverted index from
  triple to (template, place); a template of fewer than three words is indexed by its first word.
* **Candidates.** Every triple of a text is looked up; hits of one template on nearby diagonals are one candidate.
* **Alignment.** Template and text are aligned locally in a band around the diagonal: +2 for equal words, -1 for
  differing, inserted or missing ones. A notice is reported if the words matched make up ``coverage`` of the
  template and its deciding words (version numbers, and names that tell relatives apart) are among them; of
  overlapping notices the one with more matched words stays, of equal ones the one with the higher coverage.

Words are compared in lower case (A-Z) and without ASCII punctuation. Texts are read once and not moved.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakewarden.llm.common import pieces, slices, text_bytes

WINDOW = 4
COVERAGE = 0.6
PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
FOUND = (
    "doc_id string, license string, template int, coverage double, matched int, first_word int, last_word int, "
    "start_char int, end_char int"
)

# The wording of public license notices.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ),
    ("MIT", "Released under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software.",
    ),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "CC-BY-NC-SA-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ),
    ("CC-BY-ND-4.0", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this "
        "work.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("All rights reserved", "All rights reserved."),
]
# Identifiers of the SPDX list, as they stand behind its tag.
SPDX = (
    "MIT ISC Zlib Apache-2.0 BSD-2-Clause BSD-3-Clause BSL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only "
    "GPL-3.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0 "
    "AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 EPL-2.0 CC-BY-4.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC0-1.0 Unlicense"
).split()
TEMPLATES += [(x, f"SPDX-License-Identifier: {x}") for x in SPDX]
# Words that tell a license from its relatives, beside version numbers and what follows "CC".
NAMES = (
    "mit apache boost mozilla eclipse lesser affero attribution attributionsharealike attributionnoncommercial "
    "attributionnoncommercialsharealike attributionnoderivatives"
).encode().split()
VERSION = re.compile(rb"v?\d+$")


def deciding(words: list[bytes]) -> set[bytes]:
    """The words of a template without which a text is another license's notice."""
    return {w for i, w in enumerate(words) if w in NAMES or VERSION.match(w) or words[i - 1 : i] == [b"cc"]}


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(None, PUNCTUATION).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def winnow(hashes: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The places of the least hash in every window (the last of equal ones); of a short array, its least."""
    if len(hashes) <= window:
        return np.flatnonzero(hashes == hashes.min())[-1:] if len(hashes) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(hashes, window)
    last = window - 1 - views[:, ::-1].argmin(axis=1)
    return np.unique(np.arange(len(views)) + last)


def align(template: list[int], words: list[int], diagonal: int, band: int) -> tuple[int, int, int]:
    """Best local alignment with word = place in the template + diagonal, within the band:
    (matched words, first word, last word); (0, 0, -1) without a match."""
    nothing = (0, 0, -1)  # (score, matched, first word)
    above: dict[int, tuple[int, int, int]] = {}
    best, end = nothing, -1
    for i, want in enumerate(template):
        row: dict[int, tuple[int, int, int]] = {}
        left = nothing
        for j in range(max(0, i + diagonal - band), min(len(words), i + diagonal + band + 1)):
            before = above.get(j - 1, nothing)
            if words[j] == want:
                here = (before[0] + 2, before[1] + 1, before[2] if before[0] else j)
            else:
                here = max(
                    (before[0] - 1, *before[1:]), (left[0] - 1, *left[1:]), (above.get(j, nothing)[0] - 1, *above.get(j, nothing)[1:])
                )
                if here[0] <= 0:
                    here = nothing
            row[j] = left = here
            if here[:2] > best[:2]:
                best, end = here, j
        above = row
    return (best[1], best[2], end) if best[1] else (0, 0, -1)


class Scanner:
    """The inverted index of the templates, and the search in a text."""

    def __init__(self, templates: list[tuple[str, str]], coverage: float = COVERAGE):
        self.names, self.coverage = [n for n, _ in templates], coverage
        split = [words_of(t.encode()) for _, t in templates]
        self.vocabulary: dict[bytes, int] = {}
        for w in split:
            for x in w:
                self.vocabulary.setdefault(x, len(self.vocabulary) + 1)
        self.v = len(self.vocabulary) + 1
        self.templates = [[self.vocabulary[x] for x in w] for w in split]
        self.deciding = [{self.vocabulary[x] for x in deciding(w)} for w in split]
        entries: list[tuple[int, int, int]] = []
        self.short: dict[int, list[int]] = {}
        for t, x in enumerate(self.templates):
            if len(x) < 3:
                if x:
                    self.short.setdefault(x[0], []).append(t)
                continue
            codes = self.codes(np.array(x, np.int64))
            entries += [(int(codes[p]), t, int(p)) for p in winnow(_mix(codes.astype(np.uint64)))]
        entries.sort()
        self.keys = np.array([e[0] for e in entries], np.int64)
        self.places = entries

    def codes(self, x: np.ndarray) -> np.ndarray:
        return (x[:-2] * self.v + x[1:-1]) * self.v + x[2:]

    def numbers(self, text: bytes) -> np.ndarray:
        get = self.vocabulary.get
        return np.concatenate([np.array([get(w, 0) for w in words_of(p)], np.int64) for p in pieces(text)])

    def candidates(self, x: np.ndarray) -> list[tuple[int, int]]:
        """(template, diagonal), one for each group of hits on nearby diagonals."""
        hits = []
        if len(x) >= 3 and len(self.keys):
            at = np.flatnonzero((x[:-2] > 0) & (x[1:-1] > 0) & (x[2:] > 0))
            codes = (x[at] * self.v + x[at + 1]) * self.v + x[at + 2]
            low, high = np.searchsorted(self.keys, codes), np.searchsorted(self.keys, codes, side="right")
            for h in np.flatnonzero(high > low).tolist():
                hits += [(self.places[e][1], int(at[h]) - self.places[e][2]) for e in range(low[h], high[h])]
        for word, owners in self.short.items():
            hits += [(t, int(p)) for p in np.flatnonzero(x == word) for t in owners]
        found: list[tuple[int, int]] = []
        for t, d in sorted(set(hits)):
            if not found or found[-1][0] != t or d - found[-1][1] > self.band(t):
                found.append((t, d))
        return found

    def band(self, t: int) -> int:
        """How far a notice may shift; less than half a template, so that adjoining notices stay apart."""
        n = len(self.templates[t])
        return min(max(3, n // 8), (n - 1) // 2)

    def notices(self, text: bytes) -> list[tuple[int, float, int, int, int]]:
        """(template, coverage, matched, first word, last word), in the order of the text."""
        x = self.numbers(text)
        found = []
        for t, d in self.candidates(x):
            template, band = self.templates[t], self.band(t)
            low = max(0, d - band)
            part = x[low : max(low, d + len(template) + 2 * band)].tolist()
            matched, first, last = align(template, part, d - low, 2 * band)
            if matched >= self.coverage * len(template) and self.deciding[t] <= set(part[first : last + 1]):
                found.append((t, matched / len(template), matched, low + first, low + last))
        kept: list[tuple[int, float, int, int, int]] = []
        taken = np.zeros(len(x), bool)
        for hit in sorted(found, key=lambda h: (-h[2], -h[1], h[3], h[0])):
            if not taken[hit[3] : hit[4] + 1].any():
                kept.append(hit)
                taken[hit[3] : hit[4] + 1] = True
        return sorted(kept, key=lambda h: h[3])


def spans(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The characters (code points, end exclusive) of runs of words, given in order and without overlaps."""
    out, wanted, count, start = [], iter(runs), -1, 0
    run = next(wanted, None)
    chars = at = 0
    for m in WORD.finditer(text):
        if run is None:
            break
        if not m.group().translate(None, PUNCTUATION):
            continue
        count += 1
        if count == run[0]:
            chars, at = chars + len(text[at : m.start()].decode("utf-8", "replace")), m.start()
            start = chars
        if count == run[1]:
            chars, at = chars + len(text[at : m.end()].decode("utf-8", "replace")), m.end()
            out.append((start, chars))
            run = next(wanted, None)
    return out


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, coverage: float = COVERAGE) -> DataFrame:
    """One row per notice found: doc_id, license, template (its number), coverage, matched (words), first_word,
    last_word (counted from 0), start_char, end_char (exclusive).

    NULL and empty texts hold no notice; a NULL id stays NULL; repeated rows are repeated in the result. Only
    doc_id and text are read. An empty table, or no templates, gives an empty result.
    """
    given = TEMPLATES if templates is None else list(templates)
    names = ["doc_id", "license", "template", "coverage", "matched", "first_word", "last_word", "start_char", "end_char"]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.float64(), *[pa.int32()] * 5]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(given, coverage)
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                hits = scanner.notices(text)
                if hits:
                    at = spans(text, [(h[3], h[4]) for h in hits])
                    rows += [(doc, scanner.names[h[0]], h[0], *h[1:], *s) for h, s in zip(hits, at)]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    source = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string").alias("text"))
    found = source.mapInArrow(find, FOUND)
    return found.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
