"""Licence scan: a trained classifier of stretches of paragraphs, confirmed against templates.

A paragraph ends at a blank line. A softmax regression with an L1 penalty scores stretches of `LENGTHS`
words of it, from every word on that speaks for some family. Features are hashed words and word pairs,
weighed by the inverse root of their number; scores of stretches are differences of running sums, so
prose around a notice takes nothing from it, and words without a weight cost nothing. The regression
alone says which family a stretch belongs to. It is trained on notices made from the templates and names
below (parts of them, words left out, prose before and behind) and, as the class "unknown", on lines and
stretches of lines of at most `max_docs` corpus documents, picked by a hash of their id, and on notices
of other licences. Its scale is calibrated on held-out stretches (one temperature), and a stretch in
which "unknown" has half of the probability or more is rejected.

Of the stretches from one word on, and of one family, the longest of about the best probability counts. In the order of
their probability (to a tenth) and then length they are compared with the templates of the family that
was predicted: one of the family's names, which must stand near a word that speaks of licensing unless
it says so itself, or enough of the word pairs of a longer template, those aside that bring in any
licence. What no template confirms is
dropped, and what agrees (the name's words, or the stretch) counts unless it overlaps what counted
before. Stretches of one family within `GAP` words are one notice, unless both are names.

Word pairs cannot tell versions or variants, so the reported name comes from the words of the notice and
those behind it up to the version, or the next notice: the version, the clauses, NC, ND and SA. A notice
without a known version or variant is reported as the family without it ("GPL"), one without the
family's own words as "unknown", unless it stands beside another. A paragraph is reported once for every licence found in it; a licence
without its version is not reported beside the same one with it.

Null and empty texts have no paragraphs. Rows with a null id are scanned but not sampled. Repeated
rows give repeated results; every paragraph of a long text is read. An empty table gives no rows.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm.text import ALNUM, SOLID, Words, blocks, buffers, find_words, grams, mix

UNKNOWN = "unknown"

#: Notices of widespread licences, by SPDX identifier.
TEMPLATES: dict[str, list[str]] = {
    "AGPL-3.0": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "SPDX-License-Identifier: BSL-1.0",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "BSD-2-Clause": [
        "Released under the 2-Clause BSD License.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation",
        "SPDX-License-Identifier: BSD-2-Clause",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software",
        "Released under the 3-Clause BSD License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC0-1.0": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "EPL-2.0": [
        "Licensed under the Eclipse Public License, version 2.0.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0",
        "SPDX-License-Identifier: EPL-2.0",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License.",
    ],
    "LGPL-2.1": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "LGPL-3.0": [
        "This library is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "SPDX-License-Identifier: MIT",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    ],
    "Zlib": [
        "Released under the zlib License.",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.",
        "SPDX-License-Identifier: Zlib",
    ],
}


#: Short names of the families, as notices and identifiers write them.
NAMES: dict[str, list[str]] = {
    "AGPL": ["AGPL", "AGPLv3", "AGPL-3.0", "AGPL-3.0-only", "GNU AGPL", "Affero General Public License"],
    "Apache": ["Apache 2.0", "Apache-2.0", "Apache License", "Apache Licence", "Apache v2", "Apache Software License"],
    "BSD": ["BSD", "BSD-2-Clause", "BSD-3-Clause", "BSD 2-Clause", "BSD 3-Clause", "2-Clause BSD", "3-Clause BSD"],
    "BSL": ["BSL-1.0", "Boost Software License"],
    "CC": ["CC BY", "CC BY 4.0", "CC BY-SA 4.0", "CC BY-NC 4.0", "CC BY-ND 4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0", "CC BY 3.0", "Creative Commons Attribution", "Creative Commons BY"],
    "CC0": ["CC0", "CC0 1.0", "CC0-1.0", "Creative Commons Zero"],
    "EPL": ["EPL", "EPL-1.0", "EPL-2.0", "Eclipse Public License"],
    "GPL": ["GPL", "GPLv2", "GPLv3", "GPL-2.0", "GPL-3.0", "GPL-2.0-only", "GPL-3.0-or-later", "GNU GPL", "GNU General Public License", "GNU General Public Licence"],
    "ISC": ["ISC"],
    "LGPL": ["LGPL", "LGPLv2", "LGPLv3", "LGPL-2.1", "LGPL-3.0", "LGPL-2.1-or-later", "LGPL-3.0-only", "GNU LGPL", "Lesser General Public License", "Lesser General Public Licence"],
    "MIT": ["MIT"],
    "MPL": ["MPL", "MPL-1.1", "MPL-2.0", "Mozilla Public License", "Mozilla Public Licence"],
    "Unlicense": ["Unlicense"],
    "Zlib": ["Zlib"],
}

#: How notices bring a name in; words that speak of licensing; families whose names with a
#: version or clause need no such word.
PHRASES = [
    "Licensed under {}", "Licensed under the {} license", "Released under {}", "Released under the {} license", "Available under {}", "Distributed under the {} licence",
    "This project uses the {} license", "SPDX-License-Identifier: {}", "License: {}", "Dual licensed under {}", "made available under the terms of the {}", "published under the terms of {}", "{} licensed", "the {} license",
]
SPEAKS = ["license", "licence", "licensed", "licenced", "licenses", "licences", "spdx", "available under", "released under", "distributed under", "published under", "terms of"]
PLAIN = ("AGPL", "BSD", "BSL", "CC", "CC0", "EPL", "GPL", "LGPL", "MPL")
#: Words that stand alone in prose as well; the class "unknown" is trained on them so.
ALONE = ["MIT", "ISC", "Apache", "Eclipse", "Mozilla", "Boost", "zlib", "the license", "a licence to", "released under a", "permission", "this software"]

#: Notices of licences without a template; the class "unknown" is trained on them too.
NEAR_MISSES = [
    "Licensed under the Artistic License 2.0.",
    "Licensed under the European Union Public Licence, version 1.2.",
    "This work is licensed under the Open Data Commons Open Database License.",
    "Released under the Do What The Fuck You Want To Public License.",
    "Licensed under the Open Software License 3.0.", "Licensed under the Academic Free License, version 3.0.", "Licensed under the Microsoft Public License.",
    "This work is licensed under the SIL Open Font License, Version 1.1.", "Released under the PostgreSQL License.", "SPDX-License-Identifier: OFL-1.1", "SPDX-License-Identifier: Artistic-2.0",
    "SPDX-License-Identifier: EUPL-1.2",
    "SPDX-License-Identifier: PSF-2.0",
    "This software is proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    "This file is subject to the terms and conditions of the licence agreement between the parties.",
]

#: Versions of licences, without trailing zeros, as their identifiers write them.
VERSIONS: dict[str, dict[str, str]] = {
    "AGPL": {"1": "1.0", "3": "3.0"}, "BSL": {"1": "1.0"}, "Apache": {"1": "1.0", "1.1": "1.1", "2": "2.0"}, "CC": {"1": "1.0", "2": "2.0", "2.5": "2.5", "3": "3.0", "4": "4.0"}, "EPL": {"1": "1.0", "2": "2.0"},
    "GPL": {"1": "1.0", "2": "2.0", "3": "3.0"}, "LGPL": {"2": "2.0", "2.1": "2.1", "3": "3.0"}, "MPL": {"1": "1.0", "1.1": "1.1", "2": "2.0"},
}

#: The version that a name, or the word version, is followed by.
_VERSION = re.compile(
    r"(?:\bversion[\s,:(]*|\bv[\s.]*|(?:gpl|mpl|epl|bsl|apache|licen[sc]es?|attribution|non-?commercial|share-?alike|noderiv\w*|\bby|\bnc|\bnd|\bsa)(?:[\s(/-]|licen[sc]e)*v?[\s.]*)"
    r"(\d+(?:\.\d+)*)"
)
#: Words behind a notice in which its version may stand; words between stretches of one notice; words
#: before and behind a name in which licensing may be spoken of.
_BEHIND, GAP, BEFORE, AFTER = 12, 8, 8, 8
#: Words of the stretches that are scored.
LENGTHS = (1, 2, 3, 4, 5, 6, 8, 10, 12, 16, 20, 24, 32, 40)


def licence_name(family: str, notice: str, behind: str = "") -> str:
    """The licence that a notice confirmed as `family` names: with version and variant if they are
    known, else the family without them, or "unknown" if its own words are missing."""
    text = (notice + behind).lower()
    m = _VERSION.search(text)
    version = re.sub(r"(\.0+)+$", "", m[1]) if m else ""
    text = text[: max(len(notice), m.end() if m else 0)]
    has = lambda p: re.search(p, text) is not None

    def versioned(name: str) -> str:
        full = VERSIONS[name.split("-")[0]].get(version)
        return f"{name}-{full}" if full else name

    stem = family.split("-")[0]
    if stem in ("AGPL", "GPL", "LGPL"):
        if not has(r"general public licen[sc]e|gpl"):
            return UNKNOWN
        return versioned("AGPL" if has("affero|agpl") else "LGPL" if has(r"lesser|lgpl|library general") else "GPL")
    if stem in ("CC", "CC0"):
        if has(r"\bcc0\b|creative commons zero|waived all copyright"):
            return "CC0-1.0"
        if not has(r"\bcc\b|creative commons"):
            return UNKNOWN
        return versioned("CC" + "-BY" * has(r"\bby\b|attribution") + "-NC" * has(r"\bnc\b|non-?commercial") + "-ND" * has(r"\bnd\b|no-?deriv") + "-SA" * has(r"\bsa\b|share-?alike"))
    if stem == "BSD":
        if has(r"\b(3|three)[\s-]clause|bsd-3|neither the name"):
            return "BSD-3-Clause"
        if has(r"\b(2|two)[\s-]clause|bsd-2"):
            return "BSD-2-Clause"
        return "BSD" if has(r"\bbsd\b|redistributions? |binary forms|endorse or promote") else UNKNOWN
    own = {
        "Apache": "apache", "MPL": "mozilla public licen[sc]e|mpl", "EPL": "eclipse public licen[sc]e|epl",
        "MIT": r"\bmit\b(?!-0|\s+no\s+attribution)|free of charge|and associated documentation|permission notice shall",
        "ISC": r"\bisc\b|with or without fee",
        "Unlicense": r"unencumbered|publish, use, compile|source code form or as",
        "Zlib": r"\bzlib\b|altered source|held liable for any damages arising",
        "BSL": r"\bboost software|\bbsl\b",
    }[stem]
    return UNKNOWN if not has(own) else versioned(stem) if stem in VERSIONS else family


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    max_docs: int = 400
    max_lines: int = 4_000
    max_chars: int = 4_096
    copies: int = 24
    steps: int = 300
    rate: float = 0.5
    l1: float = 1e-5
    confirm: float = 0.6
    #: least weight, over that for "unknown", of a word that speaks for a family
    evidence: float = 0.1
    #: word pairs that a longer template and a stretch must share at least
    least_pairs: int = 4


@dataclass(frozen=True)
class Model:
    classes: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def features(w: Words, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(paragraph, slot, value) of all features of a block of paragraphs."""
    at, pair = grams(w.hash, w.last, 2)
    row = np.concatenate([w.row, w.row[at]])
    slot = (np.concatenate([mix(w.hash), pair]) >> np.uint64(64 - bits)).astype(np.int64)
    return row, slot, 1 / np.sqrt(np.bincount(row, minlength=len(w.first) - 1)[row])


def _block(texts: list[str]) -> Words:
    offs, data = buffers(pa.array(texts, pa.string()))
    return find_words(offs, data, ALNUM)


def word_pairs(texts: list[str]) -> list[set[int]]:
    """The hashed word pairs of each text; the word itself for a text of one."""
    w = _block(texts)
    at, g = grams(w.hash, w.last, 2)
    row = w.row[at]
    out = [set(g[a:b].tolist()) for a, b in zip(*(np.searchsorted(row, np.arange(len(texts)) + k) for k in (0, 1)))]
    return [s or set(w.hash[a:b].tolist()) for s, a, b in zip(out, w.first[:-1], w.first[1:])]


def agreement(paragraph: set[int], template: set[int]) -> float:
    """Share of the smaller one's word pairs that the other has; paragraphs of one pair must equal the template."""
    least = min(len(paragraph), len(template))
    if least < 2 and paragraph != template:
        return 0.0
    return len(paragraph & template) / least if least else 0.0


def family_of(name: str) -> str:
    return name.split("-")[0]


@dataclass(frozen=True)
class Templates:
    """What confirms a family, by class: word pairs of its longer templates; hashed words of its names,
    by their first word, with whether they need no word about licensing."""

    pairs: dict[int, list[frozenset[int]]]
    names: dict[int, dict[int, list[tuple[list[int], bool]]]]
    speaks: frozenset[int]
    speaks_pairs: frozenset[int]

    @staticmethod
    def of(classes: list[str], least: int) -> Templates:
        pairs: dict[int, list[frozenset[int]]] = {y: [] for y in range(1, len(classes))}
        common = _block([part for phrase in PHRASES for part in phrase.split("{}")])
        common = set(grams(common.hash, common.last, 2)[1].tolist())  # they bring in any licence
        for name, texts in TEMPLATES.items():
            pairs[classes.index(family_of(name))] += [own for p in word_pairs(texts) if len(own := frozenset(p - common)) >= least]
        names: dict[int, dict[int, list[tuple[list[int], bool]]]] = {y: {} for y in pairs}
        for family, texts in NAMES.items():
            w = _block(texts)
            for text, a, b in zip(texts, w.first[:-1], w.first[1:]):
                plain = bool(re.search("licen[sc]e", text, re.I)) or (family in PLAIN and bool(re.search(r"\d", text)))
                names[classes.index(family)].setdefault(int(w.hash[a]), []).append((w.hash[a:b].tolist(), plain))
        w = _block(SPEAKS)
        one = np.diff(w.first) == 1
        return Templates(pairs, names, frozenset(w.hash[w.first[:-1][one]].tolist()), frozenset(grams(w.hash, w.last, 2)[1].tolist()))

    def confirm(self, y: int, words: list[int], pairs: list[int], a: int, b: int, lo: int, hi: int, s: Settings) -> tuple[int, int, bool] | None:
        """Where words a to b (exclusive) of a paragraph from lo to hi agree with a template of class y: the
        longest name (the first of several), else the whole stretch; and whether it is a name. `pairs[i]`
        is the pair of words i and i + 1."""
        best = None
        for i in range(a, b):
            for name, plain in self.names[y].get(words[i], ()):
                n = len(name)
                if (best is None or n > best[1] - best[0]) and i + n <= b and words[i : i + n] == name:
                    near = range(max(lo, i - BEFORE), min(hi, i + n + AFTER))
                    if plain or any(words[k] in self.speaks or (k + 1 in near and pairs[k] in self.speaks_pairs) for k in near):
                        best = i, i + n, True
        if best:
            return best
        own = set(pairs[a : b - 1])
        for template in self.pairs[y]:
            shared = len(own & template)
            if shared >= s.least_pairs and shared >= s.confirm * min(len(template), len(own)):
                return a, b, False
        return None


@dataclass(frozen=True)
class Notice:
    line: int
    start: int
    end: int
    label: int
    sure: float
    named: bool


class Scorer:
    """A model made ready for blocks of paragraphs."""

    def __init__(self, model: Model, s: Settings):
        self.m, self.s, self.templates = model, s, Templates.of(model.classes, s.least_pairs)
        self.live = (model.weights != 0).any(1)
        self.speaks = (model.weights[:, 1:].max(1) - model.weights[:, 0]) >= s.evidence

    def _sums(self, slot: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places with a weight, running sums of their weights)."""
        k = np.flatnonzero(self.live[slot])
        total = np.zeros((len(k) + 1, len(self.m.classes)))
        np.cumsum(self.m.weights[slot[k]], axis=0, dtype=np.float64, out=total[1:])
        return place[k], total

    def stretches(self, w: Words) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(start, end, probabilities) of all stretches of a length."""
        shift = np.uint64(64 - self.s.bits)
        at, pair = grams(w.hash, w.last, 2)
        word_slot, pair_slot = ((h >> shift).astype(np.int64) for h in (mix(w.hash), pair))
        (in_words, word_sum), (in_pairs, pair_sum) = self._sums(word_slot, np.arange(len(w.hash))), self._sums(pair_slot, at)
        speaks = self.speaks[word_slot]
        speaks[at[self.speaks[pair_slot]]] = True
        start = np.flatnonzero(speaks)
        last, before = w.last[start], start
        base = word_sum[np.searchsorted(in_words, start)] + pair_sum[np.searchsorted(in_pairs, start)]
        for n in LENGTHS:
            end = np.minimum(start + n, last)
            k = np.flatnonzero(end > before)  # not the same stretch again at a paragraph's end
            before, e = end, end[k]
            z = word_sum[np.searchsorted(in_words, e)] + pair_sum[np.searchsorted(in_pairs, e - 1)] - base[k]
            z = z / np.sqrt(2 * (e - start[k]) - 1)[:, None] + self.m.bias
            p = np.exp(np.clip(z / self.m.temperature, -50, 50))
            yield start[k], e, p / p.sum(1, keepdims=True)

    def notices(self, w: Words) -> list[Notice]:
        """Confirmed notices that do not overlap, by place; probability is that of not being unknown."""
        rows = []
        for a, e, p in self.stretches(w):
            y = p.argmax(1)
            k = np.flatnonzero((y > 0) & (p[:, 0] < 0.5))
            rows.append((a[k], e[k], y[k], p[k, y[k]], 1 - p[k, 0]))
        a, e, y, p, sure = (np.concatenate(c) for c in zip(*rows))
        if not len(a):
            return []
        of = a * len(self.m.classes) + y  # stretches from one word on, of one family
        kinds, of = np.unique(of, return_inverse=True)
        best = np.zeros(len(kinds))
        np.maximum.at(best, of, p)
        k = np.flatnonzero(p >= 0.9 * best[of])
        k = k[np.lexsort((-e[k], of[k]))]  # the longest first
        k = k[np.r_[True, np.diff(of[k]) > 0]]
        k = k[np.lexsort((a[k], a[k] - e[k], -np.round(p[k], 1)))]
        words, line = w.hash.tolist(), w.row
        at, pair = grams(w.hash, w.last, 2)
        pairs = np.zeros(len(w.hash), np.uint64)
        pairs[at] = pair
        pairs = pairs.tolist()
        taken, found = np.zeros(len(w.hash), bool), []
        for i in k.tolist():
            lo, hi, n = int(a[i]), int(e[i]), int(line[a[i]])
            if taken[lo:hi].all():
                continue
            at = self.templates.confirm(int(y[i]), words, pairs, lo, hi, int(w.first[n]), int(w.first[n + 1]), self.s)
            if at and not taken[at[0] : at[1]].any():
                taken[at[0] : at[1]] = True
                found.append(Notice(n, at[0], at[1], int(y[i]), float(sure[i]), at[2]))
        out: list[Notice] = []
        for x in sorted(found, key=lambda x: x.start):
            if out and (out[-1].line, out[-1].label) == (x.line, x.label) and x.start - out[-1].end <= GAP and not (out[-1].named and x.named):
                out[-1] = Notice(x.line, out[-1].start, x.end, x.label, max(x.sure, out[-1].sure), False)
            else:
                out.append(x)
        return out


def probabilities(m: Model, w: Words, a: int, b: int, bits: int) -> np.ndarray:
    """Of every class, for the words a to b (exclusive) of one paragraph."""
    h = w.hash[a:b]
    slot = (np.concatenate([mix(h), grams(h, np.full(len(h), len(h)), 2)[1]]) >> np.uint64(64 - bits)).astype(np.int64)
    x = m.weights[slot].sum(0, dtype=np.float64) / np.sqrt(len(slot)) + m.bias
    e = np.exp(np.clip(x / m.temperature, -50, 50))
    return e / e.sum()


def clean_notices() -> list[tuple[str, str]]:
    """(family, text) of all templates, and of all names in all phrases and, if they can, alone."""
    out = [(family_of(name), text) for name, texts in TEMPLATES.items() for text in texts]
    for family, names in NAMES.items():
        for name in names:
            out += [(family, phrase.format(name)) for phrase in PHRASES]
            if family in PLAIN and re.search(r"\d", name):
                out += [(family, name)] * 3
    return out


def training_set(prose: list[str], s: Settings) -> tuple[list[str], list[int], list[str]]:
    """(texts, labels, class names): prose that no template confirms is "unknown"."""
    rng = np.random.default_rng(11)
    classes = [UNKNOWN, *sorted(NAMES)]
    known = [t for f in TEMPLATES for t in word_pairs(TEMPLATES[f])]
    plain = [p for p, pairs in zip(prose, word_pairs(prose)) if pairs and max(agreement(pairs, t) for t in known) < s.confirm]
    texts, labels = list(plain), [0] * len(plain)
    for i in range(1, len(plain), 2):  # stretches are short
        words = plain[i].split()
        at = int(rng.integers(0, max(len(words) - 4, 0) + 1))
        texts[i] = " ".join(words[at : at + int(rng.integers(1, 27))])
    filler = [w for p in plain[:200] for w in p.split()] or ["text"]
    some = lambda most: [str(x) for x in rng.choice(filler, int(rng.integers(0, most)))]
    for notice in NEAR_MISSES + ALONE:
        for i in range(s.copies):
            texts.append(" ".join([*some(6), notice, *some(6)] if i % 2 else [notice]))
            labels.append(0)
    for family, text in clean_notices():
        words = text.split()
        for i in range(s.copies if len(words) > 8 else 3):
            part = words
            if i and len(words) > 8:
                size = int(rng.integers(max(6, len(words) * 6 // 10), len(words) + 1))
                at = int(rng.integers(0, len(words) - size + 1))
                part = [w for w in words[at : at + size] if rng.random() > 0.05]
            texts.append(" ".join([*some(6), *part, *some(6)] if i % 3 == 2 else part))
            labels.append(classes.index(family))
    return texts, labels, classes


def fit(prose: list[str], s: Settings = Settings()) -> Model:
    """Train on the templates and paragraphs of prose; every fifth paragraph calibrates."""
    texts, labels, classes = training_set(prose, s)
    row, slot, value = features(_block(texts), s.bits)
    y = np.array(labels)
    used = np.unique(features(_block([text for _, text in clean_notices()]), s.bits)[1])  # what only prose has cannot tell licences apart
    k = np.flatnonzero(np.isin(slot, used))
    x = np.zeros((len(y), len(used)), np.float32)
    np.add.at(x, (row[k], np.searchsorted(used, slot[k])), value[k])
    held = np.arange(len(y)) % 5 == 4
    share = np.bincount(y[~held], minlength=len(classes))
    each = (np.where(held, 0.0, 1 / np.maximum(share[y], 1)) / len(classes))[:, None]
    w, b = np.zeros((len(used), len(classes))), np.zeros(len(classes))
    gw, gb = np.full_like(w, 1e-8), np.full_like(b, 1e-8)
    target = np.eye(len(classes))[y]

    def softmax(z):
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    for _ in range(s.steps):
        d = (softmax(x @ w.astype(np.float32) + b) - target) * each
        g, h = x.T @ d.astype(np.float32), d.sum(0)
        gw += g * g
        gb += h * h
        step = s.rate / np.sqrt(gw)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * s.l1, 0)
        b -= s.rate / np.sqrt(gb) * h
    z = x[held] @ w + b
    grid = np.geomspace(0.25, 8, 31)
    loss = [-np.log(softmax(z / t)[np.arange(len(z)), y[held]] + 1e-12).mean() for t in grid]
    dense = np.zeros((1 << s.bits, len(classes)), np.float32)
    dense[used] = w
    return Model(classes, dense, b, float(grid[int(np.argmin(loss))]))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> Model:
    """A model whose "unknown" is prose of at most max_docs documents and max_lines lines of up to max_chars characters."""
    s = settings
    order = F.xxhash64(F.col(id_col).cast("string"))
    ids = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(s.max_docs)
    lines = (
        docs.join(F.broadcast(ids.withColumnRenamed("id", id_col)), id_col, "left_semi")  # at most max_docs ids
        .select(order.alias("place"), F.posexplode(F.split(F.col(text_col), "\n")).alias("at", "line"))
        .where(F.length("line").between(1, s.max_chars))
        .orderBy("place", "at", "line")
        .limit(s.max_lines)
    )
    return fit([r["line"] for r in lines.collect()], s)


def scan(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """(id_col, found array<struct<family, start, end, probability>>): the confirmed paragraphs of
    every text in order, once per licence, positions in code points; probability is that of a licence
    of any family."""
    s = settings
    shared = docs.sparkSession.sparkContext.broadcast(model)  # 2 ** bits rows of one number per class
    entry = pa.struct([("family", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())])

    def run(batches):
        m = shared.value
        scorer = Scorer(m, s)
        for batch in batches:
            offs, data = buffers(batch.column("text"))
            for lo, hi in blocks(offs):
                # paragraphs of all texts as texts of their own; a line break stands in no word
                base, end = int(offs[lo]), int(offs[hi])
                ink = np.cumsum(SOLID[data[base:end]] != 0, dtype=np.int32)
                line_ends = np.flatnonzero(data[base:end] == 10)
                breaks = line_ends[1:][ink[line_ends[1:]] == ink[line_ends[:-1]]] + base + 1
                cut = np.unique(np.concatenate([offs[lo : hi + 1], breaks]))
                found: list[list[dict]] = [[] for _ in range(hi - lo)]
                if len(cut) > 1:
                    w = find_words(cut, data, ALNUM)
                    best: dict[tuple[int, str], float] = {}
                    text = lambda a, b: data[base + a : base + b].tobytes().decode("utf-8", "replace")
                    notices = scorer.notices(w)
                    for x, after in zip(notices, [*notices[1:], None]):
                        far = min(x.end + _BEHIND, w.first[x.line + 1], after.start if after else len(w.hash))
                        end = w.end[x.end - 1]
                        name = licence_name(m.classes[x.label], text(w.start[x.start], end), text(end, w.end[far - 1]))
                        best[x.line, name] = max(x.sure, best.get((x.line, name), 0.0))
                    lacks_version = lambda line, name: any(k == line and other.startswith(name + "-") for k, other in best)
                    chars = lambda u, v: int(((data[u:v] & 0xC0) != 0x80).sum())
                    for (line, family), sure in sorted(best.items()):
                        if lacks_version(line, family) or (family == UNKNOWN and any(k == line and other != UNKNOWN for k, other in best)):
                            continue
                        a, b = int(cut[line]), int(cut[line + 1])
                        doc = int(np.searchsorted(offs[lo : hi + 1], a, "right")) - 1
                        inked = np.flatnonzero(SOLID[data[a:b]])
                        a, b = a + int(inked[0]), a + int(inked[-1]) + 1
                        start = chars(int(offs[lo + doc]), a)
                        stop = start + chars(a, b)
                        found[doc].append({"family": family, "start": start, "end": stop, "probability": sure})
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(lo, hi - lo), pa.array(found, pa.list_(entry))], ["id", "found"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, found array<struct<family:string,start:int,end:int,probability:double>>")
    return out.withColumnRenamed("id", id_col)


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id_col, licences, n_paragraphs, spans) from `scan`: families sorted and joined by commas."""
    return found.select(
        id_col,
        F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["family"]))), ",").alias("licences"),
        F.size(F.array_distinct(F.transform("found", lambda x: x["start"]))).cast("long").alias("n_paragraphs"),
        F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["family"], x["start"], x["end"])), ",").alias("spans"),
    )
