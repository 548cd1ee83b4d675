"""The licence scan: the classifier decides, templates confirm; against a plain form of the whole search."""

import random
import re

import numpy as np
import pytest

from meterflow.llm import license_scan as scan
from meterflow.llm.text import ALNUM, buffers, find_words, mix

NOTICES = {
    "Licensed under GPLv3": "GPL-3.0", "Licensed under the Apache 2.0 license": "Apache-2.0", "Licensed under the Mozilla Public License 2.0": "MPL-2.0", "This project uses the MIT license": "MIT",
    "Available under BSD-3-Clause": "BSD-3-Clause", "Dual licensed under MIT and Apache-2.0": "Apache-2.0,MIT", "CC BY-NC-ND 4.0": "CC-BY-NC-ND-4.0", "SPDX-License-Identifier: ISC": "ISC",
    "SPDX-License-Identifier: LGPL-3.0-only": "LGPL-3.0", "SPDX-License-Identifier: MPL-2.0": "MPL-2.0", "SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT", "licensed under the GPL-2.0 or GPL-3.0": "GPL-2.0,GPL-3.0",
    "Licensed under the Artistic License 2.0": "", "SPDX-License-Identifier: EUPL-1.2": "", "people at MIT drank tea": "", "an Apache helicopter": "",
}


def prose(rng, n=80):
    word = lambda: "".join(rng.choice(["ka", "to", "mi", "re", "su", "lan", "der", "the", "of"]) for _ in range(rng.randint(1, 3)))
    return " ".join(word() for _ in range(n))


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    return scan.fit([prose(rng) for _ in range(200)])


def licences(spark, texts, model):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'x' as id", "'y' as found", "'z' as family")
    return [r.licences for r in scan.digest(scan.scan(df, model)).orderBy("doc_id").collect()]


def test_notices_within_long_paragraphs(spark, model):
    rng = random.Random(3)
    texts = [f"{prose(rng, n)} {t} {prose(rng, n)}" for t in NOTICES for n in (0, 3, 60, 100)]
    want = [names for names in NOTICES.values() for _ in range(4)]
    assert dict(zip(texts, licences(spark, texts, model))) == dict(zip(texts, want))


def test_the_classifier_decides(spark, model):
    """With its families turned by one class, or with nothing but "unknown", nothing is left: templates of
    another family do not confirm, and templates alone find nothing."""
    texts = [t for t, names in NOTICES.items() if names]
    turned = scan.Model(model.classes, np.concatenate([model.weights[:, :1], np.roll(model.weights[:, 1:], 5, 1)], 1), np.r_[model.bias[:1], np.roll(model.bias[1:], 5)], model.temperature)
    blind = scan.Model(model.classes, np.zeros_like(model.weights), np.r_[9.0, np.zeros(len(model.classes) - 1)], model.temperature)
    assert not any(licences(spark, texts, blind))
    assert sum(map(bool, licences(spark, texts, turned))) <= 1 < sum(map(bool, licences(spark, texts, model)))


def plain_way(model, text, s=scan.Settings()):
    """[(first word, end, family)] of a paragraph by loops over words, all on strings."""
    offs, data = buffers(__import__("pyarrow").array([text]))
    w = find_words(offs, data, ALNUM)
    words = [w.word(i) for i in range(len(w.hash))]
    margin = model.weights[:, 1:].max(1) - model.weights[:, 0]
    slot = lambda h: int(h) >> (64 - s.bits)
    pair_hash = [int(scan.grams(w.hash[i : i + 2], np.array([2, 2]), 2)[1][0]) for i in range(len(words) - 1)]
    best = {}
    for a in range(len(words)):
        if max(margin[slot(mix(w.hash[a : a + 1])[0])], margin[slot(pair_hash[a])] if a < len(pair_hash) else -9) < s.evidence:
            continue
        for e in sorted({min(a + n, len(words)) for n in scan.LENGTHS}):
            p = scan.probabilities(model, w, a, e, s.bits)
            y = int(p.argmax())
            if y and p[0] < 0.5:
                best.setdefault((a, y), []).append((float(p[y]), e))
    rows = []
    for (a, y), found in best.items():
        top = max(p for p, _ in found)
        p, e = max((x for x in found if x[0] >= 0.9 * top), key=lambda x: x[1])
        rows.append((-round(p, 1), a - e, a, e, y))
    low = lambda t: re.findall(r"[0-9a-z]+|[^\x00-\x7f]+", t.lower())
    speaks = [low(t) for t in scan.SPEAKS]

    def confirmed(y, a, e):
        family, hits = model.classes[y], []
        for name in scan.NAMES[family]:
            n = low(name)
            plain = re.search("licen[sc]e", name, re.I) or (family in scan.PLAIN and re.search(r"\d", name))
            for i in range(a, e - len(n) + 1):
                around = words[max(0, i - 8) : i + len(n) + 8]
                if words[i : i + len(n)] == n and (plain or any(around[k : k + len(x)] == x for x in speaks for k in range(len(around)))):
                    hits.append((-len(n), i, i + len(n)))
        if hits:
            return (*min(hits)[1:], True)
        own = {(words[i], words[i + 1]) for i in range(a, e - 1)}
        for key, texts in scan.TEMPLATES.items():
            if scan.family_of(key) == family:
                for t in texts:
                    x = low(t)
                    pairs = set(zip(x, x[1:])) - {q for phrase in scan.PHRASES for part in phrase.split("{}") for q in zip(low(part), low(part)[1:])}
                    if len(pairs) >= 4 and len(own & pairs) >= max(4, 0.6 * min(len(pairs), len(own))):
                        return a, e, False
        return None

    taken, out = set(), []
    for _, _, a, e, y in sorted(rows):
        at = confirmed(y, a, e)
        if at and not taken & set(range(at[0], at[1])):
            taken |= set(range(at[0], at[1]))
            out.append((at[0], at[1], y, at[2]))
    merged = []
    for x in sorted(out):
        if merged and merged[-1][2] == x[2] and x[0] - merged[-1][1] <= 8 and not (merged[-1][3] and x[3]):
            merged[-1] = (merged[-1][0], x[1], x[2], False)
        else:
            merged.append(x)
    return [(a, e, model.classes[y]) for a, e, y, _ in merged]


def test_search_against_loops(model):
    rng = random.Random(4)
    whole = [t for texts in scan.TEMPLATES.values() for t in texts] + list(NOTICES) + scan.NEAR_MISSES
    scorer = scan.Scorer(model, scan.Settings())
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 4)):
            t = rng.choice(whole).split()
            lo = rng.randint(0, max(len(t) - 4, 0)) if rng.random() < 0.5 else 0
            parts += [prose(rng, rng.randint(0, 12)), " ".join(w for w in t[lo:] if rng.random() < 0.95)]
        text = " ".join(parts)
        got = [(x.start, x.end, model.classes[x.label]) for x in scorer.notices(scan._block([text]))]
        assert got == plain_way(model, text), text


def test_odd_rows(spark, model):
    texts = [None, "", "MIT " * 30_000, "\n\n\n", "x" * 300_000, "Released under the MIT License.\n\n" * 3]
    got = licences(spark, texts, model)
    assert got[:2] == ["", ""] and got[3:] == ["", "", "MIT"]
    df = spark.createDataFrame([(None, "Licensed under GPLv3"), (None, None)], "doc_id long, text string")
    assert sorted(r.licences for r in scan.digest(scan.scan(df, model)).collect()) == ["", "GPL-3.0"]
