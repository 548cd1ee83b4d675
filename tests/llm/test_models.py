"""Statistics and learned operators: brute force, held-out accuracy and edge cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from meterflow.llm import importance, license_scan, quality_rules, toxicity

DOCS = "doc_id long, text string, h string, label string, bad string"
EDGE = [(900, None), (901, ""), (902, " \n\t "), (903, "word"), (904, "x y " * 6000), (905, "x y " * 6000), (None, "a b")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], DOCS)


def stats(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    n, hit = Counter(win), set()
    for i, x in enumerate(win):
        if n[x] > 1:
            hit |= set(range(i, i + 8))
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit)


def test_statistics_brute_force(spark):
    rng = random.Random(9)
    vocab = ["a", "Ärger", "#tag", "<b>", "日本", "x|y", "é\x0b", " ", "z\n", "\n\n", "\t", "50%"]
    rows = [(i, " ".join(rng.choice(vocab[: rng.choice([2, 12])]) for _ in range(rng.randint(0, 60)))) for i in range(80)] + EDGE
    rows += [(700, "l1 a\nl1 a\r\nl1 a\n\nl1 a"), (701, ("p q r s t u v w " * 2).strip()), (702, "q " * 9)]
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.statistics(table(spark, rows)).collect()}
    assert got == {i: stats(t) for i, t in rows}


def prose(rng, n=60):
    return " ".join(rng.choice(["the", "river", "was", "cold", "and", "deep", "they", "walked", "home", "again"]) + rng.choice(["", "", "", ","]) for _ in range(n))


def corpus(seed, n=240):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        t = prose(rng, rng.randint(25, 120))
        if bad:
            t = " ".join(w + rng.choice(["%%%", "***", "|"]) for w in t.split())
        rows.append((i, t))
        if i % 2 == 0 or i % 3 == 0:
            labels.append((i, 0 if bad else 1, int(bad)))
    return rows, labels


def test_decision_list_learns_and_is_native(spark, capsys):
    rows, labels = corpus(1)
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = quality_rules.judge(table(spark, rows + EDGE), y)
    got = {r.doc_id: r for r in out.collect()}
    for i, t in rows:
        n, _, _, _, rep = stats(t)
        failed = n < 20 or 100 * rep > 30 * n
        assert got[i].base_failed == failed
        assert got[i].kept == (not failed and i % 4 != 0)
    assert not got[900].kept and got[900].base_failed and got[901].n_words == 0
    out.explain("simple")
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)
    nothing = quality_rules.judge(table(spark, rows), y.limit(0))
    assert all(r.kept == (not r.base_failed) for r in nothing.collect())
    assert quality_rules.judge(table(spark, []), y).count() == 0


def test_importance_keeps_target_like_text(spark):
    rows, labels = corpus(2)
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = table(spark, rows + EDGE[:3])
    got = {r.doc_id: r.kept for r in importance.resample(df, y).collect()}
    assert all(got[i] == (i % 4 != 0) for i, _ in rows)
    assert {r.doc_id: r.kept for r in importance.resample(df.repartition(7), y).collect()} == got
    assert all(r.kept for r in importance.resample(df, y.limit(0)).collect())
    assert importance.resample(table(spark, []), y).count() == 0


def test_kth_largest(spark):
    rng = random.Random(1)
    v = [rng.choice([0, 5, 2**16, 2**40 + rng.randint(0, 9), 2**62]) for _ in range(200)]
    df = spark.createDataFrame([(x,) for x in v], "v long")
    for k in (1, 2, 50, 199, 200):
        assert importance.kth_largest(df, "v", k) == sorted(v)[-k]


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(400):
        bad = i % 5 == 0
        words = prose(rng, 50).split()
        if bad:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["slurone", "slurtwo"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in toxicity.classify(table(spark, rows + EDGE), y).collect()}
    for i, _ in rows:
        assert out[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
        assert out[i].predicted == int(i % 5 == 0) and 0 <= out[i].score <= 1
    assert out[900].score == out[901].score and out[904].score == out[905].score and out[None].held_out is False
    # labels of held-out rows are never read
    flipped = spark.createDataFrame([(i, q, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    same = {r.doc_id: r.score for r in toxicity.classify(table(spark, rows), flipped).collect()}
    assert all(same[i] == pytest.approx(out[i].score) for i, _ in rows)
    assert {r.predicted for r in toxicity.classify(table(spark, rows), y.limit(0)).collect()} == {0}


def test_licences(spark):
    rng = random.Random(6)
    rows = [(i, "\n".join(prose(rng) for _ in range(3))) for i in range(60)]
    rows += [
        (100, "é intro\n \nLicensed under the Apache\nLicense, Version 2.0.\n\nmore"), (101, "Released under the MIT License."),
        (102, "Licensed under CC BY-NC 4.0.\n\nThis work is licensed under the GNU General Public License, version 3."),
        (103, "A licence to drive; the driver's license was released under a bridge."), *EDGE,
    ]
    df = table(spark, rows)
    got = {r.doc_id: r for r in license_scan.digest(license_scan.scan(df, license_scan.train(df))).collect()}
    assert got[100].spans == "Apache-2.0:10:57" and got[101].licences == "MIT"
    assert got[102].licences == "CC-BY-NC-4.0,GPL-3.0" and got[102].n_paragraphs == 2
    assert all(got[i].licences == "" for i, _ in rows if i not in (100, 101, 102))
    model = license_scan.fit([])
    assert license_scan.scan(df.limit(0), model).count() == 0


def test_gumbel_free_features_are_partition_independent():
    import pyarrow as pa

    from meterflow.llm.text import SOLID, buffers, find_words

    offs, data = buffers(pa.array(["aa aa B!! 9", None, "", "aa", "x" * 3000]))
    w = find_words(offs, data, SOLID)
    assert np.diff(w.first).tolist() == [4, 0, 0, 1, 1]
    assert w.hash[0] == w.hash[1] == w.hash[4] and w.word(2) == "B!!"
    assert len(set(importance.shape_hashes(w).tolist())) == 3


NOTICES = {
    "Released under the MIT License.": "MIT",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
    "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files": "MIT",
    "Released under the 3-Clause BSD License.": "BSD-3-Clause",
}


def test_licence_notices_inside_long_paragraphs(spark):
    rng = random.Random(8)
    rows = [(i, "\n".join(prose(rng) for _ in range(3))) for i in range(60)]
    inside = {}
    for notice, family in NOTICES.items():
        for n in (5, 20, 100):
            inside[1000 + len(inside)] = (f"{prose(rng, n)} {notice} {prose(rng, n)}", family)
    both = f"{prose(rng)} Licensed under CC BY 4.0. {prose(rng)} Released under the MIT License. {prose(rng)}"
    df = table(spark, rows + [(i, t) for i, (t, _) in inside.items()] + [(2000, both)])
    got = {r.doc_id: r for r in license_scan.digest(license_scan.scan(df, license_scan.train(table(spark, rows)))).collect()}
    assert {i: got[i].licences for i in inside} == {i: f for i, (_, f) in inside.items()}
    assert got[2000].licences == "CC-BY-4.0,MIT" and got[2000].n_paragraphs == 1
    assert all(got[i].licences == "" for i, _ in rows)


NEAR = {
    "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
    "This library is licensed under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1",
    "This work is licensed under the GNU Lesser General Public License, version 3.": "LGPL-3.0",
    "This program is licensed under the GNU Affero General Public License, version 3.": "AGPL-3.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 1.1.": "MPL-1.1",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.": "MPL-2.0",
    "Licensed under CC BY-NC-ND 4.0.": "CC-BY-NC-ND-4.0",
    "Licensed under CC BY-NC-SA 4.0.": "CC-BY-NC-SA-4.0",
    "Licensed under CC BY 3.0.": "CC-BY-3.0",
    "Licensed under the Apache License, Version 1.1.": "Apache-1.1",
    "Released under the 2-Clause BSD License.": "BSD-2-Clause",
    "Released under the zlib License.": "Zlib",
    "Licensed under the GNU General Public License, version 7.": "GPL",
    "Distributed under the Boost Software License, Version 1.0.": "BSL-1.0",
    "Licensed under the Eclipse Public License, version 1.0.": "EPL-1.0",
    "Licensed under the Artistic License 2.0.": "",
    "SPDX-License-Identifier: GPL-2.0-only": "GPL-2.0",
    "SPDX-License-Identifier: Apache-2.0": "Apache-2.0",
    "SPDX-License-Identifier: MIT": "MIT",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
    "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.": "GPL-3.0",
}


def test_licence_versions_and_variants(spark):
    rng = random.Random(9)
    rows = [(i, "\n".join(prose(rng) for _ in range(3))) for i in range(60)]
    near = {1000 + i: f for i, f in enumerate(NEAR.values())}
    texts = [(1000 + i, t) for i, t in enumerate(NEAR)] + [(2000 + i, f"{prose(rng, 30)} {t} {prose(rng, 30)}") for i, t in enumerate(NEAR)]
    df = table(spark, rows + texts)
    got = {r.doc_id: r.licences for r in license_scan.digest(license_scan.scan(df, license_scan.train(table(spark, rows)))).collect()}
    assert {i: got[i] for i in near} == near
    assert {i: got[i + 1000] for i in near} == near
    # every template is found, with the name its own words give
    assert license_scan.licence_name("MIT", "SPDX-License-Identifier: Zlib") == "unknown"
    assert license_scan.licence_name("BSD-3-Clause", "Redistribution and use in source and binary forms") == "BSD"


def test_best_condition_brute_force():
    import math

    rng = random.Random(14)
    for _ in range(40):
        cuts = {f: [float(i) for i in range(rng.randint(0, 6))] for f in ("a", "b", "c")}
        rows = [({f: rng.randint(0, len(cuts[f])) for f in cuts}, rng.random() < 0.4) for _ in range(rng.randint(1, 60))]
        counts = []
        for f in cuts:
            for b in {r[f] for r, _ in rows}:
                counts.append({"f": f, "b": b, "p": sum(bad for r, bad in rows if r[f] == b), "n": sum(not bad for r, bad in rows if r[f] == b)})
        got = quality_rules._best_condition(counts, cuts)
        p, n = sum(bad for _, bad in rows), sum(not bad for _, bad in rows)
        gains = {}
        for f in cuts:
            for b in range(1, len(cuts[f]) + 1):
                for above in (True, False):
                    inside = [bad for r, bad in rows if (r[f] >= b) == above]
                    if p and n and sum(inside):
                        gains[f, b, above] = sum(inside) * (math.log2(sum(inside) / len(inside)) - math.log2(p / (p + n)))
        best = max(gains.values(), default=0)
        if best <= 1e-9:
            assert got is None
        else:
            assert gains[got.feature, got.bin, got.above] == pytest.approx(best) and got.cut == cuts[got.feature][got.bin - 1]


def test_list_is_learned_on_rows_that_the_base_rules_leave_open(spark):
    rng = random.Random(15)
    rows = [(i, prose(rng, 60)) for i in range(60)] + [(100 + i, "again and again " * 3) for i in range(40)]
    y = spark.createDataFrame([(i, int(i < 100), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.judge(table(spark, rows), y).collect()}
    assert all(got[i] == ((False, True) if i < 100 else (True, False)) for i, _ in rows)


def test_ftrl_equals_plain_loops():
    import math

    rng = random.Random(16)
    s = toxicity.Ftrl(bits=6, l1=0.5, epochs=3, min_rows=2)
    xs = [np.array(sorted(rng.sample(range(64), rng.randint(1, 12)))) for _ in range(80)]
    ys = [int(7 in x or rng.random() < 0.2) for x in xs]
    slots, weights, bias = toxicity.fit(xs, ys, s)
    seen = Counter(k for x in xs for k in x.tolist())
    z, n = Counter(), Counter()
    rate = (sum(ys) + 0.5) / (len(ys) + 1)
    b0, b, nb = math.log(rate / (1 - rate)), 0.0, 0.0

    def weight(k):
        if abs(z[k]) <= s.l1:
            return 0.0
        return -(z[k] - math.copysign(s.l1, z[k])) / ((s.beta + math.sqrt(n[k])) / s.alpha + s.l2)

    for epoch in range(s.epochs):
        for i in np.random.default_rng(epoch).permutation(len(xs)):
            live = [k for k in xs[i].tolist() if seen[k] >= 2]
            w = {k: weight(k) for k in live}
            g = (1 / (1 + math.exp(-(b0 + b + sum(w.values())))) - ys[i]) * (s.positive if ys[i] else 1)
            for k in live:
                z[k] += g - (math.sqrt(n[k] + g * g) - math.sqrt(n[k])) / s.alpha * w[k]
                n[k] += g * g
            nb += g * g
            b -= s.alpha * g / (s.beta + math.sqrt(nb))
    assert dict(zip(slots.tolist(), weights)) == pytest.approx({k: weight(k) for k in seen if weight(k)}) and bias == pytest.approx(b0 + b)


def test_toxicity_scores_are_the_sums_of_weights(spark):
    import math

    from meterflow.llm.text import ALNUM, buffers, find_words
    import pyarrow as pa

    rows = [(1, "one two three two"), (2, "two"), (3, None), (4, "three one")]
    s = toxicity.Ftrl(bits=8)
    rng = np.random.default_rng(3)
    weights = {int(k): float(np.float32(rng.normal())) for k in rng.choice(256, 120, replace=False)} | {-1: -0.5}
    got = {r.doc_id: r.score for r in toxicity.score(table(spark, rows), weights, settings=s).collect()}
    for i, t in rows:
        offs, data = buffers(pa.array([t], pa.string()))
        _, slots = toxicity.features(find_words(offs, data, ALNUM), s.bits)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-(-0.5 + sum(weights.get(k, 0.0) for k in set(slots.tolist()))))))
    # odd labels, an empty table, a bound on features
    y = spark.createDataFrame([(1, 1, 7), (2, 1, None), (4, 1, -1)], "doc_id long, quality int, toxic int")
    assert len({r.score for r in toxicity.classify(table(spark, rows), y).collect()}) == 1
    assert toxicity.classify(table(spark, []), y).count() == 0
    two = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.classify(table(spark, rows), two, settings=toxicity.Ftrl(max_features=1)).count() == 4


def test_importance_equals_plain_python(spark):
    import math

    import pyarrow as pa
    from pyspark.sql import functions as F

    from meterflow.llm.text import SOLID, buffers, find_words

    rows, labels = corpus(7, 120)
    rows += [(500, rows[1][1]), (500, rows[1][1]), (None, "a b c"), (501, None)]
    y = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df, s = table(spark, rows), importance.Settings(bits=10)
    out = importance.resample(df, y, settings=s).collect()
    picked = {r.id: (r.label, r.half) for r in importance.labelled(y, "doc_id", "quality", s.max_labels).collect()}

    def slots(t):
        offs, data = buffers(pa.array([t], pa.string()))
        return importance.features(find_words(offs, data, SOLID), s.bits)[1].tolist()

    raw, target = Counter(), Counter()
    for i, t in rows:
        raw.update(slots(t))
        if picked.get(i) == (1, 1):
            target.update(slots(t))
    size = 1 << s.bits
    sums = {id(c): sum(c.values()) + size * s.smooth for c in (raw, target)}
    ratio = lambda k: math.log((target[k] + s.smooth) / sums[id(target)]) - math.log((raw[k] + s.smooth) / sums[id(raw)])
    weight = {}
    for i, t in rows:
        f = slots(t)
        weight[i] = sum(map(ratio, f)) * s.length / (len(f) + s.length)
    assert all(r.log_weight == pytest.approx(weight[r.doc_id], abs=1e-9) for r in out)
    # the cut that separates best, then the k largest sums of weight and noise
    known = sorted((weight[i], label) for i, (label, half) in picked.items() if label == 0 or half == 0)
    good, bad = sum(x[1] for x in known), sum(1 - x[1] for x in known)
    at = max(range(len(known) + 1), key=lambda k: (sum(1 - y for _, y in known[:k]) / bad + sum(y for _, y in known[k:]) / good, -k))
    cut = -math.inf if at == 0 else (known[at - 1][0] + known[min(at, len(known) - 1)][0]) / 2
    k = sum(r.log_weight >= cut for r in out)
    noise = spark.createDataFrame([(r.doc_id, r.log_weight) for r in out], "id long, log_weight double").select("id", "log_weight", F.xxhash64("id", "log_weight", F.lit("gumbel")).alias("h")).collect()
    key = lambda r: int((r.log_weight - math.log(-math.log((((r.h & (2**64 - 1)) >> 11) + 0.5) * 2.0**-53))) * 1e6)
    least = sorted(map(key, noise))[-k]
    assert Counter((r.doc_id, r.kept) for r in out) == Counter((r.id, key(r) >= least) for r in noise)
    kept = importance.keep_sampled(df, y, settings=s)
    assert kept.columns == df.columns and Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in out if r.kept)


def test_licence_probabilities_are_a_softmax():
    import math

    model = license_scan.fit(["the river was cold and deep", "they walked home again"])
    w = license_scan._block(["Released under the MIT License. and more words"])
    got = license_scan.probabilities(model, w, 0, 5, 16)
    h = w.hash[:5]
    from meterflow.llm.text import grams, mix

    slots = [int(x) >> 48 for x in [*mix(h), *grams(h, np.full(5, 5), 2)[1]]]
    z = [sum(float(model.weights[k][c]) for k in slots) / math.sqrt(len(slots)) + model.bias[c] for c in range(len(model.classes))]
    e = [math.exp(x / model.temperature) for x in z]
    assert got.tolist() == pytest.approx([x / sum(e) for x in e], rel=1e-4)
    assert model.classes[int(got.argmax())] == "MIT" and got[0] < 0.5


def test_licences_of_wrapped_texts(spark):
    """Notices over several lines; one version beside the bare family; ties of two templates."""
    rng = random.Random(18)
    wrapped = "Redistribution and use in source and binary\nforms, with or without modification, are permitted provided that the\nfollowing conditions are met:\nNeither the name of the copyright\nholder nor the names of its contributors may be used to endorse or\npromote products derived from this software"
    texts = [(1, f"{prose(rng)}\n\n{wrapped}\n\n{prose(rng)}"), (2, "Licensed under the\nGNU General Public License, version 2\n"), (3, None), (4, "")]
    df = table(spark, texts + texts)
    model = license_scan.train(table(spark, [(i, prose(rng)) for i in range(50)]))
    got = license_scan.digest(license_scan.scan(df, model)).collect()
    assert Counter((r.doc_id, r.licences) for r in got) == Counter({(1, "BSD-3-Clause"): 2, (2, "GPL-2.0"): 2, (3, ""): 2, (4, ""): 2})
    start = texts[0][1].index("Redis")
    assert next(r.spans for r in got if r.doc_id == 1) == f"BSD-3-Clause:{start}:{start + len(wrapped)}"


def test_very_long_texts_and_null_ids(spark):
    """Statistics and scores of texts of some megabytes, beside null ids; a text and its repetition agree."""
    rng = random.Random(33)
    line = prose(rng, 40)
    rows = [(i, prose(rng)) for i in range(40)] + [(900, "\n".join([line] * 12_000)), (None, line), (None, None)]
    y = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(40)], "doc_id long, quality int, toxic boolean").selectExpr("doc_id", "quality", "cast(toxic as int) as toxic")
    stats = {r.doc_id: r for r in quality_rules.judge(table(spark, rows), y).where("doc_id = 900").collect()}
    assert (stats[900].n_words, stats[900].n_dup_lines, stats[900].base_failed) == (480_000, 11_999, True)
    scores = toxicity.classify(table(spark, rows), y).collect()
    assert len(scores) == len(rows) and all(0 <= r.score <= 1 for r in scores)
    weighed = importance.resample(table(spark, rows), y).collect()
    assert len(weighed) == len(rows)
