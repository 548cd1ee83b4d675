"""Near-duplicate classes against brute force, and the signatures against their definition."""

import random
import re
from collections import Counter

import numpy as np

from meterflow.llm import dart_minhash as dm

DOCS = "doc_id long, text string, units string, node string"


def shingles(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)])


def classes(docs):
    sets = {d: shingles(t) for d, t in docs}
    top = {d: d for d in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    text = dict(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            joint = sum((x | y).values())
            if sum((x & y).values()) >= 0.8 * joint if joint else (text[a] or "") == (text[b] or ""):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return {d: find(d) for d in ids}


def test_classes_equal_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(300)]
    docs, d = [], 0
    for group in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 30, 120, 400]))]
        for _ in range(rng.choice([1, 2, 6, 14])):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            docs.append((d, rng.choice([" ", ", "]).join(words)))
            d += 7
    # a chain: neighbours are similar, ends are not
    chain = [rng.choice(vocab) for _ in range(200)]
    for k in range(8):
        docs.append((d, " ".join(chain)))
        d += 1
        for j in range(3):
            chain[(k * 31 + j * 9) % 200] = f"n{k}_{j}"
    docs += [(d + 1, None), (d + 2, ""), (d + 3, "!!"), (d + 4, "!!"), (d + 5, "one"), (d + 6, "ONE!"), (d + 7, "x y " * 4000), (d + 8, "x y " * 4000)]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in docs], DOCS)
    got = {r.doc_id: r.class_id for r in dm.duplicate_classes(df).collect()}
    assert got == classes(docs)
    # the same with all buckets compared in blocks
    blocked = dm.duplicate_classes(df, settings=dm.Settings(small=1, block=3)).collect()
    assert {r.doc_id: r.class_id for r in blocked} == got
    again = dm.duplicate_classes(df.unionByName(df)).collect()
    assert len(again) == len(docs) and {r.doc_id: r.class_id for r in again} == got
    assert all(r.representative == (r.doc_id == r.class_id) for r in again)


def test_texts_that_share_a_passage(spark):
    """Several hundred texts that share a passage and fill large buckets, with planted pairs among them."""
    rng = random.Random(21)
    vocab = [f"w{i}" for i in range(5000)]
    passage = [rng.choice(vocab) for _ in range(60)]
    docs = []
    for i in range(300):
        docs.append((i, " ".join(passage + [rng.choice(vocab) for _ in range(40)])))
    for i in range(0, 300, 10):
        words = docs[i][1].split()
        words[90 + i % 7] = "changed"
        docs.append((1000 + i, " ".join(words)))
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in docs], DOCS)
    want = classes(docs)
    for settings in (dm.Settings(), dm.Settings(small=1, block=16)):
        assert {r.doc_id: r.class_id for r in dm.duplicate_classes(df, settings=settings).collect()} == want


def test_prefix_filter_keeps_every_similar_pair(spark):
    rng = random.Random(22)
    rows = []
    for i in range(120):
        base = [rng.randrange(400) for _ in range(40)] if i % 2 == 0 else [u if rng.random() < 0.9 else rng.randrange(400) for u in rows[-1][1]]
        rows.append((i, sorted(set(base))))
    units = spark.createDataFrame(rows, "node long, units array<long>")
    component = spark.createDataFrame([(i, i - i % 6) for i, _ in rows], "node long, component long")
    kept = {r.node for r in dm.rare_partners(component, units, dm.Settings()).collect()}
    sets = {i: set(u) for i, u in rows}
    for a in sets:
        for b in sets:
            if a - a % 6 != b - b % 6 and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                assert a in kept and b in kept
    lone = spark.createDataFrame([(i, list(range(100 * i, 100 * i + 60)) + list(range(-25, 0))) for i in range(20)], "node long, units array<long>")
    assert dm.rare_partners(lone.selectExpr("node", "node as component"), lone, dm.Settings()).count() == 0


def test_different_texts_under_one_id(spark):
    a, b = "one two three four five six seven", "some other words that are not alike at all"
    rows = [(1, a), (1, b), (2, b), (3, a), (3, a), (3, b), (4, "alone in the world is this one")]
    df = spark.createDataFrame([(i, t, None, None) for i, t in rows], DOCS)
    got = sorted(tuple(r) for r in dm.duplicate_classes(df).collect())
    assert got == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]
    keyed = df.selectExpr("struct(doc_id, monotonically_increasing_id() as k) as row", "text")
    assert sum(r.representative for r in dm.duplicate_classes(keyed, "row").collect()) == 3


def test_empty_table_and_null_ids(spark):
    assert dm.duplicate_classes(spark.createDataFrame([], DOCS)).count() == 0
    one = spark.createDataFrame([(None, "a b c d e f", None, None), (1, "a b c d e f", None, None)], DOCS)
    assert [tuple(r) for r in dm.duplicate_classes(one).collect()] == [(1, 1, True)]


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    element = rng.integers(1, 2**63, 60).astype(np.uint64)
    a, b = rng.gamma(1.0, 3.0, 60), rng.gamma(1.0, 3.0, 60)
    b[:40] = a[:40]
    k = 4096
    sig = dm.signatures(np.repeat([0, 1], 60), np.concatenate([element, element]), np.concatenate([a, b]), 3, k)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04
    assert (sig[2] == np.uint64(2**64 - 1)).all() and (sig[:2] != np.uint64(2**64 - 1)).all()
    # the same whatever else is in the block
    alone = dm.signatures(np.zeros(60, int), element, b, 1, k)
    assert (alone[0] == sig[1]).all()
