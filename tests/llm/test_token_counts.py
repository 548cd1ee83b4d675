"""Trie-shared counts against a plain dynamic programme; pipeline stages against their rules."""

import math
import random

import regex

from meterflow.llm import token_counts as tc

DOCS = "doc_id long, text string, n_tokens string"


def plain(piece, scores):
    raw = piece.encode()
    best = [(0.0, 0)]
    for i in range(1, len(raw) + 1):
        best.append(max((best[j][0] + scores[raw[j:i]], best[j][1] - 1) for j in range(max(0, i - 8), i) if raw[j:i] in scores))
    return -best[-1][1]


def test_counts_equal_plain_programme():
    rng = random.Random(8)
    scores = {bytes([b]): -6.0 - rng.random() for b in range(256)}
    for _ in range(300):
        scores.setdefault("".join(rng.choice("abcé") for _ in range(rng.randint(2, 4))).encode(), -5 * rng.random() - 2)
    scores[b"tie"] = scores[b"t"] + scores[b"i"] + scores[b"e"]
    model = tc.UnigramCounter(scores, r"\S+|\s+")
    words = {"".join(rng.choice("abcéd") for _ in range(rng.randint(1, 30))) for _ in range(400)} | {"tie", "ties"}
    model.learn(words)
    assert all(model.known[w] == plain(w, scores) for w in words)
    prefixes = {w.encode()[:i] for w in words for i in range(1, len(w.encode()) + 1)}
    assert model.nodes == len(prefixes)


def test_texts(spark):
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    model = tc.counter(path, P.PATTERN)
    assert model.scores[b"a"] < 0 and math.isfinite(min(model.scores.values()))
    texts = ["the theatre's 日本 the", None, "", " ", "é" * 3000, "the theatre's 日本 the"]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r for r in tc.count_tokens(df, path, P.PATTERN).collect()}
    longest = max(map(len, model.scores))
    for i, t in enumerate(texts):
        total = 0
        for p in regex.findall(P.PATTERN, t or ""):
            raw, best = p.encode(), [(0.0, 0)]
            for e in range(1, len(raw) + 1):
                best.append(max((best[s][0] + model.scores[raw[s:e]], best[s][1] - 1) for s in range(max(0, e - longest), e) if raw[s:e] in model.scores))
            total -= best[-1][1]
        assert (got[i].n_tokens, got[i].n_bytes) == (total, len((t or "").encode()))
    assert tc.count_tokens(df.limit(0), path, P.PATTERN).count() == 0


def test_null_ids_and_a_very_long_text(spark):
    import public_tokenizers as P

    path = P.path("byte_bpe_multi_50k.tiktoken")
    texts = [("a", "one two"), (None, "one two"), (None, None), ("long", " one two" * 150_000), ("short", " one two")]
    df = spark.createDataFrame(texts, "doc_id string, text string")
    got = [(r.doc_id, r.n_tokens, r.n_bytes) for r in tc.count_tokens(df, path, P.PATTERN).collect()]
    n = {k: (t, b) for k, t, b in got if k}
    assert n["long"] == (150_000 * n["short"][0], 150_000 * n["short"][1])
    assert sorted((t, b) for k, t, b in got if k is None) == sorted([(0, 0), n["a"]])
