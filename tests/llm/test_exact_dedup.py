"""Grace hashing against a dictionary of whole contents."""

import hashlib
import random
from array import array

import pytest

from meterflow.llm import grace


def expected(rows):
    norm = lambda t: bytes(b + 32 if 65 <= b <= 90 else b for b in (t or "").encode())
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(norm(text), []).append(doc_id)
    top = {t: max(ids, key=lambda x: (x is not None, x or 0)) for t, ids in groups.items()}
    return sorted(((d, top[norm(t)], len(groups[norm(t)]), hashlib.sha256(norm(t)).hexdigest()) for d, t in rows), key=str)


def found(spark, rows, budget=grace.BUDGET, parts=4):
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, part string, number int").repartition(parts)
    return grace.duplicate_groups(docs, budget=budget).collect()


def plain(got):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str)


@pytest.mark.parametrize("budget", [grace.BUDGET, 3_000, 1])
def test_any_budget_gives_the_same(spark, budget):
    rng = random.Random(5)
    pool = ["".join(rng.choice("aBc dÉ\n") for _ in range(rng.randint(0, 400))) for _ in range(150)]
    rows = [(i, rng.choice(pool)) for i in range(600)] + [(1000 + i, "The Hot one " * 30 if i % 2 else "tHE hOT ONE " * 30) for i in range(400)]
    got = found(spark, rows, budget)
    assert plain(got) == expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(spark):
    rows = [(None, None), (None, ""), (3, ""), (None, "only null ids"), (None, "ONLY null ids"), (5, "same"), (5, "same"), (5, "SAME"), (6, "É"), (7, "é"), (8, "ß" * 2_000_000), (9, "ß" * 2_000_000), (10, "ß" * 1_999_999 + "s")]
    got = found(spark, rows, 1 << 20)
    assert plain(got) == expected(rows)
    assert sum(r.kept for r in got) == len({r.text_sha256 for r in got})  # of equal rows one stays
    assert found(spark, []) == []


def test_spilling_recurses_until_buckets_fit(tmp_path):
    """Digests that share their first bytes are split further down; files are gone afterwards."""
    classes = [grace.Class(bytes(8) + hashlib.sha256(b"%d" % i).digest()[8:], b"x%d" % i * 20, 1, ((True, i), 0, i), array("q", [0]), array("q", [i])) for i in range(300)]
    again = [grace.Class(c.digest, c.content, 2, ((True, 1000), 1, 0), array("q", [1]), array("q", [0])) for c in classes[:50]]
    deepest = []
    real = grace.spill
    grace.spill = lambda c, level, folder: deepest.append(level) or real(c, level, folder)
    try:
        out = list(grace.merged(iter(classes + again), 4_000, tmp_path))
    finally:
        grace.spill = real
    assert max(deepest) >= 16 and len(out) == 300
    assert {c.content: (c.n, len(c.parts)) for c in out} == {c.content: (3, 2) if i < 50 else (1, 1) for i, c in enumerate(classes)}
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_equal_digests_do_not_merge_different_contents(tmp_path):
    same = [grace.Class(bytes(32), c, 1, ((True, 1), 0, i), array("q", [0]), array("q", [i])) for i, c in enumerate((b"one", b"two", b"one"))]
    out = {c.content: c.n for c in grace.merged(iter(same), 1, tmp_path)}
    assert out == {b"one": 2, b"two": 1}
