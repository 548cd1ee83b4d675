"""The Merkle manifest against a sequential one, over ragged trees and odd rows."""

import hashlib
import random
import zlib

from meterflow.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, leaf string, position int"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (*row[:4], text)))


def climb(nodes):
    """(root, levels of nodes) of a list of digests."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([sha(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels[-1][0], levels


def path(levels, i):
    for nodes in levels[:-1]:
        lo = i // 16 * 16
        yield "".join(nodes[lo:i]), "".join(nodes[i + 1 : lo + 16])
        i //= 16


def lowered(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_force(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r, r[4]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [climb([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order]
    root, top = climb([t[0] for t in trees])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, mine, r) in enumerate(sorted(groups[s], key=lambda x: x[:3])):
            steps = [*path(trees[k][1], i), *path(top, k)]
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf(r, lowered(r[4]) if hit else r[4])
            for a, b in steps:
                node = sha(a, node, b)
            out.append((r[0], mine, trees[k][0], root, sha(*(a + b for a, b in steps)), node, node == root))
    return out


def audited(spark, rows, parts=3):
    return [tuple(r) for r in merkle.audit(spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA).repartition(parts)).collect()]


def key(rows):
    return sorted(rows, key=str)


def test_trees_of_all_shapes(spark):
    """Sources of 1, 2, 16, 17, 256, 257 and 5,000 leaves (one holds most rows), 40 sources; more than one
    round over blocks whose last subtree is short."""
    sizes = [1, 2, 15, 16, 17, 255, 256, 257, 5_000] + [1] * 31
    rows = [(1000 * k + i, f"s{k:02d}é", "en", i, f"Text {i} of {k}") for k, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    assert key(audited(spark, rows)) == key(brute_force(rows))


def test_two_large_sources(spark):
    """A null source and another, of 3,000 and 6,000 leaves, most fields null."""
    rows = [(i, "a" if i % 3 else None, None, None, None if i % 7 == 0 else "A" * (i % 5)) for i in range(9_000)]
    state = merkle.audit(spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA)).collect()
    assert key(tuple(r) for r in state) == key(brute_force(rows))


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (None, "", "", 0, ""), (1, "a", "en", 1, "Ab"), (1, "a", "en", 1, "Ab"), (1, "a", "en", 1, "aB"), (-5, "a", None, None, "x" * 3_000_000), (7, "é", "en", 2, "ÀÉ")]
    assert key(audited(spark, rows)) == key(brute_force(rows))
    assert audited(spark, rows[:1]) == brute_force(rows[:1])
    assert audited(spark, []) == []


def test_tampering_is_found_and_only_that(spark):
    rows = [(i, "a", "en", 1, "UPPER" if i % 2 else "lower") for i in range(600)]
    for doc_id, *_, verified in audited(spark, rows):
        assert verified == (not (doc_id % 2 and zlib.crc32(str(doc_id).encode()) % 5 == 0))
