"""Cycle search against plain enumeration, and on rings, dense parts and chains that once took too long."""

import random
import time

import pytest

from meterflow.plans.cycles import reduced, shortest_cycles, strong_parts

SCHEMA = "a string, b string, lo int, hi int"


def enumerated(edges):
    """start -> path by walking every simple path."""
    best = {}
    edges = sorted({e for e in edges if e[2] < e[3]})

    def walk(path, lo, hi):
        for a, b, l2, h2 in edges:
            if a != path[-1] or max(lo, l2) >= min(hi, h2):
                continue
            if b == path[0]:
                old = best.get(path[0])
                if old is None or (len(path), path) < (len(old), old):
                    best[path[0]] = list(path)
            elif b > path[0] and b not in path:
                walk([*path, b], max(lo, l2), min(hi, h2))

    for n in {e[0] for e in edges}:
        walk([n], -(10**9), 10**9)
    return best


def searched(spark, edges):
    return {r.start: r.path for r in shortest_cycles(spark.createDataFrame(edges, SCHEMA)).collect()}


@pytest.mark.parametrize("seed", range(2))
def test_against_enumeration(spark, seed):
    rng = random.Random(seed)
    edges = []
    for part in range(12):  # separate graphs, sparse ones with chains to dense ones
        n, m = rng.randint(2, 7), rng.randint(2, 12)
        for _ in range(m):
            lo = rng.randint(0, 3)
            edges.append((f"{part:02d}{rng.randint(0, n)}", f"{part:02d}{rng.randint(0, n)}", lo, lo + rng.randint(0, 6)))
        ring = [f"{part:02d}{k}" for k in rng.sample(range(10), rng.randint(3, 9))]  # crosses the others
        edges += [(a, b, 0, 9) for a, b in zip(ring, ring[1:] + ring[:1], strict=True)]
    assert searched(spark, edges) == enumerated(edges)


def test_ring_dense_part_and_chain(spark):
    name = "{:05d}".format
    ring = [(name(i), name((i + 1) % 5_000), 0, 9) for i in range(5_000)]
    dense = [(f"d{i:03d}", f"d{j:03d}", 0, 9) for i in range(200) for j in range(200) if i != j]
    chain = [(f"x{i:05d}", f"x{i + 1:05d}", 0, 9) for i in range(3_000)]
    cut = [(f"y{i:03d}", f"y{(i + 1) % 100:03d}", 0 if i else 5, 5 if i else 9) for i in range(100)]  # never whole at one time
    began = time.time()
    got = searched(spark, ring + dense + chain + cut + [("s", "s", 0, 1)])
    took = time.time() - began
    assert got["00000"] == [name(i) for i in range(5_000)] and got["s"] == ["s"]
    assert {k: v for k, v in got.items() if k[0] == "d"} == {f"d{i:03d}": [f"d{i:03d}", f"d{i + 1:03d}"] for i in range(199)}
    assert len(got) == 201 and took < 150


def test_parts(spark):
    edges = [("1", "2"), ("2", "3"), ("3", "1"), ("3", "4"), ("4", "5"), ("5", "6"), ("6", "4"), ("5", "4"), ("7", "1"), ("6", "8")]
    e = spark.createDataFrame([(*x, 0, 1, []) for x in edges], SCHEMA + ", inner array<string>")
    got = {(r.a, r.b): r.part for r in strong_parts(e).collect()}
    assert got == {e: "3" if max(e) < "4" else "6" for e in edges[:3] + edges[4:8]}


def test_nothing_to_find(spark):
    assert searched(spark, [("a", "b", 0, 1), ("b", "c", 0, 1)]) == {}
    assert searched(spark, []) == {}
    left, loops = reduced(spark.createDataFrame([("a", "b", 0, 1, [])], SCHEMA + ", inner array<string>"))
    assert left.isEmpty() and loops is None
