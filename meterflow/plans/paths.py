"""Sums over the paths of a graph whose edges hold in windows, by repeated doubling.

Tables have columns source, meter_id, lo, hi (all edges of a path hold in [lo, hi)), n (the number of
paths), k (the sum over them of the products of their edges' factors; null factors are left out) and,
where paths are limited, length. Paths that agree in ends and window (and length) are one row, so rows
are bounded by pairs of nodes and windows, however many paths there are. n is a double, exact up to 2^53.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.plans.stage import counted, staged

_KEY = ["source", "meter_id", "lo", "hi"]


def _summed(rows: DataFrame, key: list[str]) -> DataFrame:
    return rows.groupBy(key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))


def composed(x: DataFrame, y: DataFrame, limit: int | None) -> DataFrame:
    """Every path of `x` with every path of `y` that goes on from its end."""
    go_on = y.select(F.col("source").alias("meter_id"), F.col("meter_id").alias("_to"), *(F.col(c).alias(f"_{c}") for c in x.columns if c not in ("source", "meter_id")))
    out = ["source", F.col("_to").alias("meter_id"), F.greatest("lo", "_lo").alias("lo"), F.least("hi", "_hi").alias("hi"), (F.col("n") * F.col("_n")).alias("n"), (F.col("k") * F.col("_k")).alias("k")]
    if limit is not None:
        out.append((F.col("length") + F.col("_length")).alias("length"))
    rows = x.join(go_on, "meter_id").select(*out).where("lo < hi")
    return rows if limit is None else rows.where(F.col("length") <= limit)


def path_sums(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """Sums over all paths of one or more `edges` (a, b, lo, hi, k), or of up to `limit` edges, by length.

    With all paths of up to m edges and those of exactly m at hand, the first m edges of any path of up to
    2m are one of the latter: so the number of rounds grows with the log of the longest path. Without a
    limit, a cycle of edges that hold at one time raises, as its paths have no end.
    """
    key = _KEY if limit is None else [*_KEY, "length"]
    first = edges.where("lo < hi").select(F.col("a").alias("source"), F.col("b").alias("meter_id"), "lo", "hi", F.lit(1.0).alias("n"), "k", *([] if limit is None else [F.lit(1).alias("length")]))
    whole = exact = staged(_summed(first, key), "paths")
    nodes = whole.select("source").union(whole.select("meter_id")).distinct().count() if limit is None else 0
    m = 1
    while limit is None or m < limit:
        more, rows = counted(_summed(composed(exact, whole, limit), key), "paths", all=F.lit(True))
        if not rows["all"]:
            break
        exact = staged(_summed(composed(exact, exact, None), key), "paths") if limit is None else more.where(F.col("length") == 2 * m)
        whole = staged(_summed(whole.unionByName(more), key), "paths") if limit is None else whole.unionByName(more)
        m *= 2
        if limit is None and m >= nodes and not exact.isEmpty():
            raise ValueError(f"paths of {m} edges among {nodes} meters: the graph has a cycle in time")
    return whole
