"""Cycles of edges with windows: reduction of the graph, its strongly connected parts, shortest cycles.

Tables of edges have columns a, b, lo, hi (they hold in [lo, hi)) and inner, the nodes that an edge
was contracted from, in order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.plans.stage import counted, release, staged

EDGE = ["a", "b", "lo", "hi", "inner"]


def _trimmed(e: DataFrame) -> DataFrame:
    """Edges that some edge leads to and some edge leads on from."""
    return e.join(e.select(F.col("b").alias("a")), "a", "left_semi").join(e.select(F.col("a").alias("b")), "b", "left_semi").select(EDGE)


def _reduced_once(e: DataFrame) -> DataFrame:
    """Edges that some edge leads to and some edge leads on from; nodes with one edge in and one out are
    merged into one edge, those of them whose hash is the largest among such neighbours."""
    ends = e.select(F.col("b").alias("m"), F.lit(1).alias("n_in"), F.lit(0).alias("n_out"), F.col("a").alias("before"), F.lit(None).cast("string").alias("behind")).unionByName(
        e.select(F.col("a").alias("m"), F.lit(0).alias("n_in"), F.lit(1).alias("n_out"), F.lit(None).cast("string").alias("before"), F.col("b").alias("behind"))
    )
    nodes = ends.groupBy("m").agg(F.sum("n_in").alias("n_in"), F.sum("n_out").alias("n_out"), F.max("before").alias("before"), F.max("behind").alias("behind"))
    # a node without edges on one side is not here; one with a single edge on each knows its neighbours
    thin = (F.col("n_in") == 1) & (F.col("n_out") == 1)
    nodes = nodes.where("n_in > 0 and n_out > 0").select("m", F.when(thin, F.struct(F.xxhash64("m").alias("h"), "m")).alias("rank"), "before", "behind")
    rank_of = lambda side: nodes.select(F.col("m").alias(side), F.col("rank").alias(f"rank_{side}"))
    around = nodes.where("rank is not null").join(rank_of("before"), "before", "left").join(rank_of("behind"), "behind", "left")
    first = F.coalesce(F.col("rank") > F.col("rank_before"), F.lit(True)) & F.coalesce(F.col("rank") > F.col("rank_behind"), F.lit(True))
    known = nodes.select("m").join(around.where(first).select("m", F.lit(True).alias("merged")), "m", "left")
    live = e.join(known.select(F.col("m").alias("a"), F.col("merged").alias("from_merged")), "a").join(known.select(F.col("m").alias("b"), F.col("merged").alias("to_merged")), "b")
    head = live.where("to_merged").select("a", F.col("b").alias("m"), "lo", "hi", "inner")
    tail = live.where("from_merged").select(F.col("a").alias("m"), "b", F.col("lo").alias("l2"), F.col("hi").alias("h2"), F.col("inner").alias("inner_2"))
    joined = head.join(tail, "m").select("a", "b", F.greatest("lo", "l2").alias("lo"), F.least("hi", "h2").alias("hi"), F.concat("inner", F.array("m"), "inner_2").alias("inner"))
    return live.where("from_merged is null and to_merged is null").select(EDGE).unionByName(joined.where("lo < hi"))


def reduced(e: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(edges left, edges from a node to itself): dead ends are trimmed and chains contracted until
    nothing changes. A chain or ring of n nodes takes a number of rounds that grows with log n. Cycles
    are kept, with the windows in which all of their edges hold. As long as a tenth of the edges are dead
    ends, as in trees, rounds do not look for chains."""
    loops: list[DataFrame] = []
    before, trim = -1, True
    while True:
        e, rows = counted(e.select(EDGE), "edges", n=F.lit(True), own=F.col("a") == F.col("b"))
        n, own = rows["n"], rows["own"]
        if own:
            loops.append(e.where("a = b"))
        e = e.where("a <> b")
        if n == own or (n - own == before and not trim):
            return e, reduce(DataFrame.unionByName, loops) if loops else None
        trim = trim and (before < 0 or n - own <= 0.9 * before)
        before = n - own
        e = _trimmed(e) if trim else _reduced_once(e)


def _colours(e: DataFrame, source: str, target: str) -> DataFrame:
    """(m, colour): the largest node from which m is reached by edges from `source` to `target`."""
    state = e.select(F.col("a").alias("m")).union(e.select("b")).distinct().select("m", F.col("m").alias("colour"), F.lit(True).alias("fresh"))
    state = staged(state, "colours")
    while True:
        sent = e.select(F.col(source).alias("from"), F.col(target).alias("m")).join(state.where("fresh").select(F.col("m").alias("from"), F.col("colour").alias("got")), "from")
        got = sent.groupBy("m").agg(F.max("got").alias("got"))
        grown = F.coalesce(F.col("got") > F.col("colour"), F.lit(False))
        after = state.join(got, "m", "left").select("m", F.when(grown, F.col("got")).otherwise(F.col("colour")).alias("colour"), grown.alias("fresh"))
        after, rows = counted(after, "colours", fresh=F.col("fresh"))
        release(state)
        state = after
        if not rows["fresh"]:
            return state.select("m", "colour")


def strong_parts(e: DataFrame) -> DataFrame:
    """The edges inside strongly connected parts, with `part`, the largest node of theirs. Edges between
    nodes of different colours, forwards or backwards, are in no part. Where both colours of the nodes
    left are the same, that node reaches them and is reached from them; else colours are given anew. The
    number of rounds grows with the parts' diameters, not with their sizes."""
    e = staged(e.select(EDGE), "parts")
    while True:
        for source, target, name in (("a", "b", "forth"), ("b", "a", "back")):
            c = _colours(e, source, target)
            of = lambda end: c.select(F.col("m").alias(end), F.col("colour").alias(f"colour_{end}"))  # noqa: E731, B023
            kept = e.join(of("a"), "a").join(of("b"), "b").where("colour_a = colour_b")
            mixed = F.col("forth") != F.col("back") if name == "back" else F.lit(False)
            e, rows = counted(kept.select(*e.columns, F.col("colour_a").alias(name)), "parts", mixed=mixed)
        if not rows["mixed"]:
            return e.select(*EDGE, F.col("forth").alias("part"))
        e = e.select(EDGE)


def shortest_cycles(edges: DataFrame) -> DataFrame:
    """(start, path): for every node that is the smallest of a cycle whose edges hold at one instant,
    the shortest such cycle from it on; of several the first by the nodes on it.

    `edges` (a, b, lo, hi) are reduced first, and searched only inside strongly connected parts. There,
    paths grow from every node over larger ones, and from every contracted edge whose smallest inner
    node is smaller than its ends. What counts of a path is where it began, where it is and the window in
    which all of its edges hold; of paths that agree in these the shortest goes on. The number of paths is
    bounded by edges and windows also in dense parts. A shortest cycle visits no node twice.
    """
    one = edges.where("lo < hi").select("a", "b", "lo", "hi").distinct()
    core, loops = reduced(one.withColumn("inner", F.array().cast("array<string>")))
    found = []
    if loops is not None:  # a node's own edge is a cycle that no other edge takes part in
        ring = loops.select(F.concat(F.array("a"), "inner").alias("ring"))
        at = F.array_position("ring", F.array_min("ring")).cast("int")
        ring = ring.select(F.array_min("ring").alias("start"), F.concat(F.slice("ring", at, F.size("ring")), F.slice("ring", F.lit(1), at - 1)).alias("path"))
        found.append(ring.select("start", F.size("path").alias("length"), "path"))
    if not core.isEmpty():
        found.append(_searched(strong_parts(core).withColumn("low", F.array_min("inner"))))
    if not found:
        return edges.sparkSession.createDataFrame([], "start string, path array<string>")
    best = F.min(F.struct("length", "path")).alias("best")
    return reduce(DataFrame.unionByName, found).groupBy("start").agg(best).select("start", "best.path")


def _searched(e: DataFrame) -> DataFrame:
    """(start, length, path) of cycles of several edges."""
    state = ["start", "at", "lo", "hi"]
    over = lambda start: (F.col("b") >= start) & (F.col("low").isNull() | (F.col("low") > start))
    nodes = e.where(over(F.col("a"))).select(
        F.col("a").alias("start"), F.col("b").alias("at"), "lo", "hi", F.concat(F.array("a"), "inner", F.array("b")).alias("path"), F.col("a").alias("goal"), F.array().cast("array<string>").alias("tail")
    )
    cut = F.array_position("inner", F.col("low")).cast("int")
    chains = e.where("low < a and low < b").select(
        F.col("low").alias("start"), F.col("b").alias("at"), "lo", "hi", F.concat(F.slice("inner", cut, F.size("inner")), F.array("b")).alias("path"), F.col("a").alias("goal"), F.slice("inner", F.lit(1), cut - 1).alias("tail")
    )
    hop = e.select(F.col("a").alias("at"), "b", F.col("lo").alias("l2"), F.col("hi").alias("h2"), "inner", "low")
    best_path = F.min(F.struct(F.size("path").alias("n"), "path", "goal", "tail")).alias("best")
    done = F.col("at") == F.col("best.goal")
    fresh, rows = counted(nodes.unionByName(chains).groupBy(state).agg(best_path), "paths", all=F.lit(True), done=done)
    known = fresh
    closed = e.sparkSession.createDataFrame([], "start string, length int, path array<string>")
    while rows["all"]:
        # a node's path ends where it began; a chain's goes on over the nodes before its smallest one
        whole = F.when(F.col("best.goal") == F.col("start"), F.slice("best.path", F.lit(1), F.col("best.n") - 1)).otherwise(F.concat("best.path", "best.tail"))
        if rows["done"]:
            ended = fresh.where(done).select("start", whole.alias("path")).select("start", F.size("path").alias("length"), "path")
            ended = closed.unionByName(ended).groupBy("start").agg(F.min(F.struct("length", "path")).alias("c"))
            closed = staged(ended.select("start", "c.*"), "closed")
        step = fresh.where(~done).join(hop, "at").where((F.col("b") >= F.col("start")) & (F.col("low").isNull() | (F.col("low") > F.col("start"))))
        step = step.select(
            "start", F.col("b").alias("at"), F.greatest("lo", "l2").alias("lo"), F.least("hi", "h2").alias("hi"), F.concat("best.path", "inner", F.array("b")).alias("path"), F.col("best.goal").alias("goal"), F.col("best.tail").alias("tail")
        ).where("lo < hi")
        # a path as long as a cycle that its start has already cannot end in a better one
        step = step.join(closed.select("start", "length"), "start", "left").where(F.col("length").isNull() | (F.size("path") <= F.col("length") + 1))
        step = step.groupBy(state).agg(best_path)
        old = known.groupBy(state).agg(F.min("best").alias("old"))
        better = step.join(old, state, "left").where(F.col("old").isNull() | (F.col("best") < F.col("old"))).drop("old")
        fresh, rows = counted(better, "paths", all=F.lit(True), done=done)
        known = known.unionByName(fresh)
    return closed
