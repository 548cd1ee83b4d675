"""Exact percentiles of many groups in bounded memory, by refining histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.plans.stage import release, staged

BINS = 1024


def percentiles(rows: DataFrame, key: str, value: str, shares: list[float], bins: int = BINS) -> DataFrame:
    """(key, q array<double>): the percentiles of `value` per key at `shares`, between two values the
    linear one; nulls do not count, keys without values give no row. Values are finite.

    A percentile lies between two order statistics. For each of these a range of values is kept that
    holds it, at first from the smallest to the largest value of its key. A pass counts the rows of every
    range in `bins` equal parts, with partial aggregation, and goes on with the part that the rank falls
    in, cut down to the values that are there, until they are one. Every pass splits every range, as its
    ends fall into different parts; a thousand parts mean one to three passes for usual data. No task
    holds more than the counts of the ranges at hand, however many values a key has.
    """
    rows = staged(rows.where(F.col(value).isNotNull()).select(F.col(key).alias("k"), F.col(value).cast("double").alias("v")), "values")
    ends = rows.groupBy("k").agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count(F.lit(1)).alias("n"))
    at = [(F.lit(float(s)) * (F.col("n") - 1)) for s in shares]
    ranks = F.array_distinct(F.array(*(f(x).cast("long") for x in at for f in (F.floor, F.ceil))))
    ends = staged(ends.withColumn("ranks", ranks), "ends")
    open_ = staged(ends.select("k", F.explode("ranks").alias("rank"), "lo", "hi", F.lit(0).cast("long").alias("below")), "ranges")
    found = []
    while True:
        found.append(open_.where("lo = hi").select("k", "rank", F.col("lo").alias("v")))
        wide = open_.where("lo < hi")
        if wide.isEmpty():
            break
        part = F.least(F.floor((F.col("v") / 2 - F.col("lo") / 2) / (F.col("hi") / 2 - F.col("lo") / 2) * bins), F.lit(bins - 1))
        inside = rows.join(wide.select("k", "lo", "hi").distinct(), "k").where("v between lo and hi")
        counts = inside.groupBy("k", "lo", "hi", part.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("most"))
        so_far = F.sum("n").over(Window.partitionBy("k", "lo", "hi").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow))
        counts = counts.withColumn("upto", so_far)
        falls_in = (F.col("rank") >= F.col("below") + F.col("upto") - F.col("n")) & (F.col("rank") < F.col("below") + F.col("upto"))
        step = wide.join(counts, ["k", "lo", "hi"]).where(falls_in)
        open_ = staged(step.select("k", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), (F.col("below") + F.col("upto") - F.col("n")).alias("below")), "ranges")
    values = reduce(DataFrame.unionByName, found).groupBy("k").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))
    values = staged(values.join(ends.select("k", "n"), "k"), "found")
    release(rows)

    def one(x):
        lo, hi = (F.col("at")[f(x).cast("long")] for f in (F.floor, F.ceil))
        return lo + (hi - lo) * (x - F.floor(x))

    return values.select(F.col("k").alias(key), F.array(*(one(x) for x in at)).alias("q"))
