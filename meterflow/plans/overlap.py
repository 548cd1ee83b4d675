"""Pairs of overlapping windows by a sweep over their bounds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def overlapping_pairs(rows: DataFrame, key: list[str]) -> DataFrame:
    """(one, two): structs of two rows with an equal, null-safe `key` whose windows [lo, hi) overlap, each
    pair once.

    In the order of beginnings, a window overlaps those behind it that begin before it ends, and these
    stand next to each other. How many begin before a time is counted in one pass over all bounds of a
    key. So rows meet by key and place, and only those that overlap: the work is the number of rows and
    of pairs, not the square of a key's rows.
    """
    same = F.struct(*(F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in key), *(F.col(k).isNull().alias(f"no_{k}") for k in key))
    row = rows.withColumns({"_key": same, "_row": F.struct(*rows.columns)})
    placed = row.withColumn("_i", F.row_number().over(Window.partitionBy("_key").orderBy("lo", "hi", F.xxhash64("_row")))).select("_key", "_row", "_i", "lo", "hi")
    begin = placed.select("_key", F.col("lo").alias("at"), F.lit(1).alias("starts"), F.lit(None).cast("int").alias("_i"))
    end = placed.select("_key", F.col("hi").alias("at"), F.lit(0).alias("starts"), "_i")
    # an end stands before beginnings at its time: it counts those strictly before it
    so_far = F.sum("starts").over(Window.partitionBy("_key").orderBy("at", "starts").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reach = begin.unionByName(end).withColumn("_last", so_far.cast("int")).where("_i is not null and _last > _i").select("_key", "_i", "_last")
    pairs = reach.select("_key", "_i", F.explode(F.sequence(F.col("_i") + 1, F.col("_last"))).alias("_j"))
    one, two = placed.select("_key", "_i", F.col("_row").alias("one")), placed.select("_key", F.col("_i").alias("_j"), F.col("_row").alias("two"))
    both = reduce(lambda a, b: a.join(b[0], ["_key", b[1]]), ((one, "_i"), (two, "_j")), pairs)
    return both.where("one.lo < two.hi and two.lo < one.hi").select("one", "two")
