"""Breakpoint index: elementary intervals of validity per meter, so that joins in time are joins by key.

A meter's breakpoints are the days on which any window about it begins or ends; between two of them
nothing changes. Readings look up the breakpoint they follow among their meter's; tables of windows get
a row per breakpoint that they hold at. Both then meet by equality of (meter_id, since).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: breakpoints per block of a key's array
BLOCK = 64


def breakpoints(*windows: DataFrame, key: str = "meter_id") -> DataFrame:
    """(key, since) of all bounds of `windows` (key, lo, hi)."""
    return reduce(DataFrame.unionByName, (w.select(key, F.explode(F.array("lo", "hi")).alias("since")) for w in windows)).distinct()


def by_interval(windows: DataFrame, marks: DataFrame, key: str = "meter_id") -> DataFrame:
    """`windows` (key, lo, hi and others) with `since` in place of lo and hi: a row for each of the key's
    breakpoints in [lo, hi)."""
    return windows.join(marks, key).where("lo <= since and since < hi").drop("lo", "hi")


def located(rows: DataFrame, marks: DataFrame, key: str = "meter_id") -> DataFrame:
    """`rows` (key, timestamp and others) with `since`, their key's last breakpoint at or before their
    time; null before the first one. A key's breakpoints are days, so its sorted array of them is bounded
    by the days that windows span; rows meet it by key (broadcast, or with skewed keys split) and are
    neither sorted nor gathered by key. In the array a row looks at the heads of blocks, then at one block.
    """
    known = marks.groupBy(key).agg(F.sort_array(F.collect_set("since")).alias("_days"))
    starts = F.sequence(F.lit(0), F.floor((F.size("_days") - 1) / BLOCK).cast("int"))
    heads = F.when(F.size("_days") > BLOCK, F.transform(starts, lambda i: F.get("_days", i * BLOCK)))
    known = known.where(F.size("_days") > 0).withColumn("_heads", heads)
    day = F.col("timestamp").cast("date")
    upto = lambda days: F.filter(days, lambda d: d <= day)
    rows = rows.join(known, key, "left").withColumn("_block", F.when(F.col("_heads").isNotNull(), F.size(upto(F.col("_heads")))))
    block = F.slice("_days", (F.col("_block") - 1) * BLOCK + 1, F.lit(BLOCK))
    since = F.when(F.col("_block").isNull(), F.array_max(upto(F.col("_days")))).when(F.col("_block") > 0, F.array_max(upto(block)))
    return rows.withColumn("since", since).drop("_days", "_heads", "_block")
