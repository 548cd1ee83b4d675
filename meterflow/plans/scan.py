"""Scans along series in chunks of a calendar month, so that one long series uses many tasks.

What a chunk needs of those before it is one row per chunk: the last row, or the sum so far. These are
gathered with partial aggregation, carried from chunk to chunk in a window over the chunks alone, and
met by (series, chunk), by which the rows are dealt out anyway. So a month can also be run by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"


def chunked(rows: DataFrame, time: str = "timestamp") -> DataFrame:
    return rows.withColumn(CHUNK, F.trunc(F.col(time).cast("date"), "month"))


def with_previous(rows: DataFrame, key: list[str], order: list[str], values: list[str], lasts: DataFrame | None = None) -> DataFrame:
    """Chunked `rows` with `before`, the `values` of the row before in its series, by `order` (its first
    column the time). `lasts`: rows to take the chunks' last ones from, if `rows` are dear to compute; they
    keep all columns, so that Spark sees a shuffle that `rows` and `lasts` share and makes it once."""
    row = F.struct(*values)
    in_chunk = F.lag(row).over(Window.partitionBy(*key, CHUNK).orderBy(*order))
    of = rows if lasts is None else lasts
    first = [*order, *(v for v in values if v not in order)]
    rest = [] if lasts is None else [c for c in of.columns if c not in (*key, CHUNK, *first)]
    last = of.groupBy(*key, CHUNK).agg(F.max(F.struct(*first, *rest)).alias("_last"))
    carried = F.lag(F.struct(*(F.col(f"_last.{v}").alias(v) for v in values))).over(Window.partitionBy(*key).orderBy(CHUNK))
    last = last.select(*key, CHUNK, carried.alias("_carried"))
    out = rows.withColumn("before", in_chunk).join(last, [*key, CHUNK], "left")
    return out.withColumn("before", F.coalesce("before", "_carried")).drop("_carried")


def with_running_sum(rows: DataFrame, key: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Chunked, written `rows` with the sum of `value` up to each row of its series."""
    so_far = F.sum(value).over(Window.partitionBy(*key, CHUNK).orderBy(*order))
    totals = rows.groupBy(*key, CHUNK).agg(F.sum(value).alias("_total"))
    before = F.sum("_total").over(Window.partitionBy(*key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1))
    totals = totals.select(*key, CHUNK, F.coalesce(before, F.lit(0.0)).alias("_before"))
    return rows.withColumn(name, so_far).join(totals, [*key, CHUNK]).withColumn(name, F.col(name) + F.col("_before")).drop("_before")
