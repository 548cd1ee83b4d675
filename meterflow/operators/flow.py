"""From counter readings to flow per meter and own consumption."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.temporal import FAR_FUTURE, FAR_PAST, lower, upper
from meterflow.plans.intervals import breakpoints, by_interval, located
from meterflow.plans.paths import path_sums
from meterflow.plans.scan import CHUNK, chunked, with_previous
from meterflow.plans.stage import staged

MAX_HOPS = 10


def latest_correction(readings: DataFrame) -> DataFrame:
    """One row per (series, time): that recorded last; no recording time counts as the earliest, and
    of equal recording times the larger value is taken. Rows are dealt out by series and month."""
    return _corrected(chunked(readings)).drop(CHUNK)


def _corrected(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("timeseries_id", CHUNK).orderBy("timestamp", F.col("recorded_at").asc_nulls_first(), "value")
    rows = rows.withColumn("_next", F.lead("timestamp").over(order)).withColumn("_more", F.lead(F.lit(True)).over(order))
    return rows.where(F.col("_more").isNull() | ~F.col("_next").eqNullSafe(F.col("timestamp"))).drop("_next", "_more")


def _difference(readings: DataFrame, corrected: bool, lasts: DataFrame | None = None) -> DataFrame:
    """`readings` with `delta` to the one before, all but each series' first. Picking corrections and
    taking differences share one shuffle, by series and month, and so does finding the last reading of each
    month (those of other months in `lasts`, if given), which is carried to the next one."""
    rows = chunked(readings).repartition("timeseries_id", CHUNK)
    kept = _corrected(rows) if corrected else rows
    # of the last time in a month, the row recorded last is the largest (nulls are smallest)
    order = ["timestamp", "recorded_at", "value"]
    out = with_previous(kept, ["timeseries_id"], order, ["value"], lasts=rows if lasts is None else lasts)
    return out.withColumn("delta", F.col("value") - F.col("before.value")).where("delta is not null").drop("before", CHUNK)


def measured_flow(readings: DataFrame, refs: DataFrame, sensors: DataFrame, corrected: bool = True, lasts: DataFrame | None = None) -> DataFrame:
    """(meter_id, timestamp, delta): differences of the preferred counters. `corrected` picks the
    latest correction of every reading first. The first reading of a series gives no row. `readings`
    may be some months only, if `lasts` has every series' last reading of each month up to them, with
    its month in `_chunk`."""
    # written, so that its size is known and the readings need no shuffle of their own to meet it
    counters = staged(refs.where("preferred and reading_type = 'counter'").join(sensors, "sensor_id").select("timeseries_id", "meter_id"), "counters")
    return _difference(readings.join(counters, "timeseries_id"), corrected, lasts).select("meter_id", "timestamp", "delta")


def counter_rate(readings: DataFrame, series: DataFrame, start: str, end: str, cumulative: bool = False, corrected: bool = False) -> DataFrame:
    """(timeseries_id, timestamp, delta) of the listed series within [start, end); with `cumulative`
    the counter relative to its first value there. `corrected` picks the latest correction of every
    reading first: corrections stand at the time of what they correct, so series and times are chosen
    before, and only what is left is shuffled."""
    inside = readings.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    rows = inside.join(series.select("timeseries_id").distinct(), "timeseries_id", "left_semi")
    if not cumulative:
        return _difference(rows, corrected).select("timeseries_id", "timestamp", "delta")
    rows = latest_correction(rows) if corrected else rows
    first = F.first("value").over(Window.partitionBy("timeseries_id").orderBy("timestamp"))
    return rows.select("timeseries_id", "timestamp", (F.col("value") - first).alias("delta"))


def enrich_readings(readings: DataFrame, refs: DataFrame, sensors: DataFrame) -> DataFrame:
    """Readings with the meter, aggregate, reading type and kind of their series."""
    series = refs.join(sensors.select("sensor_id", "meter_id"), "sensor_id").select("timeseries_id", "meter_id", "aggregate", "reading_type", "kind")
    return readings.join(series, "timeseries_id")


def _windows(relations: DataFrame, kind: str | None, meter: str) -> DataFrame:
    """(meter_id, other, k, lo, hi) of the edges of a kind (all if None), by their `meter` end."""
    other = "child_meter_id" if meter == "parent_meter_id" else "parent_meter_id"
    e = relations if kind is None else relations.where(F.col("relation_type") == kind)
    e = e.select(F.col(meter).alias("meter_id"), F.col(other).alias("other"), F.col("flow_coefficient").alias("k"), lower(F.col("valid_from")).alias("lo"), upper(F.col("valid_to")).alias("hi"))
    return e.where("lo < hi")


def _sub_rows(rows: DataFrame, subs: DataFrame) -> DataFrame:
    """(parent_meter_id, timestamp, total): of every located row of a sub-meter its share in each parent;
    `subs` are edges by interval."""
    share = (F.col("delta") * F.coalesce("k", F.lit(1.0))).alias("total")
    return rows.join(subs, ["meter_id", "since"]).select(F.col("other").alias("parent_meter_id"), "timestamp", share)


def sub_total(relations: DataFrame, flow: DataFrame) -> DataFrame:
    """(parent_meter_id, timestamp, total): flow of the active sub-meters times coefficient (null = 1)."""
    subs = _windows(relations, "hasSubMeter", "child_meter_id")
    marks = breakpoints(subs)
    return _sub_rows(located(flow, marks), staged(by_interval(subs, marks), "sub-meters")).groupBy("parent_meter_id", "timestamp").agg(F.sum("total").alias("total"))


def feeds_paths(relations: DataFrame, max_hops: int = MAX_HOPS, strict: bool = False) -> DataFrame:
    """(source, meter_id, length, lo, hi, n, k): of the paths of up to `max_hops` feeds edges their number
    and the sum of the products of their coefficients, by length and by the window in which all edges
    hold. Longer paths are left out, or raise if `strict`."""
    feeds = _windows(relations, "feeds", "parent_meter_id").select(F.col("meter_id").alias("a"), F.col("other").alias("b"), "lo", "hi", "k")
    paths = path_sums(feeds, max_hops + 1 if strict else max_hops)
    if strict and not paths.where(F.col("length") > max_hops).isEmpty():
        raise ValueError(f"paths of more than {max_hops} feeds edges")
    return paths


def meter_flow(measured: DataFrame, relations: DataFrame, max_hops: int = MAX_HOPS, strict: bool = False) -> DataFrame:
    """(meter_id, timestamp, delta): measured flow plus what feeds edges deliver.

    A feeds child gets coefficient times (the parent's row less the parent's sub-meters), for every
    row the parent has: a parent with several deliveries subtracts its sub-meters from each. A
    delivery over several edges is therefore the first parent's row times all coefficients, less the
    sub-meters of every parent on the way times the coefficients from there on. Both factors are sums
    over paths, found on the edges alone: per source and meter, and per source, parent on the way and
    meter. Every reading knows the interval between its meter's breakpoints, so it meets both, and the
    edges to its parents, by key; sub-meters' sums are joined by (meter, time). What comes from edges alone
    is written before readings meet it: its size is known then, and where it is small readings meet it
    where they are. Paths end after `max_hops` edges; with `strict`, longer ones raise.
    """
    relations = staged(relations, "relations")  # read several times, however it was made
    paths = feeds_paths(relations, max_hops, strict)
    subs = _windows(relations, "hasSubMeter", "child_meter_id")
    at_all_times = [F.lit(FAR_PAST).cast("date").alias("lo"), F.lit(FAR_FUTURE).cast("date").alias("hi")]
    stay = paths.select("source").distinct().select("source", F.col("source").alias("meter_id"), *at_all_times, F.lit(1.0).alias("n"), F.lit(1.0).alias("k"), F.lit(0).alias("length"))
    # the way to a parent counts as often as there are paths, the way on from it by its coefficients
    counted = paths.unionByName(stay).withColumn("k", F.col("n")).withColumn("parent", F.col("meter_id"))
    counted = counted.join(subs.select(F.col("other").alias("parent")).distinct(), "parent", "left_semi")
    on = paths.select(F.col("source").alias("parent"), F.col("meter_id").alias("to"), F.col("lo").alias("l2"), F.col("hi").alias("h2"), F.col("k").alias("k2"), F.col("length").alias("length_2"))
    legs = counted.join(on, "parent").where(F.col("length") + F.col("length_2") <= max_hops)
    legs = legs.select(F.col("source").alias("meter_id"), "parent", "to", F.greatest("lo", "l2").alias("lo"), F.least("hi", "h2").alias("hi"), (F.col("n") * F.col("k2")).alias("k")).where("lo < hi")
    legs = staged(legs.groupBy("meter_id", "parent", "to", "lo", "hi").agg(F.sum("k").alias("k")), "legs")
    sums = paths.groupBy(F.col("source").alias("meter_id"), F.col("meter_id").alias("to"), "lo", "hi").agg(F.sum("k").alias("k"))
    marks = staged(breakpoints(subs, sums, legs), "breakpoints")
    rows = staged(located(measured, marks), "located")
    whole = lambda name, windows, *key: staged(by_interval(windows, marks).groupBy("meter_id", "since", *key).agg(F.sum("k").alias("k")), name)
    sent = rows.join(whole("deliveries", sums, "to"), ["meter_id", "since"]).select(F.col("to").alias("meter_id"), "timestamp", (F.col("k") * F.col("delta")).alias("delta"))
    total = _sub_rows(rows, staged(by_interval(subs, marks), "sub-meters")).groupBy("parent_meter_id", "timestamp").agg(F.sum("total").alias("total")).withColumnRenamed("parent_meter_id", "parent")
    taken = rows.select("meter_id", "since", "timestamp").join(whole("takings", legs, "parent", "to"), ["meter_id", "since"]).select("parent", "timestamp", "to", "k").join(total, ["parent", "timestamp"])
    parts = rows.select("meter_id", "timestamp", "delta").unionByName(sent)
    parts = parts.unionByName(taken.select(F.col("to").alias("meter_id"), "timestamp", (-F.col("k") * F.col("total")).alias("delta")))
    return parts.groupBy("meter_id", "timestamp").agg(F.sum("delta").alias("delta"))


def hs_total(relations: DataFrame, flow: DataFrame) -> DataFrame:
    """`sub_total` over the full flow, so that virtual children count too."""
    return sub_total(relations, flow)


def _k_sums(feeds: DataFrame, marks: DataFrame) -> DataFrame:
    return by_interval(feeds, marks).groupBy("meter_id", "since").agg(F.sum("k").alias("total_k"))


def feeds_k_sum(relations: DataFrame, flow: DataFrame) -> DataFrame:
    """(parent_meter_id, timestamp, total_k): coefficients of the feeds edges active at each row of a
    parent, added up once per interval."""
    feeds = _windows(relations, "feeds", "parent_meter_id")
    marks = breakpoints(feeds)
    rows = located(flow.select("meter_id", "timestamp"), marks).join(_k_sums(feeds, marks), ["meter_id", "since"])
    return rows.select(F.col("meter_id").alias("parent_meter_id"), "timestamp", "total_k")


def meter_net(flow: DataFrame, relations: DataFrame) -> DataFrame:
    """(meter_id, timestamp, net) = (flow - sub-meters) * (1 - share fed on), one row per row of `flow`,
    which has one per meter and time. A meter's own row and those of its sub-meters meet in one aggregation."""
    rows, subs, feeds, marks = _net_rows(flow, relations)
    fed = staged(_k_sums(feeds, marks), "fed on")
    # plain columns, which are added up by hash; a struct would have all rows sorted
    own = rows.join(fed, ["meter_id", "since"], "left").select("meter_id", "timestamp", "delta", "total_k", F.lit(True).alias("own"))
    taken = _sub_rows(rows, subs).withColumnRenamed("parent_meter_id", "meter_id")
    both = own.unionByName(taken, allowMissingColumns=True).groupBy("meter_id", "timestamp")
    both = both.agg(*(F.first(c, ignorenulls=True).alias(c) for c in ("delta", "total_k", "own")), F.sum("total").alias("total"))
    net = (F.col("delta") - F.coalesce("total", F.lit(0.0))) * (1 - F.coalesce("total_k", F.lit(0.0)))
    return both.where("own").select("meter_id", "timestamp", net.alias("net"))


def _net_rows(flow: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    relations = staged(relations, "relations")
    subs, feeds = _windows(relations, "hasSubMeter", "child_meter_id"), _windows(relations, "feeds", "parent_meter_id")
    marks = staged(breakpoints(subs, feeds), "breakpoints")
    return staged(located(flow, marks), "located"), staged(by_interval(subs, marks), "sub-meters"), feeds, marks


def lost_child_flow(flow: DataFrame, relations: DataFrame) -> DataFrame:
    """(parent_meter_id, month, lost, n_times): what `meter_net` takes from nobody, per parent and calendar
    month: flow of active sub-meters at times at which their parent has no row."""
    rows, subs, _, _ = _net_rows(flow, relations)
    taken = _sub_rows(rows, subs).groupBy("parent_meter_id", "timestamp").agg(F.sum("total").alias("total"))
    parents = rows.select(F.col("meter_id").alias("parent_meter_id"), "timestamp")
    lost = taken.join(parents, ["parent_meter_id", "timestamp"], "left_anti")
    month = F.trunc(F.col("timestamp").cast("date"), "month").alias("month")
    return lost.groupBy("parent_meter_id", month).agg(F.sum("total").alias("lost"), F.count(F.lit(1)).alias("n_times"))


def closure(relations: DataFrame) -> DataFrame:
    """(ancestor, meter_id, lo, hi, paths): from every ancestor to every meter below it the number of paths
    that hold in a window; a meter is its own ancestor at all times. Cycles in time raise."""
    below = _below(relations).select(F.col("source").alias("ancestor"), "meter_id", "lo", "hi", F.col("n").alias("paths"))
    nodes = relations.select(F.col("parent_meter_id").alias("m")).union(relations.select("child_meter_id")).distinct()
    at_all_times = [F.lit(FAR_PAST).cast("date").alias("lo"), F.lit(FAR_FUTURE).cast("date").alias("hi")]
    return below.unionByName(nodes.select(F.col("m").alias("ancestor"), F.col("m").alias("meter_id"), *at_all_times, F.lit(1.0).alias("paths")))


def _below(relations: DataFrame) -> DataFrame:
    return path_sums(_windows(relations, None, "parent_meter_id").select(F.col("meter_id").alias("a"), F.col("other").alias("b"), "lo", "hi", F.lit(1.0).alias("k")))


def subtree_rollup(own: DataFrame, relations: DataFrame) -> DataFrame:
    """(meter_id, timestamp, delta): own flow plus that of all meters below, along edges active at the
    time, once for each path."""
    paths = _below(relations).select("meter_id", F.col("source").alias("ancestor"), "lo", "hi", "n")
    marks = staged(breakpoints(paths), "breakpoints")
    per = by_interval(paths, marks).groupBy("meter_id", "since", "ancestor").agg(F.sum("n").alias("n"))
    own = staged(located(own, marks), "located")
    rows = own.join(per, ["meter_id", "since"]).select(F.col("ancestor").alias("meter_id"), "timestamp", (F.col("n") * F.col("delta")).alias("delta"))
    return own.select("meter_id", "timestamp", "delta").unionByName(rows).groupBy("meter_id", "timestamp").agg(F.sum("delta").alias("delta"))


def monthly_delta(flow: DataFrame) -> DataFrame:
    """(meter_id, timestamp, delta): flow per calendar month, stamped at its start."""
    return flow.groupBy("meter_id", F.trunc(F.col("timestamp").cast("date"), "month").alias("month")).agg(F.sum("delta").alias("delta"))
