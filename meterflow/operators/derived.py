"""Derived series that repair counters.

References carry an array `sources` of series, one `aggregation` and a window. Every operator
works on all references of its kind at once and returns readings (timeseries_id, timestamp, value).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.temporal import lower, upper
from meterflow.operators.registers import CEILINGS, ROLLOVER_TOLERANCE
from meterflow.plans.intervals import breakpoints, by_interval, located
from meterflow.plans.overlap import overlapping_pairs
from meterflow.plans.scan import CHUNK, chunked, with_previous, with_running_sum
from meterflow.plans.stage import staged

CONTINUOUS, RESET_FROM, RESET_TO = 0.01, 100_000.0, 1_000.0


def explode_sources(refs: DataFrame) -> DataFrame:
    """(timeseries_id, aggregation, valid_from, valid_to, n_sources, position, source)."""
    return refs.select("timeseries_id", "aggregation", "valid_from", "valid_to", F.size("sources").alias("n_sources"), F.posexplode("sources").alias("position", "source"))


def _source_rows(refs: DataFrame, readings: DataFrame, kind: str) -> DataFrame:
    """Readings of the sources of references of one kind, with the reference's columns."""
    of = readings.select(F.col("timeseries_id").alias("source"), "timestamp", "value")
    return explode_sources(refs.where(F.col("aggregation") == kind)).join(of, "source")


def _in_windows(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """Readings of the source of every row of `refs` (timeseries_id, source, lo, hi and others) within
    [lo, hi). Readings and references meet by (source, interval), so that many windows on one source do
    not each meet all of its readings."""
    refs = refs.where("lo < hi")
    marks = breakpoints(refs, key="source")
    of = readings.withColumnRenamed("timeseries_id", "source").join(refs.select("source").distinct(), "source", "left_semi")
    return located(of, marks, "source").join(by_interval(refs, marks, "source"), ["source", "since"]).drop("since")


def slices(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """The one source's readings within the window, their recording times kept."""
    one = explode_sources(refs.where("aggregation = 'slice'")).where("n_sources = 1")
    one = one.select("timeseries_id", "source", lower(F.col("valid_from")).alias("lo"), upper(F.col("valid_to")).alias("hi"))
    return _in_windows(one, readings).select("timeseries_id", "timestamp", "value", "recorded_at")


def sums(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """A counter from 0 of the sources' increases added up per time from valid_from on; falls count as 0."""
    rows = chunked(_source_rows(refs, readings, "sum"))
    steps = with_previous(rows, ["timeseries_id", "position"], ["timestamp", "value"], ["value"]).where("before.value is not null")
    steps = steps.where(F.col("valid_from").isNull() | (F.col("timestamp") >= F.col("valid_from"))).withColumn("delta", F.greatest(F.col("value") - F.col("before.value"), F.lit(0.0)))
    per = staged(steps.groupBy("timeseries_id", "timestamp", CHUNK).agg(F.sum("delta").alias("delta")), "steps")
    return with_running_sum(per, ["timeseries_id"], ["timestamp"], "delta", "value").select("timeseries_id", "timestamp", "value")


def endpoints(refs: DataFrame, readings: DataFrame, kind: str) -> DataFrame:
    """(timeseries_id, source, valid_from, valid_to, t_lo, v_lo, t_hi, v_hi) of references with one
    source: its last reading before the window and its first at or after its end; null if missing.

    An as-of merge: the windows' bounds are put among their source's readings in order of time, and
    each takes the last reading before it, or the next one; a series is read once for all windows on it."""
    one = explode_sources(refs.where(F.col("aggregation") == kind)).where("n_sources = 1").select("timeseries_id", "source", "valid_from", "valid_to")
    at = lambda side: one.select("source", F.col(side).cast("timestamp").alias("timestamp"), F.lit(0).alias("row")).where("timestamp is not null")
    bounds = at("valid_from").unionByName(at("valid_to")).distinct()
    of = readings.select(F.col("timeseries_id").alias("source"), "timestamp", "value").join(one.select("source").distinct(), "source", "left_semi")
    reading = F.struct("timestamp", "value")
    both = of.withColumn("row", F.lit(1)).unionByName(bounds, allowMissingColumns=True).withColumn("reading", F.when(F.col("row") == 1, reading))
    order = ["timestamp", "row", "value"]  # at equal times a bound stands before readings
    by_source = Window.partitionBy("source").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = both.withColumn("lo", F.last("reading", ignorenulls=True).over(by_source.orderBy(*order)))
    both = both.withColumn("hi", F.last("reading", ignorenulls=True).over(by_source.orderBy(*(F.col(c).desc() for c in order))))
    found = both.where("row = 0").select("source", F.col("timestamp").cast("date").alias("bound"), "lo", "hi")
    end = lambda side: F.struct(F.lit(side).alias("side"), F.col(side).alias("bound"))
    sides = one.select("*", F.inline(F.array(end("valid_from"), end("valid_to")))).join(found, ["source", "bound"], "left")
    lo, hi = (F.max(F.when(F.col("side") == side, F.col(name))).alias(name) for side, name in (("valid_from", "lo"), ("valid_to", "hi")))
    ends = sides.groupBy("timeseries_id", "source", "valid_from", "valid_to").agg(lo, hi)
    return ends.selectExpr("timeseries_id", "source", "valid_from", "valid_to", "lo.timestamp as t_lo", "lo.value as v_lo", "hi.timestamp as t_hi", "hi.value as v_hi")


def brackets(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """The source's readings within the window whose values lie between those at its ends."""
    ends = endpoints(refs, readings, "bracket").where("v_lo is not null and v_hi is not null")
    ends = ends.select("timeseries_id", "source", F.col("valid_from").alias("lo"), F.col("valid_to").alias("hi"), "v_lo", "v_hi")
    rows = _in_windows(ends, readings.select("timeseries_id", "timestamp", "value"))
    return rows.where(F.col("value").between(F.least("v_lo", "v_hi"), F.greatest("v_lo", "v_hi"))).select("timeseries_id", "timestamp", "value")


def interpolations(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """A row per day of the window on the line between the readings at its ends, to 3 decimals."""
    ends = endpoints(refs, readings, "interpolate").where("v_lo is not null and v_hi is not null")
    lo, hi = F.col("t_lo").cast("date"), F.col("t_hi").cast("date")
    ends = ends.withColumn("span", F.datediff(hi, lo)).where("span > 0 and valid_from < valid_to")
    rows = ends.withColumn("day", F.explode(F.sequence("valid_from", F.date_sub("valid_to", 1))))
    value = F.col("v_lo") + (F.col("v_hi") - F.col("v_lo")) * (F.datediff("day", lo) / F.col("span"))
    return rows.select("timeseries_id", F.col("day").cast("timestamp").alias("timestamp"), F.bround(value, 3).alias("value"))


def boundary(prev: Column, new: Column) -> Column:
    """Kind of a change of source from the values on either side: continuous (within 1 %), swap
    (no fall to less than half), rollover (just below a ceiling before), reset (a large counter
    near zero after), else swap."""
    kind = F.when((prev > 0) & (F.abs(new - prev) <= CONTINUOUS * prev), "continuous").when(new >= prev * 0.5, "swap")
    kind = kind.when(ceiling_of(prev).isNotNull(), "rollover")
    return kind.when((prev > RESET_FROM) & (new < RESET_TO), "reset").otherwise("swap")


def ceiling_of(value: Column) -> Column:
    """The ceiling that a value lies just below, or null."""
    return F.coalesce(*(F.when((value >= c * (1 - ROLLOVER_TOLERANCE)) & (value <= c), c) for c in CEILINGS))


def rolling_sums(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """One continuous counter from several sources in time order (of equal times in source order).
    The running sum of increments that depend on the rows before and after a change of source."""
    order = ["timestamp", "position"]
    rows = with_previous(chunked(_source_rows(refs, readings, "rolling_sum")), ["timeseries_id"], order, ["value", "source"])
    prev = F.col("before.value")
    kind = F.when(F.col("before.source") == F.col("source"), "same").otherwise(boundary(prev, F.col("value")))
    rows = rows.withColumn("kind", F.when(prev.isNull(), "first").otherwise(kind))
    step = (
        F.when(F.col("kind").isin("same", "continuous"), F.col("value") - prev)
        .when(F.col("kind") == "rollover", ceiling_of(prev) - prev + F.col("value"))
        .when(F.col("kind") == "swap", 0.0)
        .otherwise(F.col("value"))
    )
    steps = staged(rows.select("timeseries_id", "timestamp", "position", CHUNK, "kind", step.alias("step")), "steps")
    return with_running_sum(steps, ["timeseries_id"], order, "step", "value").select("timeseries_id", "timestamp", "value", "kind")


def overlapping_sources(refs: DataFrame, readings: DataFrame) -> DataFrame:
    """(timeseries_id, source, source_2): sources of one rolling sum whose readings overlap in time, or
    share a time. Stitching changes over at every change of source, so such a counter jumps to and fro."""
    sources = explode_sources(refs.where("aggregation = 'rolling_sum'")).select("timeseries_id", "position", "source")
    spans = readings.join(sources.select(F.col("source").alias("timeseries_id")).distinct(), "timeseries_id", "left_semi")
    spans = spans.groupBy(F.col("timeseries_id").alias("source")).agg(F.min("timestamp").alias("lo"), (F.max("timestamp") + F.expr("interval 1 microsecond")).alias("hi"))
    pairs = overlapping_pairs(sources.join(spans, "source"), ["timeseries_id"])
    in_order = F.col("one.position") < F.col("two.position")
    first, second = (F.when(in_order, F.col(x)).otherwise(F.col(y)) for x, y in (("one.source", "two.source"), ("two.source", "one.source")))
    return pairs.select("one.timeseries_id", first.alias("source"), second.alias("source_2"))


def dependency_levels(refs: DataFrame) -> DataFrame:
    """(timeseries_id, level): 0 for references over series that are no references themselves, else one
    more than the highest of its sources; null for those on a cycle of sources, or behind one. A round
    finds a level."""
    ids = refs.select("timeseries_id").distinct()
    needs = refs.select("timeseries_id", F.explode("sources").alias("source")).join(ids.withColumnRenamed("timeseries_id", "source"), "source", "left_semi").distinct()
    open_, needs, levels, level = staged(ids, "open"), staged(needs, "needs"), [], 0
    while not open_.isEmpty():
        waiting = needs.select("timeseries_id").distinct()
        ready = staged(open_.join(waiting, "timeseries_id", "left_anti"), "level")
        if ready.isEmpty():
            break
        levels.append(ready.withColumn("level", F.lit(level)))
        open_ = staged(open_.join(ready, "timeseries_id", "left_anti"), "open")
        needs = staged(needs.join(ready.withColumnRenamed("timeseries_id", "source"), "source", "left_anti"), "needs")
        level += 1
    return reduce(DataFrame.unionByName, levels, open_.withColumn("level", F.lit(None).cast("int")))


def issues(refs: DataFrame, readings: DataFrame, by_dependency: bool = False) -> DataFrame:
    """(timeseries_id, issue): references that give no readings: more than one source where one is
    needed, no window, no reading on one side of it, or (interpolations) no day between those readings;
    a source that is made later (or, `by_dependency`, a cycle of sources). And rolling sums whose
    sources overlap in time, which give readings of no use.
    """
    single = refs.where(F.col("aggregation").isin("slice", "bracket", "interpolate"))
    many = single.where(F.size("sources") != 1).select("timeseries_id", F.lit("needs one source").alias("issue"))
    ranged = single.where("aggregation <> 'slice' and size(sources) = 1")
    open_ = ranged.where("valid_from is null or valid_to is null").select("timeseries_id", F.lit("needs a window").alias("issue"))
    whole = ranged.where("valid_from is not null and valid_to is not null")
    kinds = {k: endpoints(whole, readings, k) for k in ("bracket", "interpolate")}
    loose = kinds["bracket"].unionByName(kinds["interpolate"]).where("v_lo is null or v_hi is null").select("timeseries_id", F.lit("no anchor").alias("issue"))
    days = F.datediff(F.col("t_hi").cast("date"), F.col("t_lo").cast("date"))
    flat = kinds["interpolate"].where(days <= 0).select("timeseries_id", F.lit("no span").alias("issue"))
    mixed = overlapping_sources(refs, readings).select("timeseries_id").distinct().withColumn("issue", F.lit("sources overlap"))
    if by_dependency:
        late = dependency_levels(refs).where("level is null").select("timeseries_id", F.lit("cycle of sources").alias("issue"))
    else:
        turn = F.array_position(F.array(*(F.lit(k) for k in KINDS)), F.col("aggregation"))
        made = refs.select(F.col("timeseries_id").alias("source"), turn.alias("made"))
        late = explode_sources(refs).withColumn("turn", turn).join(made, "source").where("made >= turn or aggregation = 'slice'")
        late = late.select("timeseries_id").distinct().withColumn("issue", F.lit("source made later"))
    return many.unionByName(open_).unionByName(loose).unionByName(flat).unionByName(mixed).unionByName(late)


#: The kinds in the order in which they are made.
KINDS = {"slice": slices, "sum": sums, "bracket": brackets, "interpolate": interpolations, "rolling_sum": rolling_sums}


def materialize(refs: DataFrame, readings: DataFrame, by_dependency: bool = False) -> DataFrame:
    """Readings of all derived references, kind by kind: slices, sums, brackets, interpolations,
    rolling sums. Each kind reads raw series and what earlier kinds made. `by_dependency` makes
    references level by level instead, so that each reads all of its sources, whatever their kinds;
    those on a cycle of sources give nothing."""
    if by_dependency:
        levels = staged(dependency_levels(refs).where("level is not null"), "levels")
        found = refs.join(levels, "timeseries_id").select("level", "aggregation").distinct().collect()  # five kinds per level at most
        steps = [(refs.join(levels.where(F.col("level") == n), "timeseries_id", "left_semi"), [k for k in KINDS if (n, k) in found]) for n in sorted({r.level for r in found})]
    else:
        steps = [(refs.where(F.col("aggregation") == kind), [kind]) for kind in KINDS]
    cols = ["timeseries_id", "timestamp", "value"]
    # every kind reads its sources more than once: those of all are written once
    needed = refs.select(F.explode("sources").alias("timeseries_id")).distinct()
    readings = staged(readings.join(needed, "timeseries_id", "left_semi"), "sources")
    have, made = readings.select(*cols), None
    for i, (part, kinds) in enumerate(steps):
        raw = have.withColumn("recorded_at", F.lit(None).cast("timestamp")) if by_dependency else readings
        new = reduce(DataFrame.unionByName, (KINDS[kind](part, raw if kind == "slice" else have).select(cols) for kind in kinds))
        # each step is written once; the last one has no readers here
        new = new if i == len(steps) - 1 else staged(new, "derived")
        have, made = have.unionByName(new), new if made is None else made.unionByName(new)
    return have.limit(0) if made is None else made
