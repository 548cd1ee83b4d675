"""Daily registers: deltas, month statistics, anomalies and counter events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.temporal import month_of
from meterflow.plans.quantiles import percentiles
from meterflow.plans.stage import staged

EPS = 1e-6
#: Values at which registers of known devices wrap.
CEILINGS = (1e6, 1e7, 1e8)
ROLLOVER_TOLERANCE = 0.03


def daily_delta(register: DataFrame) -> DataFrame:
    delta = F.col("v_last") - F.col("v_first")
    return register.withColumn("delta", delta).withColumn("is_reset", delta < 0)


def monthly_register_delta(register: DataFrame) -> DataFrame:
    """(meter_id, month, delta, n_days, zero_days, reset_days, first_day, last_day).

    Within a month, a row that falls inside its day or starts below the end of the row before it
    starts a new segment; the month's delta is the sum over segments of last minus first, without
    segments that end below their start.
    """
    rows = register.withColumn("month", month_of(F.col("day")))
    by_day = Window.partitionBy("meter_id", "month").orderBy("day")
    before = F.lag("v_last").over(by_day)
    inside = F.col("v_last") < F.col("v_first") - EPS
    between = F.coalesce(F.col("v_first") < before - EPS, F.lit(False))
    rows = rows.withColumn("inside", inside).withColumn("between", between)
    rows = rows.withColumn("segment", F.sum((F.col("inside") | F.col("between")).cast("int")).over(by_day))
    parts = rows.groupBy("meter_id", "month", "segment").agg(
        (F.max_by("v_last", "day") - F.min_by("v_first", "day")).alias("d"),
        F.count("*").alias("n"),
        F.count_if(F.abs(F.col("v_last") - F.col("v_first")) < 1e-9).alias("zero"),
        F.sum(F.col("inside").cast("int") + F.col("between").cast("int")).alias("reset"),
        F.min("day").alias("a"),
        F.max("day").alias("b"),
    )
    return parts.groupBy("meter_id", "month").agg(
        F.sum(F.when(F.col("d") >= 0, F.col("d")).otherwise(0.0)).alias("delta"),
        F.sum("n").alias("n_days"), F.sum("zero").alias("zero_days"), F.sum("reset").alias("reset_days"), F.min("a").alias("first_day"), F.max("b").alias("last_day"),
    )


def no_readings(listed: DataFrame, daily: DataFrame) -> DataFrame:
    missing = listed.select("meter_id").distinct().join(daily.select("meter_id"), "meter_id", "left_anti")
    return missing.select("meter_id", F.lit("no_readings").alias("flag"), F.lit("").alias("detail"))


def flat_all_window(daily: DataFrame) -> DataFrame:
    total = F.sum(F.greatest("delta", F.lit(0.0)))
    return daily.groupBy("meter_id").agg(total.alias("t")).where("t = 0").select("meter_id", F.lit("flat_all_window").alias("flag"), F.lit("").alias("detail"))


def reset_days(daily: DataFrame) -> DataFrame:
    """Meters with days that end below their start, the days in the detail."""
    days = F.array_join(F.array_sort(F.collect_list(F.col("day").cast("string"))), ",")
    return daily.where("is_reset").groupBy("meter_id").agg(days.alias("detail")).select("meter_id", F.lit("reset_days").alias("flag"), "detail")


def mostly_zero(daily: DataFrame, share: float = 0.5) -> DataFrame:
    zero = F.count_if(F.abs("delta") < 1e-9)
    m = daily.groupBy("meter_id").agg(zero.alias("z"), F.count("*").alias("n"), F.sum(F.greatest("delta", F.lit(0.0))).alias("t"))
    return m.where((F.col("z") > share * F.col("n")) & (F.col("t") > 0)).select("meter_id", F.lit("mostly_zero").alias("flag"), F.concat_ws("/", "z", "n").alias("detail"))


def coverage_gap(daily: DataFrame) -> DataFrame:
    m = daily.groupBy("meter_id").agg(F.count("*").alias("n"), (F.datediff(F.max("day"), F.min("day")) + 1).alias("span"))
    return m.where("n < span").select("meter_id", F.lit("coverage_gap").alias("flag"), F.concat_ws("/", "n", "span").alias("detail"))


def anomalies(listed: DataFrame, daily: DataFrame) -> DataFrame:
    """(meter_id, flag, detail) of all anomaly rules."""
    return reduce(DataFrame.unionByName, (no_readings(listed, daily), flat_all_window(daily), reset_days(daily), mostly_zero(daily), coverage_gap(daily)))


def near_ceiling(value: Column) -> Column:
    """True just below a value at which registers wrap."""
    return reduce(lambda a, b: a | b, ((value >= c * (1 - ROLLOVER_TOLERANCE)) & (value <= c) for c in CEILINGS))


def reset_events(daily: DataFrame) -> DataFrame:
    """(meter_id, swap_date, event_type, old_last_value) for every reset day: activity on at least 3
    of the next 14 rows makes it a swap, or a rollover if it starts just below a ceiling; else offline."""
    ahead = Window.partitionBy("meter_id").orderBy("day").rowsBetween(1, 14)
    active = F.coalesce(F.sum((F.col("delta") > 0.1).cast("int")).over(ahead), F.lit(0))
    kind = F.when(F.col("active") < 3, "offline").when(near_ceiling(F.col("v_first")), "rollover").otherwise("swap")
    rows = daily.withColumn("active", active).where("is_reset")
    return rows.select("meter_id", F.col("day").alias("swap_date"), kind.alias("event_type"), F.col("v_first").alias("old_last_value"))


def frozen_tail(daily: DataFrame, least: int = 5) -> DataFrame:
    """Offline events of meters whose last `least` rows or more have no change, after some that had."""
    last = daily.where("delta <> 0").groupBy("meter_id").agg(F.max("day").alias("active"))
    tail = daily.join(last, "meter_id").where("day > active").groupBy("meter_id")
    ends = tail.agg(F.count("*").alias("n"), F.min(F.struct("day", "v_last")).alias("f")).where(F.col("n") >= least)
    return ends.select("meter_id", F.col("f.day").alias("swap_date"), F.lit("offline").alias("event_type"), F.col("f.v_last").alias("old_last_value"))


def merge_offline(resets: DataFrame, frozen: DataFrame) -> DataFrame:
    """Events of both kinds: offline resets move back to an earlier freeze of their meter, and only
    the earliest offline event of a meter stays (resets before freezes on one day)."""
    freeze = frozen.groupBy("meter_id").agg(F.min("swap_date").alias("freeze"))
    moved = resets.join(freeze, "meter_id", "left").withColumn("was", F.col("swap_date"))
    moved = moved.withColumn("swap_date", F.when(F.col("event_type") == "offline", F.least("swap_date", "freeze")).otherwise(F.col("swap_date")))
    both = moved.withColumn("rank", F.lit(0)).drop("freeze").unionByName(frozen.withColumn("rank", F.lit(1)).withColumn("was", F.col("swap_date")))
    cols = ["swap_date", "event_type", "old_last_value"]
    first = F.min_by(F.struct(*cols), F.struct("swap_date", "rank", "was"))
    offline = both.where("event_type = 'offline'").groupBy("meter_id").agg(first.alias("e")).select("meter_id", *(f"e.{c}" for c in cols))
    return both.where("event_type <> 'offline'").select("meter_id", *cols).unionByName(offline)


def glitches(daily: DataFrame, handled: DataFrame) -> DataFrame:
    """(meter_id, swap_date, event_type, old_last_value, glitch_end): the register falls by more than
    100 from one row to the next and is back, within a tenth of the fall, on one of the next 5 rows.
    The glitch ends on the row after that. Days of other events do not start one, and the search
    goes on after the recovery, so glitches of a meter do not overlap. The last row starts none.
    """
    by_day = Window.partitionBy("meter_id").orderBy("day")
    prev = F.lag("v_last").over(by_day)
    rows = daily.select("meter_id", "day", "v_last", F.row_number().over(by_day).alias("i"), prev.alias("prev"), F.lead("day").over(by_day).alias("next_day"))
    ahead = [F.lead(F.struct(F.col("v_last").alias("v"), F.coalesce("next_day", "day").alias("end")), k).over(by_day) for k in range(1, 6)]
    rows = rows.select("meter_id", "day", "v_last", "i", "prev", "next_day", *(a.alias(f"a{k + 1}") for k, a in enumerate(ahead)))
    back = lambda k: F.abs(F.col(f"a{k}.v") - F.col("prev")) < F.abs(F.col("v_last") - F.col("prev")) * 0.1
    k = F.coalesce(*(F.when(back(j), j) for j in range(1, 6)))
    end = F.coalesce(*(F.when(back(j), F.col(f"a{j}.end")) for j in range(1, 6)))
    found = rows.where((F.col("v_last") - F.col("prev") < -100) & F.col("next_day").isNotNull()).withColumn("k", k).withColumn("end", end).where("k is not null")
    found = found.join(handled.select("meter_id", F.col("swap_date").alias("day")).distinct(), ["meter_id", "day"], "left_anti")
    # of overlapping ones the first, then the first that starts after its recovery, and so on
    one = F.struct("i", "k", "day", "prev", "end")
    kept = F.aggregate(
        F.array_sort(F.collect_list(one)),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<i:int,k:int,day:date,prev:double,end:date>>").alias("g")),
        lambda a, x: F.when(x["i"] > a["at"], F.struct((x["i"] + x["k"]).alias("at"), F.array_append(a["g"], x).alias("g"))).otherwise(a),
        lambda a: a["g"],
    )
    g = found.groupBy("meter_id").agg(kept.alias("g")).select("meter_id", F.explode("g").alias("x"))
    return g.select("meter_id", F.col("x.day").alias("swap_date"), F.lit("glitch").alias("event_type"), F.col("x.prev").alias("old_last_value"), F.col("x.end").alias("glitch_end"))


def detect_events(daily: DataFrame) -> DataFrame:
    """All events of registers: swaps, rollovers, offline and glitches."""
    events = merge_offline(reset_events(daily), frozen_tail(daily))
    return events.withColumn("glitch_end", F.lit(None).cast("date")).unionByName(glitches(daily, events))


def segments_from_events(events: DataFrame) -> DataFrame:
    """(meter_id, position, valid_from, valid_to): the stretches between a meter's events, in order.

    Swaps and rollovers end a stretch and start the next on the same day; a glitch leaves out the
    days up to its end; after an offline event there is none until a swap, rollover or glitch.
    """
    kind = {"swap": 0, "rollover": 1, "glitch": 2, "offline": 3}
    rank = reduce(lambda a, kv: a.when(F.col("event_type") == kv[0], kv[1]), kind.items(), F.when(F.lit(False), 9))
    event = F.struct(F.col("swap_date").alias("day"), rank.alias("rank"), F.coalesce("glitch_end", "swap_date").alias("resume"))
    by_day = Window.partitionBy("meter_id").orderBy("e.day", "e.rank")
    rows = events.select("meter_id", event.alias("e")).withColumn("before", F.lag("e").over(by_day)).withColumn("i", F.row_number().over(by_day)).withColumn("last", F.lead("e").over(by_day).isNull())
    resume = lambda e: F.when(e["rank"] == 3, None).when(e["rank"] == 2, e["resume"]).otherwise(e["day"])
    running = F.col("before").isNull() | (F.col("before.rank") != 3)
    closed = rows.where(running).select("meter_id", "i", F.when(F.col("before").isNotNull(), resume(F.col("before"))).alias("valid_from"), F.col("e.day").alias("valid_to"))
    tail = rows.where(F.col("last") & (F.col("e.rank") != 3)).select("meter_id", (F.col("i") + 1).alias("i"), resume(F.col("e")).alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    order = Window.partitionBy("meter_id").orderBy("i")
    return closed.unionByName(tail).select("meter_id", (F.row_number().over(order) - 1).alias("position"), "valid_from", "valid_to")


def refs_from_segments(meters: DataFrame, segments: DataFrame, database: str, path: str) -> DataFrame:
    """References of meters (facit_id, meter_id): one raw preferred reference for at most one segment;
    else raw references A, B, ... and one preferred rolling sum of them."""
    segments = staged(segments, "segments")  # read several times, and dear to compute
    n = segments.groupBy("meter_id").agg(F.count("*").alias("n"))
    rows = meters.join(n, "meter_id", "left").join(segments, "meter_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sensor, base = F.concat("facit_id", F.lit(".energy")), F.concat("facit_id", F.lit(":d"))
    letter = F.char(F.col("position") + 65)
    nothing = F.lit(None).cast("string")
    raw = rows.select(
        F.when(F.col("n") <= 1, base).otherwise(F.concat(base, F.lit("."), letter)).alias("timeseries_id"), sensor.alias("sensor_id"),
        F.lit("raw").alias("kind"), (F.col("n") <= 1).alias("preferred"), "valid_from", "valid_to", F.lit(database).alias("database_id"), F.lit(path).alias("path"),
        F.col("meter_id").alias("external_id"), F.array().cast("array<string>").alias("sources"), nothing.alias("aggregation"),
    )
    stitched = rows.where("n > 1").groupBy("facit_id").agg(F.array_sort(F.collect_list("position")).alias("p"))
    stitched = stitched.select(
        base.alias("timeseries_id"), sensor.alias("sensor_id"), F.lit("derived").alias("kind"), F.lit(True).alias("preferred"),
        F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), nothing.alias("database_id"), nothing.alias("path"), nothing.alias("external_id"),
        F.transform("p", lambda p: F.concat(base, F.lit("."), F.char(p + 65))).alias("sources"), F.lit("rolling_sum").alias("aggregation"),
    )
    both = raw.unionByName(stitched)
    return both.select("*", F.lit("daily").alias("aggregate"), F.lit("counter").alias("reading_type"))


def outage_patches(refs: DataFrame, offline: DataFrame, crosswalk: DataFrame, relations: DataFrame) -> DataFrame:
    """References after patching: a meter that went offline (meter_id, swap_date) and has children gets
    the sum of their series from that day as another source; a raw series is renamed .raw and stitched
    with the patch. Meters without children or reference stay as they are. crosswalk: (key, id) from
    register id to meter."""
    children = relations.groupBy(F.col("parent_meter_id").alias("meter")).agg(F.array_sort(F.collect_list(F.concat("child_meter_id", F.lit(":d")))).alias("children"))
    down = offline.join(crosswalk, offline["meter_id"] == crosswalk["key"]).groupBy(F.col("id").alias("meter")).agg(F.min("swap_date").alias("since"))
    todo = down.join(children, "meter").select(F.concat("meter", F.lit(":d")).alias("timeseries_id"), "since", "children")
    both = refs.join(todo, "timeseries_id", "left")
    hit, raw = F.col("since").isNotNull(), F.col("kind") == "raw"
    patch_id = F.concat("timeseries_id", F.lit(".patch"))
    nothing = F.lit(None).cast("string")
    derived = lambda df, **to: df.select(*(to.get(c, nothing if c in ("database_id", "path", "external_id", "device_id") else F.col(c)).alias(c) for c in refs.columns))
    kept = both.select(
        *(
            {
                "timeseries_id": F.when(hit & raw, F.concat("timeseries_id", F.lit(".raw"))).otherwise(F.col("timeseries_id")),
                "preferred": F.col("preferred") & ~(hit & raw),
                "sources": F.when(hit & ~raw, F.array_append("sources", patch_id)).otherwise(F.col("sources")),
            }
            .get(c, F.col(c))
            .alias(c)
            for c in refs.columns
        )
    )
    new = both.where(hit)
    far = F.lit(None).cast("date")
    patch = derived(
        new, timeseries_id=patch_id, kind=F.lit("derived"), preferred=F.lit(False), valid_from=F.col("since"), valid_to=far, sources=F.col("children"), aggregation=F.lit("sum")
    )
    stitched = derived(
        new.where(raw), kind=F.lit("derived"), preferred=F.lit(True), valid_from=far, valid_to=far,
        sources=F.array(F.concat("timeseries_id", F.lit(".raw")), patch_id), aggregation=F.lit("rolling_sum"),
    )
    return kept.unionByName(patch).unionByName(stitched)


def meter_validity_hint(monthly: DataFrame, cutoff: str) -> DataFrame:
    """(meter_id, valid_from, valid_to): from the first month if it is after the cutoff; up to the
    first month if every month is 0."""
    m = monthly.groupBy("meter_id").agg(F.min("month").alias("first"), F.bool_and(F.col("delta") == 0).alias("idle"))
    day = F.to_date(F.concat("first", F.lit("-01")))
    return m.select("meter_id", F.when(F.col("first") > cutoff, day).alias("valid_from"), F.when(F.col("idle"), day).alias("valid_to"))


def quality_scan(daily: DataFrame, flat_days: int = 4, active: Column | None = None) -> DataFrame:
    """(meter_id, flag, n): runs of at least `flat_days` rows without change (flat_run), deltas above
    max(3 * p99, 10 * median) (spike) and above 10 * the third quartile (outlier), exact percentiles.
    `active` tells rows of the season in which a meter has to move: others end a flat run."""
    by_day = Window.partitionBy("meter_id").orderBy("day")
    still = (F.col("delta") == 0) & (active if active is not None else F.lit(True))
    run = F.sum((~still).cast("int")).over(by_day)
    flats = daily.withColumn("still", still).withColumn("run", run).where("still").groupBy("meter_id", "run").agg(F.count("*").alias("n")).where(F.col("n") >= flat_days)
    flat = flats.groupBy("meter_id").agg(F.count("*").alias("n")).select("meter_id", F.lit("flat_run").alias("flag"), "n")
    q = percentiles(daily, "meter_id", "delta", [0.5, 0.75, 0.99])
    rows = daily.join(q, "meter_id")
    spike = rows.where(F.col("delta") > F.greatest(3 * F.col("q")[2], 10 * F.col("q")[0]))
    high = rows.where(F.col("delta") > 10 * F.col("q")[1])
    count = lambda df, flag: df.groupBy("meter_id").agg(F.count("*").alias("n")).select("meter_id", F.lit(flag).alias("flag"), "n")
    return flat.unionByName(count(spike, "spike")).unionByName(count(high, "outlier"))


def signal_table(daily: DataFrame, refs: DataFrame, today: str, silent_days: int = 7) -> DataFrame:
    """(meter_id, signal): "sparse" for a median gap of 2 days or more between rows, "offline" without
    rows for more than `silent_days`, "unknown_source" for ids that no reference has."""
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy("meter_id").orderBy("day")))
    m = daily.withColumn("gap", gap).groupBy("meter_id").agg(F.median("gap").alias("gap"), F.max("day").alias("last"))
    sparse = m.where("gap >= 2").select("meter_id", F.lit("sparse").alias("signal"))
    off = m.where(F.datediff(F.lit(today).cast("date"), "last") > silent_days).select("meter_id", F.lit("offline").alias("signal"))
    known = refs.select(F.col("external_id").alias("meter_id")).where("meter_id is not null")
    strange = m.join(known, "meter_id", "left_anti").select("meter_id", F.lit("unknown_source").alias("signal"))
    return sparse.unionByName(off).unionByName(strange)


def silent_among_siblings(daily: DataFrame, edges: DataFrame, least: int = 7) -> DataFrame:
    """(meter_id, parent, starts, ends, n): runs of at least `least` rows on which a meter shows no
    change while its siblings together do. edges (parent, meter_id)."""
    rows = daily.select("meter_id", "day", "delta").join(edges.select("parent", "meter_id").distinct(), "meter_id")
    totals = rows.groupBy("parent", "day").agg(F.sum("delta").alias("total"))
    rows = rows.join(totals, ["parent", "day"]).withColumn("silent", (F.col("delta") == 0) & (F.col("total") > 0))
    run = F.sum((~F.col("silent")).cast("int")).over(Window.partitionBy("parent", "meter_id").orderBy("day"))
    runs = rows.withColumn("run", run).where("silent").groupBy("parent", "meter_id", "run").agg(F.min("day").alias("starts"), F.max("day").alias("ends"), F.count("*").alias("n"))
    return runs.where(F.col("n") >= least).select("meter_id", "parent", "starts", "ends", "n")


def synchronized_catch_up(daily: DataFrame, places: DataFrame, flat: int = 2, meters: int = 3) -> DataFrame:
    """(place, day, n): days on which at least `meters` meters of a place move again after `flat` rows
    or more without change. places (meter_id, place)."""
    by_day = Window.partitionBy("meter_id").orderBy("day")
    still = F.sum((F.col("delta") == 0).cast("int")).over(by_day.rowsBetween(-flat, -1))
    back = daily.select("meter_id", "day", "delta", still.alias("still")).where((F.col("delta") > 0) & (F.col("still") == flat))
    return back.join(places, "meter_id").groupBy("place", "day").agg(F.count_distinct("meter_id").alias("n")).where(F.col("n") >= meters)


def stitch_artefacts(daily: DataFrame, segments: DataFrame, share: float = 0.01) -> DataFrame:
    """(meter_id, day, jump): first rows of segments after the first (meter_id, position, valid_from)
    that start away from the end of the row before by more than `share` of it."""
    before = F.lag("v_last").over(Window.partitionBy("meter_id").orderBy("day"))
    rows = daily.select("meter_id", "day", "v_first", before.alias("before"))
    at = segments.where("position > 0 and valid_from is not null").select("meter_id", F.col("valid_from").alias("day"))
    jump = F.abs(F.col("v_first") - F.col("before"))
    return rows.join(at, ["meter_id", "day"]).where((F.col("before") > 0) & (jump > share * F.col("before"))).select("meter_id", "day", jump.alias("jump"))
