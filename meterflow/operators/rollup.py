"""Attribution to places, roll-ups and reports (Q1-Q15, Q19, Q20)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.temporal import month_of, valid_at
from meterflow.plans.stage import staged


def attributed(net: DataFrame, measures: DataFrame, zones: DataFrame, buildings: DataFrame) -> DataFrame:
    """(meter_id, timestamp, net, zone_id, building_id, campus_id): net of each active measure, with
    the places above its target. A meter that measures several targets gives a row for each."""
    rows = net.join(measures, "meter_id").where(valid_at(F.col("timestamp"), F.col("valid_from"), F.col("valid_to")))
    is_ = lambda kind: F.col("target_kind") == kind
    rows = rows.withColumn("zone_id", F.when(is_("zone"), F.col("target_id")))
    rows = rows.join(zones.select("zone_id", F.col("building_id").alias("zone_building")), "zone_id", "left")
    rows = rows.withColumn("building_id", F.when(is_("building"), F.col("target_id")).otherwise(F.col("zone_building")))
    rows = rows.join(buildings.select("building_id", F.col("campus_id").alias("building_campus")), "building_id", "left")
    campus = F.when(is_("campus"), F.col("target_id")).otherwise(F.col("building_campus"))
    return rows.select("meter_id", "timestamp", "net", "zone_id", "building_id", campus.alias("campus_id"))


def consumption(placed: DataFrame) -> DataFrame:
    """(level, id, timestamp, net): sums per zone, building and campus in one aggregation."""
    levels = F.array(*(F.struct(F.lit(n).alias("level"), F.col(f"{n}_id").alias("id")) for n in ("zone", "building", "campus")))
    rows = placed.select("timestamp", "net", F.explode(levels).alias("at")).where("at.id is not null")
    return rows.groupBy("at.level", "at.id", "timestamp").agg(F.sum("net").alias("net"))


def consumption_totals(by_place: DataFrame, start: str, end: str, level: str | None = None, targets: DataFrame | None = None) -> DataFrame:
    """(level, id, total) over [start, end), largest first."""
    rows = by_place.where((F.col("timestamp") >= start) & (F.col("timestamp") < end))
    rows = rows.where(F.col("level") == level) if level else rows
    rows = rows.join(targets.select("id").distinct(), "id", "left_semi") if targets is not None else rows
    return rows.groupBy("level", "id").agg(F.sum("net").alias("total")).orderBy(F.desc("total"), "level", "id")


def conservation(flow: DataFrame, net: DataFrame, meters: DataFrame, relations: DataFrame, media: str) -> DataFrame:
    """(day, campus, buildings): flow of campus-level meters without a parent, against net of building meters."""
    own = meters.where(F.col("media_type_id") == media)
    roots = own.where("building_id is null").join(relations.select(F.col("child_meter_id").alias("meter_id")), "meter_id", "left_anti").select("meter_id")
    inside = own.where("building_id is not null").select("meter_id")
    day = F.col("timestamp").cast("date").alias("day")
    drawn = flow.join(roots, "meter_id", "left_semi").groupBy(day).agg(F.sum("delta").alias("campus"))
    used = net.join(inside, "meter_id", "left_semi").groupBy(day).agg(F.sum("net").alias("buildings"))
    return drawn.join(used, "day", "full_outer")


def conservation_monthly(daily: DataFrame) -> DataFrame:
    """(month, campus, buildings, residual, residual_pct): no percentage where the campus drew nothing."""
    m = daily.groupBy(month_of(F.col("day")).alias("month")).agg(
        F.coalesce(F.sum("campus"), F.lit(0.0)).alias("campus"), F.coalesce(F.sum("buildings"), F.lit(0.0)).alias("buildings")
    )
    residual = F.col("campus") - F.col("buildings")
    return m.select("month", "campus", "buildings", residual.alias("residual"), (residual / F.nullif("campus", F.lit(0.0)) * 100).alias("residual_pct"))


def building_totals(net: DataFrame, meters: DataFrame, buildings: DataFrame, media: list[str], year: int) -> DataFrame:
    """One row per building, a column per medium: the year's net. Null where no meter of the medium
    is in the building, 0 where there is one without readings."""
    total = (
        meters.where(F.col("building_id").isNotNull())
        .join(net.where(F.year("timestamp") == year).groupBy("meter_id").agg(F.sum("net").alias("net")), "meter_id", "left")
        .groupBy("building_id")
        .pivot("media_type_id", media)
        .agg(F.sum(F.coalesce("net", F.lit(0.0))))
    )
    return buildings.select("building_id", "campus_id").join(total, "building_id", "left")


def compare_reported(reported: DataFrame, computed: DataFrame, reasons: DataFrame, months: list[str]) -> DataFrame:
    """(building_id, month, reported, computed, diff, diff_pct, reason, total_diff), buildings with
    nothing on either side left out, largest total absolute difference first. Inputs: (building_id,
    month, value)."""
    keep = lambda df, name: df.where(F.col("month").isin(months)).select("building_id", "month", F.col("value").alias(name))
    both = keep(reported, "reported").join(keep(computed, "computed"), ["building_id", "month"], "full_outer")
    both = both.select("building_id", "month", F.coalesce("reported", F.lit(0.0)).alias("reported"), F.coalesce("computed", F.lit(0.0)).alias("computed"))
    both = both.withColumn("diff", F.col("computed") - F.col("reported")).withColumn("diff_pct", F.col("diff") / F.nullif("reported", F.lit(0.0)) * 100)
    both = both.join(reasons.select("building_id", "month", "reason"), ["building_id", "month"], "left")
    of = Window.partitionBy("building_id")
    live = both.withColumn("total_diff", F.sum(F.abs("diff")).over(of)).withColumn("live", F.max((F.abs("reported") > 0) | (F.abs("computed") > 0)).over(of))
    return live.where("live").drop("live").orderBy(F.desc("total_diff"), "building_id", "month")


#: Short labels of unit codes.
UNIT_LABELS = {"KiloW-HR": "kWh", "MegaW-HR": "MWh", "M3": "m³"}
#: What values of a unit are multiplied by to be comparable: energy in kWh, volume in cubic metres.
UNIT_FACTORS = {"KiloW-HR": 1.0, "MegaW-HR": 1000.0, "M3": 1.0}


def unit_factor(unit: Column) -> Column:
    """The factor of a unit, null for others and for "mixed"."""
    return F.coalesce(*(F.when(unit == code, k) for code, k in UNIT_FACTORS.items()))


def rescaled(flow: DataFrame, units: DataFrame) -> DataFrame:
    """`flow` (meter_id, timestamp, delta) in comparable units, by the units of `unit_of`; rows of meters
    without a known unit have a null delta."""
    k = units.select("meter_id", unit_factor(F.col("unit")).alias("k"))
    return flow.join(k, "meter_id", "left").select("meter_id", "timestamp", (F.col("delta") * F.col("k")).alias("delta"))


def unit_of(sensors: DataFrame, refs: DataFrame) -> DataFrame:
    """(meter_id, unit, label, granularity): one unit or "mixed"; granularity of its first preferred counter."""
    unit = F.when(F.count_distinct("unit") == 1, F.min("unit")).otherwise("mixed")
    units = sensors.groupBy("meter_id").agg(unit.alias("unit"))
    label = F.col("unit")
    for code, short in UNIT_LABELS.items():
        label = F.when(F.col("unit") == code, short).otherwise(label)
    first = (
        refs.where("preferred and reading_type = 'counter'")
        .join(sensors.select("sensor_id", "meter_id"), "sensor_id")
        .groupBy("meter_id")
        .agg(F.min_by("aggregate", "timeseries_id").alias("granularity"))
    )
    return units.join(first, "meter_id", "left").select("meter_id", "unit", label.alias("label"), "granularity")


def descendants(relations: DataFrame, roots: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(meter_id): the roots and all meters below them, whatever the edges' validity."""
    e = staged(relations.select(F.col("parent_meter_id").alias("meter_id"), F.col("child_meter_id").alias("next")).distinct(), "edges")
    seen = staged(roots.select("meter_id").distinct(), "seen")
    front = seen
    for _ in range(max_rounds):
        front = staged(e.join(front, "meter_id").select(F.col("next").alias("meter_id")).distinct().join(seen, "meter_id", "left_anti"), "front")
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
    raise RuntimeError(f"more than {max_rounds} levels")


def drilldown(members: DataFrame, relations: DataFrame, flow: DataFrame, flip: bool = False) -> DataFrame:
    """(meter_id, role, timestamp, delta) of the member meters: role "sub" where a parent is a member
    too, else "add"; with `flip`, subtracted meters count negative."""
    inside = members.select("meter_id").distinct()
    below = (
        relations.join(inside.withColumnRenamed("meter_id", "parent_meter_id"), "parent_meter_id", "left_semi")
        .select(F.col("child_meter_id").alias("meter_id"))
        .distinct()
        .withColumn("below", F.lit(True))
    )
    role = F.when(F.col("below"), "sub").otherwise("add")
    rows = flow.join(inside.join(below, "meter_id", "left").select("meter_id", role.alias("role")), "meter_id")
    sign = F.when((F.col("role") == "sub") & F.lit(flip), -1.0).otherwise(1.0)
    return rows.select("meter_id", "role", "timestamp", (F.col("delta") * sign).alias("delta"))


def drilldown_pivot(rows: DataFrame, months: list[str]) -> DataFrame:
    """A row per meter, columns per month and the row's total; a last row Σ with the columns' sums."""
    wide = rows.groupBy("meter_id", "role").pivot("month", months).agg(F.sum("delta")) if "month" in rows.columns else None
    if wide is None:
        return drilldown_pivot(rows.withColumn("month", month_of(F.col("timestamp"))), months)
    total = reduce(lambda a, b: a + b, (F.coalesce(F.col(f"`{m}`"), F.lit(0.0)) for m in months))
    wide = wide.withColumn("total", total)
    foot = wide.agg(*(F.sum(F.col(f"`{m}`")).alias(m) for m in months), F.sum("total").alias("total")).select(F.lit("Σ").alias("meter_id"), F.lit("total").alias("role"), *months, "total")
    order = F.when(F.col("role") == "add", 0).when(F.col("role") == "sub", 1).otherwise(2)
    return wide.unionByName(foot).orderBy(order, "meter_id")


def topology_as_of(meters: DataFrame, relations: DataFrame, date: str) -> DataFrame:
    """The edges active on a date whose meters are both active."""
    on = F.lit(date).cast("date")
    live = meters.where(valid_at(on, F.col("valid_from"), F.col("valid_to"))).select("meter_id")
    edges = relations.where(valid_at(on, F.col("valid_from"), F.col("valid_to")))
    for end in ("parent_meter_id", "child_meter_id"):
        edges = edges.join(live.withColumnRenamed("meter_id", end), end, "left_semi")
    return edges.select(relations.columns)


def filter_by_media(tables: dict[str, DataFrame], media: str) -> dict[str, DataFrame]:
    """All tables of a dataset, restricted to one medium; tables it does not restrict stay whole."""
    t = dict(tables)
    semi = lambda df, other, key, name=None: df.join(other.select(F.col(key).alias(name or key)).distinct(), name or key, "left_semi").select(df.columns)
    t["meters"] = t["meters"].where(F.col("media_type_id") == media)
    t["media_types"] = t["media_types"].where(F.col("media_type_id") == media)
    t["sensors"] = semi(t["sensors"], t["meters"], "meter_id")
    t["timeseries_refs"] = semi(t["timeseries_refs"], t["sensors"], "sensor_id")
    t["readings"] = semi(t["readings"], t["timeseries_refs"], "timeseries_id")
    t["devices"] = semi(t["devices"], t["timeseries_refs"], "device_id")
    t["meter_measures"] = semi(t["meter_measures"], t["meters"], "meter_id")
    t["buildings"] = semi(t["buildings"], t["meters"], "building_id")
    t["zones"] = semi(t["zones"], t["buildings"], "building_id")
    r = t["meter_relations"]
    own = lambda end: t["meters"].select(F.col("meter_id").alias(end), F.lit(True).alias(f"own_{end}"))
    r2 = r.join(own("parent_meter_id"), "parent_meter_id", "left").join(own("child_meter_id"), "child_meter_id", "left")
    t["meter_relations"] = r2.where("own_parent_meter_id or own_child_meter_id").select(r.columns)
    a = t["annotations"].where((F.col("media").isNull()) | (F.lower("media") == media.lower()))
    kinds = [("meter", t["meters"], "meter_id"), ("building", t["buildings"], "building_id"), ("timeseries", t["timeseries_refs"], "timeseries_id")]
    kept = a.where("target_kind = 'campus'")
    for kind, df, key in kinds:
        kept = kept.unionByName(semi(a.where(F.col("target_kind") == kind), df, key, "target_id"))
    t["annotations"] = kept
    return t


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n): rows of every table."""
    return reduce(DataFrame.unionByName, (df.select(F.lit(name).alias("name")).agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in sorted(tables.items())))


def register_views(tables: dict[str, DataFrame], prefix: str = "") -> None:
    """Temporary views of all tables, for SQL over them."""
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)
