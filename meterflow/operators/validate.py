"""Structural rules (V1-V18). Every rule returns (rule, subject, message, context map<string, string>)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterflow.functions.temporal import lower, upper
from meterflow.plans.cycles import shortest_cycles
from meterflow.plans.overlap import overlapping_pairs

AGGREGATIONS = ("sum", "rolling_sum", "bracket", "interpolate", "slice")
SCHEMA = "rule string, subject string, message string, context map<string,string>"


def violation(df: DataFrame, rule: str, subject: Column, message: str, **context: Column) -> DataFrame:
    pairs = [x for k, v in context.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.lit(rule).alias("rule"), subject.alias("subject"), F.lit(message).alias("message"), (F.create_map(*pairs) if pairs else F.create_map()).cast("map<string,string>").alias("context"))


def _edge() -> Column:
    return F.concat_ws("->", "parent_meter_id", "child_meter_id")


def no_cycles(relations: DataFrame) -> DataFrame:
    """Cycles of edges that hold at one instant: for every meter that is the smallest of a cycle, the
    shortest one (of several the first by the names on it).

    The graph is reduced and split into strongly connected parts first; paths are searched only inside
    those (see `plans.cycles`).
    """
    e = relations.select(F.col("parent_meter_id").alias("a"), F.col("child_meter_id").alias("b"), lower(F.col("valid_from")).alias("lo"), upper(F.col("valid_to")).alias("hi"))
    cycle = shortest_cycles(e)
    return violation(cycle, "no_cycles", F.array_join("path", "->"), "edges that hold at one time form a cycle", length=F.size("path"))


def feeds_requires_coefficient(relations: DataFrame) -> DataFrame:
    return violation(relations.where("relation_type = 'feeds' and flow_coefficient is null"), "feeds_requires_flow_coefficient", _edge(), "a feeds edge needs a coefficient")


def feeds_coefficient_positive(relations: DataFrame) -> DataFrame:
    bad = relations.where("relation_type = 'feeds' and flow_coefficient <= 0")
    return violation(bad, "feeds_flow_coefficient_positive", _edge(), "a feeds coefficient must be positive", coefficient=F.col("flow_coefficient"))


def feeds_sum_to_one(relations: DataFrame) -> DataFrame:
    """Coefficients of all feeds edges of a parent, whatever their validity, must add up to 1."""
    total = relations.where("relation_type = 'feeds' and flow_coefficient is not null").groupBy("parent_meter_id").agg(F.sum("flow_coefficient").alias("k"))
    return violation(total.where(F.abs(F.col("k") - 1) > 1e-9), "feeds_flow_coefficients_sum_to_one", F.col("parent_meter_id"), "coefficients do not add up to 1", total=F.col("k"))


def sub_coefficient_range(relations: DataFrame) -> DataFrame:
    bad = relations.where("relation_type = 'hasSubMeter' and (flow_coefficient <= 0 or flow_coefficient > 1)")
    return violation(bad, "hassubmeter_flow_coefficient_out_of_range", _edge(), "a sub-meter's coefficient must be in (0, 1]", coefficient=F.col("flow_coefficient"))


def referential_integrity(t: dict[str, DataFrame]) -> DataFrame:
    """Every id that a table refers to exists. Media, devices and measured targets are checked only
    if their own table has rows; missing tables are not checked."""

    def missing(name: str, column: str, target: str, key: str, when: str = "true", if_any: bool = False) -> DataFrame | None:
        if name not in t or target not in t:
            return None
        rows = t[name].where(F.col(column).isNotNull() & (F.col(column) != "")).where(when).select(F.col(column).alias("id"))
        known = t[target].select(F.col(key).alias("id")).distinct()
        gone = rows.join(known, "id", "left_anti")
        if if_any:
            gone = gone.join(known.limit(1).select(F.lit(True).alias("_any")), F.lit(True), "left_semi")
        return violation(gone, "referential_integrity", F.concat_ws(" ", F.lit(f"{name}.{column}"), "id"), f"{column} is not in {target}", table=F.lit(name), column=F.lit(column), id=F.col("id"))

    checks = [
        missing("meters", "building_id", "buildings", "building_id"), missing("meters", "media_type_id", "media_types", "media_type_id", if_any=True),
        missing("buildings", "campus_id", "campuses", "campus_id"), missing("zones", "building_id", "buildings", "building_id"),
        missing("meter_relations", "parent_meter_id", "meters", "meter_id"), missing("meter_relations", "child_meter_id", "meters", "meter_id"),
        missing("meter_measures", "meter_id", "meters", "meter_id"),
        *(missing("meter_measures", "target_id", f"{k}s" if k != "campus" else "campuses", f"{k}_id", f"target_kind = '{k}'", if_any=True) for k in ("zone", "building", "campus")),
        missing("sensors", "meter_id", "meters", "meter_id"), missing("timeseries_refs", "sensor_id", "sensors", "sensor_id"),
        missing("timeseries_refs", "database_id", "databases", "database_id"), missing("timeseries_refs", "device_id", "devices", "device_id", if_any=True),
    ]
    return reduce(DataFrame.unionByName, (c for c in checks if c is not None))


def one_preferred_ref(refs: DataFrame) -> DataFrame:
    n = refs.groupBy("sensor_id").agg(F.count_if("preferred").alias("n")).where("n <> 1")
    return violation(n, "exactly_one_preferred_ref", F.col("sensor_id"), "a sensor needs exactly one preferred reference", n=F.col("n"))


def _overlapping(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Pairs (columns of the one first in `order`, valid_from_2, valid_to_2) of rows of one key whose
    windows overlap."""
    rows = df.withColumns({"lo": lower(F.col("valid_from")), "hi": upper(F.col("valid_to"))})
    pairs = overlapping_pairs(rows, keys)
    rank = lambda side: F.struct(*(F.col(f"{side}.{c}") for c in order))
    swapped = rank("one") > rank("two")
    first, second = (F.when(swapped, F.col(x)).otherwise(F.col(y)) for x, y in (("two", "one"), ("one", "two")))
    pairs = pairs.select(first.alias("first"), second.alias("second"))
    return pairs.select("first.*", F.col("second.valid_from").alias("valid_from_2"), F.col("second.valid_to").alias("valid_to_2")).drop("lo", "hi")


def validity_non_overlapping(relations: DataFrame) -> DataFrame:
    pairs = _overlapping(relations, ["parent_meter_id", "child_meter_id", "relation_type"], ["valid_from", "valid_to", "flow_coefficient"])
    return violation(pairs, "validity_non_overlapping", _edge(), "windows of one edge overlap", first=F.col("valid_from"), second=F.col("valid_from_2"))


def _empty(c: str) -> Column:
    return F.col(c).isNull() | (F.col(c) == "")


def ref_kind(refs: DataFrame) -> DataFrame:
    return violation(refs.where("kind is null or kind not in ('raw', 'derived')"), "ref_kind_invalid", F.col("timeseries_id"), "kind is neither raw nor derived", kind=F.col("kind"))


def raw_missing_address(refs: DataFrame) -> DataFrame:
    fields = F.array_join(F.array_compact(F.array(*(F.when(_empty(c), c) for c in ("database_id", "path", "external_id")))), ",")
    bad = refs.where("kind = 'raw'").withColumn("fields", fields).where("fields <> ''")
    return violation(bad, "ref_raw_missing_addressing", F.col("timeseries_id"), "a raw reference needs an address", fields=F.col("fields"))


def raw_has_derived_fields(refs: DataFrame) -> DataFrame:
    bad = refs.where((F.col("kind") == "raw") & ((F.size("sources") > 0) | ~_empty("aggregation")))
    return violation(bad, "ref_raw_has_derived_fields", F.col("timeseries_id"), "a raw reference has no sources or aggregation")


def derived_missing_declaration(refs: DataFrame) -> DataFrame:
    bad = refs.where((F.col("kind") == "derived") & ((F.coalesce(F.size("sources"), F.lit(0)) <= 0) | _empty("aggregation")))
    return violation(bad, "ref_derived_missing_declaration", F.col("timeseries_id"), "a derived reference needs sources and an aggregation")


def derived_has_address(refs: DataFrame) -> DataFrame:
    fields = F.array_compact(F.array(*(F.when(~_empty(c), c) for c in ("database_id", "path", "external_id"))))
    bad = refs.where("kind = 'derived'").select("timeseries_id", F.explode(fields).alias("field"))
    return violation(bad, "ref_derived_has_addressing", F.concat_ws(" ", "timeseries_id", "field"), "a derived reference has no address", field=F.col("field"))


def aggregation_vocabulary(refs: DataFrame) -> DataFrame:
    bad = refs.where(~_empty("aggregation") & ~F.col("aggregation").isin(*AGGREGATIONS))
    return violation(bad, "ref_aggregation_vocabulary", F.col("timeseries_id"), "unknown aggregation", aggregation=F.col("aggregation"))


def ref_sources(refs: DataFrame) -> DataFrame:
    """Sources that do not exist, and references that are their own source."""
    rows = refs.select("timeseries_id", F.explode("sources").alias("source"))
    own = rows.where("source = timeseries_id")
    gone = rows.where("source <> timeseries_id").join(refs.select(F.col("timeseries_id").alias("source")), "source", "left_anti")
    at = F.concat_ws(" ", "timeseries_id", "source")
    return violation(own, "ref_source_self", at, "a reference is its own source").unionByName(violation(gone, "ref_source_missing", at, "a source does not exist", source=F.col("source")))


def ref_validity_non_overlapping(refs: DataFrame) -> DataFrame:
    pairs = _overlapping(refs.where("kind = 'raw'"), ["sensor_id", "aggregate", "database_id", "path"], ["timeseries_id"])
    return violation(pairs, "ref_validity_non_overlapping", F.col("timeseries_id"), "windows of raw references of one sensor overlap", second=F.col("valid_from_2"))


def media_consistency(relations: DataFrame, meters: DataFrame) -> DataFrame:
    of = lambda end, name: meters.select(F.col("meter_id").alias(end), F.col("media_type_id").alias(name))
    bad = relations.join(of("parent_meter_id", "pm"), "parent_meter_id").join(of("child_meter_id", "cm"), "child_meter_id").where("pm <> cm")
    return violation(bad, "media_consistency", _edge(), "an edge joins two media", parent=F.col("pm"), child=F.col("cm"))


def orphan_meter(meters: DataFrame, relations: DataFrame) -> DataFrame:
    ends = relations.select(F.col("parent_meter_id").alias("meter_id")).union(relations.select("child_meter_id"))
    return violation(meters.join(ends, "meter_id", "left_anti"), "orphan_meter", F.col("meter_id"), "a meter without edges")


def validate(t: dict[str, DataFrame], orphans: bool = False) -> DataFrame:
    """All rules over a dataset; `orphans` adds the optional one."""
    e, r, m = t["meter_relations"], t["timeseries_refs"], t["meters"]
    on_edges = (no_cycles, feeds_requires_coefficient, feeds_coefficient_positive, feeds_sum_to_one, sub_coefficient_range, validity_non_overlapping)
    on_refs = (
        one_preferred_ref, ref_kind, raw_missing_address, raw_has_derived_fields, derived_missing_declaration, derived_has_address,
        aggregation_vocabulary, ref_sources, ref_validity_non_overlapping,
    )
    parts = [f(e) for f in on_edges] + [f(r) for f in on_refs] + [referential_integrity(t), media_consistency(e, m)]
    return reduce(DataFrame.unionByName, parts + ([orphan_meter(m, e)] if orphans else []))
