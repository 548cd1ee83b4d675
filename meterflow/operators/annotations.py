"""Annotations on meters and places (Q16-Q18)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: meters of a building that meet an annotation at a time
BLOCK = 1024


def resolve_targets(annotations: DataFrame, meters: DataFrame, buildings: DataFrame, sensors: DataFrame, refs: DataFrame) -> DataFrame:
    """(annotation_id, meter_id, building_id): the meters, with their buildings, that an annotation on
    a meter, building, campus or series is about; a building or campus without meters gives its
    buildings with a null meter.

    Rows are as many as annotations of a place times its meters, so they are made distinct before they
    are made: pairs of annotation and building are, and meters are, and both meet in blocks of meters.
    """
    a = annotations.select("annotation_id", "target_kind", "target_id")
    of = lambda kind, key: a.where(F.col("target_kind") == kind).select("annotation_id", F.col("target_id").alias(key))
    m = meters.select("meter_id", "building_id").distinct()
    places = of("building", "building_id").unionByName(of("campus", "campus_id").join(buildings.select("campus_id", "building_id"), "campus_id").drop("campus_id"))
    places = places.distinct()
    sizes = m.where("building_id is not null").groupBy("building_id").agg(F.ceil(F.count("*") / BLOCK).alias("n"))
    block = F.pmod(F.xxhash64("meter_id"), "n").alias("block")
    blocks = m.join(sizes, "building_id").groupBy("building_id", block).agg(F.collect_list("meter_id").alias("ids"))
    at = places.join(sizes, "building_id", "left").select("annotation_id", "building_id", F.explode_outer(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("block"))
    # a fixed number of tasks: these rows are few, but not what becomes of them
    at = at.repartition(int(a.sparkSession.conf.get("spark.sql.shuffle.partitions")), "building_id", "block")
    at = at.join(blocks, ["building_id", "block"], "left").where("block is null or ids is not null")
    by_place = at.select("annotation_id", F.explode_outer("ids").alias("meter_id"), "building_id")
    series = refs.select("timeseries_id", "sensor_id").join(sensors.select("sensor_id", "meter_id"), "sensor_id").select("timeseries_id", "meter_id")
    direct = of("meter", "meter_id").unionByName(of("timeseries", "timeseries_id").join(series, "timeseries_id").drop("timeseries_id"))
    direct = direct.join(m, "meter_id").select("annotation_id", "meter_id", "building_id").distinct()
    # what an annotation's place gives already
    p = places.select(F.col("annotation_id").alias("_a"), F.col("building_id").alias("_b"))
    direct = direct.join(p, F.col("annotation_id").eqNullSafe(F.col("_a")) & (F.col("building_id") == F.col("_b")), "left_anti")
    return by_place.unionByName(direct)


def annotations_view(
    annotations: DataFrame, meters: DataFrame, buildings: DataFrame, sensors: DataFrame, refs: DataFrame, selected: DataFrame, start: str, end: str, resolved: bool | None = None
) -> DataFrame:
    """(annotation_id, category, starts, ends): annotations about the selected meters (meter_id) that
    overlap [start, end], clipped to it; open ends reach to it, and what begins and ends on one day
    or the next is shown at least a day long. `resolved` keeps one status. An annotation is about
    selected meters if its target is one of theirs, so targets are collected instead of meters."""
    a = annotations if resolved is None else annotations.where(F.col("is_resolved") == resolved)
    m = meters.select("meter_id", "building_id").join(selected.select("meter_id"), "meter_id", "left_semi")
    b = m.select("building_id").distinct()
    targets = {
        "meter": m.select("meter_id"),
        "building": b,
        "campus": buildings.join(b, "building_id", "left_semi").select("campus_id"),
        "timeseries": refs.join(sensors.join(m, "meter_id", "left_semi"), "sensor_id", "left_semi").select("timeseries_id"),
    }
    of = [t.toDF("target_id").distinct().withColumn("target_kind", F.lit(kind)) for kind, t in targets.items()]
    about = a.join(reduce(DataFrame.unionByName, of), ["target_kind", "target_id"], "left_semi").select("annotation_id").distinct()
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    starts, ends = F.coalesce("valid_from", lo), F.coalesce("valid_to", hi)
    rows = a.join(about, "annotation_id", "left_semi").withColumn("s", starts).withColumn("e", F.greatest(ends, F.date_add(starts, 1)))
    return rows.where((F.col("s") <= hi) & (F.col("e") >= lo)).select("annotation_id", "category", F.greatest("s", lo).alias("starts"), F.least("e", hi).alias("ends"))


def validity_gaps(meters: DataFrame, start: str, end: str) -> DataFrame:
    """(meter_id, band, starts, ends): the parts of [start, end) before a meter is online and after it is retired."""
    lo, hi = F.lit(start).cast("date"), F.lit(end).cast("date")
    early = meters.where(F.col("valid_from") > lo).select("meter_id", F.lit("not_yet_online").alias("band"), lo.alias("starts"), F.least("valid_from", hi).alias("ends"))
    late = meters.where(F.col("valid_to") < hi).select("meter_id", F.lit("retired").alias("band"), F.greatest("valid_to", lo).alias("starts"), hi.alias("ends"))
    return early.unionByName(late)
