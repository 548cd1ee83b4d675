"""Targets of annotations: what they give for repeated and missing rows, without the product of places and meters."""

from pyspark.sql import functions as F

from meterflow.operators import annotations as an

A = "annotation_id string, target_kind string, target_id string, category string, valid_from date, valid_to date, is_resolved boolean"


def site(spark, a):
    m = [("m1", "b1"), ("m1", "b1"), ("m2", "b1"), ("m3", "b2"), ("m4", None), ("m5", "b3")]
    return (
        spark.createDataFrame([(i, k, t, "swap", None, None, False) for i, k, t in a], A), spark.createDataFrame(m, "meter_id string, building_id string"),
        spark.createDataFrame([("b1", "c1"), ("b2", "c1"), ("b2", "c2"), ("b9", "c1")], "building_id string, campus_id string"),
        spark.createDataFrame([("s1", "m1"), ("s4", "m4"), ("s9", "m9")], "sensor_id string, meter_id string"),
        spark.createDataFrame([("t1", "s1"), ("t4", "s4"), ("t9", "s9")], "timeseries_id string, sensor_id string"),
    )


ROWS = [
    ("A", "meter", "m1"), ("A", "building", "b1"), ("B", "campus", "c1"), ("B", "campus", "c2"), ("B", "timeseries", "t4"), ("C", "building", "b8"), ("C", "meter", "m9"),
    ("D", "timeseries", "t1"), ("D", "timeseries", "t1"), ("D", "meter", "m1"), ("E", "timeseries", "t9"), (None, "meter", "m3"), (None, "building", "b2"), ("F", "building", None),
]


def test_targets_are_distinct(spark):
    got = sorted((tuple(r) for r in an.resolve_targets(*site(spark, ROWS)).collect()), key=str)
    want = [("A", "m1", "b1"), ("A", "m2", "b1"), ("B", "m1", "b1"), ("B", "m2", "b1"), ("B", "m3", "b2"), ("B", None, "b9"), ("B", "m4", None)]
    want += [("C", None, "b8"), ("D", "m1", "b1"), (None, "m3", "b2"), ("F", None, None)]
    assert got == sorted(want, key=str)


def test_view_of_selected_meters(spark):
    tables = site(spark, ROWS)
    view = lambda *ids: sorted({r.annotation_id or "" for r in an.annotations_view(*tables, spark.createDataFrame([(i,) for i in ids], "meter_id string"), "2024-01-01", "2024-01-09").collect()})
    assert [view("m1"), view("m2"), view("m3"), view("m4"), view("m5"), view("m9")] == [["A", "B", "D"], ["A", "B"], ["B"], ["B"], [], []]


def many(spark, meters, annotations):
    m = spark.range(meters).select(F.concat(F.lit("m"), "id").alias("meter_id"), F.lit("b1").alias("building_id"))
    none = F.lit(None).cast("date")
    a = spark.range(annotations).select(
        F.concat(F.lit("A"), "id").alias("annotation_id"), F.lit("building").alias("target_kind"), F.lit("b1").alias("target_id"), F.lit("swap").alias("category"), none.alias("valid_from"), none.alias("valid_to"),
    )
    return [a, m, *site(spark, [])[2:]]


def test_many_annotations_of_one_building(spark):
    """5,000 meters and 400 annotations: all pairs, in several tasks, without an aggregation over them."""
    rows = an.resolve_targets(*many(spark, 5000, 400))
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r[1] for r in per_task) == 2_000_000 and len(per_task) > 1
    assert not rows._jdf.queryExecution().optimizedPlan().toString().startswith("Aggregate")


def test_view_without_the_pairs(spark):
    """200,000 annotations of a building with 200,000 meters: as many rows, not their product."""
    tables = many(spark, 200_000, 200_000)
    assert an.annotations_view(*tables, tables[1], "2024-01-01", "2024-01-09").count() == 200_000
