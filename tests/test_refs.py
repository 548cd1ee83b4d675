"""References from segments: their segments are computed once."""

from pyspark.sql import functions as F

from meterflow.operators import registers


def test_segments_are_computed_once(spark):
    day = F.lit(None).cast("date")
    segments = spark.range(3).select(F.when(F.col("id") < 2, "X1").otherwise("X2").alias("meter_id"), (F.col("id") % 2).cast("int").alias("position"), day.alias("valid_from"), day.alias("valid_to"))
    meters = spark.createDataFrame([("M1", "X1"), ("M2", "X2"), ("M3", "X3")], "facit_id string, meter_id string")
    refs = registers.refs_from_segments(meters, segments, "D0", "log")
    assert "Range" not in refs._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.timeseries_id, r.kind, r.preferred, tuple(r.sources)) for r in refs.collect()}
    assert got == {("M1:d.A", "raw", False, ()), ("M1:d.B", "raw", False, ()), ("M1:d", "derived", True, ("M1:d.A", "M1:d.B")), ("M2:d", "raw", True, ()), ("M3:d", "raw", True, ())}
