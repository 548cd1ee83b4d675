"""Looking up the validity interval of readings, against a search row by row."""

from bisect import bisect_right
from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from meterflow.plans.intervals import BLOCK, located


def test_located_takes_the_last_breakpoint(spark):
    """Keys without, with one, with a block of and with many breakpoints; times before, on and after them; nulls."""
    day = date(2020, 1, 1)
    days = {"none": [], "one": [day], "block": [day + timedelta(2 * i) for i in range(BLOCK)], "many": [day + timedelta(2 * i) for i in range(5 * BLOCK + 3)]}
    marks = [(k, d) for k, ds in days.items() for d in reversed(ds)] + [("one", day)]
    times = [datetime(2019, 12, 30) + timedelta(hours=12 * i) for i in range(1400)]
    rows = spark.createDataFrame([(k, t) for k in days for t in times] + [("one", None), (None, times[9])], "meter_id string, timestamp timestamp")
    got = located(rows, spark.createDataFrame(marks, "meter_id string, since date")).withColumn("timestamp", F.col("timestamp").cast("string"))
    found = {(r.meter_id, r.timestamp): r.since for r in got.collect()}
    assert found.pop(("one", None)) is None and found.pop((None, str(times[9]))) is None
    want = {}
    for k, ds in days.items():
        for t in times:
            at = bisect_right(ds, t.date())
            want[k, str(t)] = ds[at - 1] if at else None
    assert found == want and got.columns == ["meter_id", "timestamp", "since"]


def test_located_does_not_gather_rows_by_key(spark):
    """A meter with all rows is no hot key: rows are joined, not sorted in a window."""
    rows = spark.range(10).select(F.lit("m").alias("meter_id"), F.timestamp_seconds("id").alias("timestamp"))
    marks = spark.createDataFrame([("m", date(1960, 1, 1))], "meter_id string, since date")
    plan = located(rows, marks)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
