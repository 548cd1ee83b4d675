"""Scans in chunks, as-of merges and sweeps against plain loops."""

import datetime as dt
import random

from pyspark.sql import functions as F

from meterflow.operators import derived as d
from meterflow.operators import flow
from meterflow.plans.overlap import overlapping_pairs

READ = "timeseries_id string, timestamp timestamp, value double, recorded_at timestamp"
REF = "timeseries_id string, aggregation string, valid_from date, valid_to date, sources array<string>"


def series(rng, name, n, step=20):
    t, v, out = dt.datetime(2023, 1, 5), 0.0, []
    for _ in range(n):
        t += dt.timedelta(hours=rng.randint(1, step * 24))
        v += rng.randint(-3, 50)
        out.append((name, t, v, None))
    return out


def test_differences_cross_months(spark):
    """Months with one reading, without any, and corrections on either side of a month's end."""
    rng = random.Random(1)
    rows = [r for k in range(4) for r in series(rng, f"s{k}", 60)]
    fixed = [(s, t, v + 7, dt.datetime(2026, 1, 1)) for s, t, v, _ in rows if rng.random() < 0.3]
    final = {(s, t): v for s, t, v, _ in rows + fixed}
    want = {}
    for s in {k[0] for k in final}:
        times = sorted(t for x, t in final if x == s)
        want |= {(s, b): final[s, b] - final[s, a] for a, b in zip(times, times[1:])}
    refs = spark.createDataFrame([(f"s{k}", f"S{k}", "counter", True) for k in range(4)], "timeseries_id string, sensor_id string, reading_type string, preferred boolean")
    sensors = spark.createDataFrame([(f"S{k}", f"s{k}") for k in range(4)], "sensor_id string, meter_id string")
    got = flow.measured_flow(spark.createDataFrame(rows + fixed, READ), refs, sensors)
    assert {(r.meter_id, r.timestamp): r.delta for r in got.collect()} == want


def test_one_long_series_is_many_tasks(spark):
    start = dt.datetime(2000, 1, 1)
    rows = spark.range(24_000).select(F.lit("s").alias("timeseries_id"), (F.lit(start) + F.make_interval(hours=(F.col("id") * 9).cast("int"))).alias("timestamp"), (F.col("id") * 2.0).alias("value"), F.lit(None).cast("timestamp").alias("recorded_at"))
    refs = spark.createDataFrame([("s", "S", "counter", True)], "timeseries_id string, sensor_id string, reading_type string, preferred boolean")
    got = flow.measured_flow(rows, refs, spark.createDataFrame([("S", "m")], "sensor_id string, meter_id string"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.min("delta"), F.max("delta")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(r.n for r in parts) == 23_999 and all(r[2] == r[3] == 2.0 for r in parts)
    assert len(parts) > 2 and max(r.n for r in parts) < 12_000


def test_running_sums_cross_months(spark):
    rng = random.Random(2)
    a, b = series(rng, "a", 50), series(rng, "b", 50)
    refs = spark.createDataFrame([("both", "sum", None, None, ["a", "b"])], REF)
    got = {r.timestamp: r.value for r in d.sums(refs, spark.createDataFrame(a + b, READ)).collect()}
    steps = {}
    for rows in (a, b):
        for p, q in zip(rows, rows[1:]):
            steps[q[1]] = steps.get(q[1], 0) + max(q[2] - p[2], 0)
    total, want = 0.0, {}
    for t in sorted(steps):
        total += steps[t]
        want[t] = total
    assert got == want


def test_endpoints_of_many_windows(spark):
    rng = random.Random(3)
    rows = series(rng, "s", 300, 3) + series(rng, "t", 3, 3) + [("s", dt.datetime(2023, 3, 1), 5.0, None)]
    day = lambda: dt.date(2023, 1, 1) + dt.timedelta(rng.randint(0, 500))
    refs = [(f"r{k}", "bracket", day() if rng.random() < 0.95 else None, day() if rng.random() < 0.95 else None, [rng.choice("stu")]) for k in range(200)] + [("x", "bracket", dt.date(2023, 3, 1), dt.date(2023, 3, 1), ["s"])]
    got = {r.timeseries_id: ((r.t_lo, r.v_lo), (r.t_hi, r.v_hi)) for r in d.endpoints(spark.createDataFrame(refs, REF), spark.createDataFrame(rows, READ), "bracket").collect()}
    at = lambda x: dt.datetime.combine(x, dt.time())
    for name, _, lo, hi, (source,) in refs:
        of = [(t, v) for s, t, v, _ in rows if s == source]
        before = max((x for x in of if lo and x[0] < at(lo)), default=(None, None))
        after = min((x for x in of if hi and x[0] >= at(hi)), default=(None, None))
        assert got[name] == (before, after), name


def test_overlaps(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), k, lo := rng.randint(0, 60), lo + rng.randint(-2, 9)) for k in range(150)]
    got = overlapping_pairs(spark.createDataFrame(rows, "g string, id int, lo int, hi int"), ["g"]).collect()
    pairs = sorted(tuple(sorted((r.one.id, r.two.id))) for r in got)
    want = sorted((p[1], q[1]) for i, p in enumerate(rows) for q in rows[i + 1 :] if p[0] == q[0] and p[2] < q[3] and q[2] < p[3])
    assert pairs == want


def test_many_disjoint_windows_make_no_pairs(spark):
    rows = spark.range(20_000).selectExpr("'k' as g", "id", "id * 10 as lo", "id * 10 + 10 as hi")
    assert overlapping_pairs(rows, ["g"]).isEmpty()


def test_levels(spark):
    refs = spark.createDataFrame([("a", "sum", None, None, ["raw"]), ("b", "sum", None, None, ["a", "raw"]), ("c", "slice", None, None, ["b"]), ("x", "sum", None, None, ["y"]), ("y", "sum", None, None, ["x"]), ("z", "sum", None, None, ["y", "a"])], REF)
    assert {r.timeseries_id: r.level for r in d.dependency_levels(refs).collect()} == {"a": 0, "b": 1, "c": 2, "x": None, "y": None, "z": None}
    rows = spark.createDataFrame([("raw", dt.datetime(2024, 1, k), float(k * k), None) for k in range(1, 5)], READ)
    made = d.materialize(refs, rows, by_dependency=True)
    assert {(r.timeseries_id, r.timestamp.day): r.value for r in made.collect()} == {("a", 2): 3, ("a", 3): 8, ("a", 4): 15, ("b", 2): 3, ("b", 3): 8 + 5, ("b", 4): 15 + 12, ("c", 2): 3, ("c", 3): 13, ("c", 4): 27}
    found = {(r.timeseries_id, r.issue) for r in d.issues(refs, rows, by_dependency=True).collect()}
    assert found == {(k, "cycle of sources") for k in "xyz"}
