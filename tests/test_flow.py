"""Flow and net on a site small enough to compute by hand, and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from meterflow.operators import flow as op

EDGE = "parent_meter_id string, child_meter_id string, relation_type string, flow_coefficient double, valid_from date, valid_to date, derived_from string"
T2 = dt.date(2024, 1, 3)
EDGES = [
    ("I1", "POOL", "feeds", 1.0, None, None), ("I2", "POOL", "feeds", 1.0, None, None), ("POOL", "M0", "hasSubMeter", None, None, None), ("M0", "A", "hasSubMeter", None, None, None),
    ("A", "V1", "feeds", 0.7, None, None), ("A", "V2", "feeds", 0.3, None, None), ("F1", "F2", "hasSubMeter", 1.0, None, T2), ("F2", "F1", "hasSubMeter", 1.0, T2, None),
]
COUNTERS = {"I1": (0, 60, 120), "I2": (0, 40, 80), "M0": (0, 100, 190), "A": (0, 50, 100), "F1": (0, 21, 33), "F2": (0, 9, 30)}
WANT = {
    "I1": (60, 0, 60, 0), "I2": (40, 0, 40, 0), "POOL": (100, 0, 100, 10), "M0": (100, 50, 90, 40), "A": (50, 0, 50, 0), "V1": (35, 35, 35, 35), "V2": (15, 15, 15, 15), "F1": (21, 12, 12, 12), "F2": (9, 9, 21, 9),
}


def site(spark):
    day = lambda t: dt.datetime(2024, 1, 1 + t)
    readings = [(m, day(t), float(v), None) for m, vs in COUNTERS.items() for t, v in enumerate(vs)]
    readings.append(("A", day(1), 999.0, None))  # a first value, corrected later
    readings = [r if r[:2] != ("A", day(1)) or r[2] == 999.0 else (*r[:3], dt.datetime(2024, 2, 1)) for r in readings]
    r = spark.createDataFrame(readings, "timeseries_id string, timestamp timestamp, value double, recorded_at timestamp")
    refs = spark.createDataFrame([(m, f"S{m}", "daily", "counter", True) for m in COUNTERS], "timeseries_id string, sensor_id string, aggregate string, reading_type string, preferred boolean")
    sensors = spark.createDataFrame([(f"S{m}", m) for m in COUNTERS], "sensor_id string, meter_id string")
    return r, refs, sensors, spark.createDataFrame([(*e, "t") for e in EDGES], EDGE)


def test_mini_site(spark):
    readings, refs, sensors, edges = site(spark)
    flow = op.meter_flow(op.measured_flow(readings, refs, sensors), edges)
    net = {(r.meter_id, r.timestamp.day): r.net for r in op.meter_net(flow, edges).collect()}
    flows = {(r.meter_id, r.timestamp.day): r.delta for r in flow.collect()}
    for m, (f1, n1, f2, n2) in WANT.items():
        assert (round(flows[m, 2], 9), round(net[m, 2], 9), round(flows[m, 3], 9), round(net[m, 3], 9)) == (f1, n1, f2, n2)
    # what flows in is used somewhere
    for day in (2, 3):
        assert round(sum(v for (m, d), v in net.items() if d == day and m[0] not in "F"), 9) == 100


def test_without_corrections_and_edges(spark):
    readings, refs, sensors, edges = site(spark)
    raw = op.measured_flow(readings.where("recorded_at is null"), refs, sensors, corrected=False)
    assert {r.delta for r in raw.where("meter_id = 'A'").collect()} == {999.0, -899.0}
    flow = op.meter_flow(raw, edges.limit(0))
    assert flow.count() == raw.count()
    assert op.meter_net(flow, edges.limit(0)).where("net is null").count() == 0
    assert op.measured_flow(readings.limit(0), refs, sensors).count() == 0


def test_diamond_subtracts_per_delivery(spark):
    edges = spark.createDataFrame(
        [("A", "C", "feeds", 1.0), ("B", "C", "feeds", 1.0), ("C", "S", "hasSubMeter", 1.0), ("C", "D", "feeds", 0.5)], "parent_meter_id string, child_meter_id string, relation_type string, flow_coefficient double"
    ).selectExpr("*", "cast(null as date) as valid_from", "cast(null as date) as valid_to")
    t = dt.datetime(2024, 1, 1)
    measured = spark.createDataFrame([("A", t, 10.0), ("B", t, 20.0), ("S", t, 4.0)], "meter_id string, timestamp timestamp, delta double")
    got = {r.meter_id: r.delta for r in op.meter_flow(measured, edges).collect()}
    assert got == {"A": 10, "B": 20, "S": 4, "C": 30, "D": 0.5 * (6 + 16)}


def test_closure_follows_windows_and_refuses_cycles(spark):
    import pytest

    _, _, _, edges = site(spark)
    got = {(r.ancestor, r.meter_id) for r in op.closure(edges).collect()}
    assert ("I1", "V1") in got and ("F1", "F2") in got and ("F2", "F1") in got and ("V1", "A") not in got
    loop = spark.createDataFrame([("A", "B", "feeds", 1.0, None, None, ""), ("B", "A", "feeds", 1.0, None, None, "")], EDGE)
    with pytest.raises(ValueError):
        op.closure(loop)


def test_long_deliveries_are_cut_or_refused(spark):
    import pytest

    chain = spark.createDataFrame([(f"N{i}", f"N{i + 1}", "feeds", 0.5, None, None, "t") for i in range(4)], EDGE)
    flow = spark.createDataFrame([("N0", dt.datetime(2024, 1, 1), 16.0)], "meter_id string, timestamp timestamp, delta double")
    got = {r.meter_id: r.delta for r in op.meter_flow(flow, chain, max_hops=3).collect()}
    assert got == {"N0": 16.0, "N1": 8.0, "N2": 4.0, "N3": 2.0}
    assert op.meter_flow(flow, chain, max_hops=4, strict=True).count() == 5
    with pytest.raises(ValueError):
        op.meter_flow(flow, chain, max_hops=3, strict=True)


def test_diamonds_in_a_row_are_counted_not_listed(spark):
    """40 diamonds: 2^40 paths from end to end, a row for each pair of meters."""
    edges = [e for i in range(40) for e in ((f"N{i}", f"N{i}a"), (f"N{i}", f"N{i}b"), (f"N{i}a", f"N{i + 1}"), (f"N{i}b", f"N{i + 1}"))]
    graph = spark.createDataFrame([(*e, "hasSubMeter", 1.0, None, None, "t") for e in edges], EDGE)
    paths = op.closure(graph)
    assert paths.where("ancestor = 'N0' and meter_id = 'N40'").first().paths == 2.0**40
    assert paths.count() == len(paths.select("ancestor", "meter_id").distinct().collect())
    t = dt.datetime(2024, 1, 1)
    own = spark.createDataFrame([("N40", t, 1.0), ("alone", t, 5.0)], "meter_id string, timestamp timestamp, delta double")
    got = {r.meter_id: r.delta for r in op.subtree_rollup(own, graph).collect()}
    assert got["N0"] == 2.0**40 and got["N40"] == 1.0 and got["alone"] == 5.0 and len(got) == 122


def test_feeds_diamonds_with_windows(spark):
    """Deliveries over diamonds whose sides hold at different times, against a plain recursion."""
    import random

    rng = random.Random(4)
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(k)
    edges = []
    for i in range(5):
        for a, b in ((f"N{i}", f"N{i}a"), (f"N{i}", f"N{i}b"), (f"N{i}a", f"N{i + 1}"), (f"N{i}b", f"N{i + 1}"), (f"N{i}", f"N{i + 1}")):
            edges.append((a, b, "feeds", rng.choice([0.5, 0.25, 1.0]), rng.choice([None, day(2)]), rng.choice([None, day(6)]), "t"))
        edges.append((f"N{i}", f"S{i}", "hasSubMeter", None, None, day(4 + i), "t"))
    times = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=7 * k) for k in range(24)]
    measured = [(m, t, float(rng.randint(1, 9))) for m in ["N0", "N2", *(f"S{i}" for i in range(5))] for t in times if rng.random() < 0.9]

    def flow_at(t):
        on = lambda e: (e[4] is None or dt.datetime.combine(e[4], dt.time()) <= t) and (e[5] is None or dt.datetime.combine(e[5], dt.time()) > t)
        here = {m: v for m, s, v in measured if s == t}
        subs = {}
        for e in edges:
            if e[2] == "hasSubMeter" and on(e) and e[1] in here:
                subs[e[0]] = subs.get(e[0], 0) + here[e[1]]
        rows, out = list(here.items()), dict(here)
        for _ in range(10):
            rows = [(e[1], e[3] * (v - subs.get(m, 0))) for m, v in rows for e in edges if e[0] == m and e[2] == "feeds" and on(e)]
            for m, v in rows:
                out[m] = out.get(m, 0) + v
        return out

    got = op.meter_flow(spark.createDataFrame(measured, "meter_id string, timestamp timestamp, delta double"), spark.createDataFrame(edges, EDGE)).collect()
    assert {(r.meter_id, r.timestamp): round(r.delta, 6) for r in got} == {(m, t): round(v, 6) for t in times for m, v in flow_at(t).items()}


def test_net_plan_joins_readings_by_key_only(spark):
    readings, refs, sensors, edges = site(spark)
    net = op.meter_net(op.meter_flow(op.measured_flow(readings, refs, sensors), edges), edges)
    plan = net._jdf.queryExecution().optimizedPlan().toString()
    joins = [x for x in plan.splitlines() if "Join" in x and "since" in x and "meter_id" in x]
    assert joins and not any("timestamp" in x and ("<" in x or ">" in x) for x in joins)


def test_lost_child_flow(spark):
    readings, refs, sensors, edges = site(spark)
    measured = op.measured_flow(readings, refs, sensors)
    flow = op.meter_flow(measured, edges)
    assert op.lost_child_flow(flow, edges).isEmpty()
    sparse = flow.where("not (meter_id = 'M0' and day(timestamp) = 3)")
    assert [tuple(r) for r in op.lost_child_flow(sparse, edges).collect()] == [("M0", dt.date(2024, 1, 1), 50.0, 1)]
    # net and lost flow together are what was there
    total = lambda df, c: df.agg({c: "sum"}).first()[0]
    lost = total(op.lost_child_flow(sparse, edges), "lost")
    subs = total(op.sub_total(edges, sparse), "total")
    fed = op.meter_net(sparse, edges.where("relation_type = 'hasSubMeter'"))
    assert round(total(fed, "net") + subs - lost, 9) == round(total(sparse, "delta"), 9)


def planned(df):
    """The plan without changes while it runs."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        df.sparkSession.conf.unset("spark.sql.adaptive.enabled")


def many_readings(spark, n=3_000_000):
    time = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60)
    return spark.range(n).select(F.concat(F.lit("T"), F.col("id") % 1000).alias("timeseries_id"), time.alias("timestamp"), F.col("id").cast("double").alias("value"), F.lit(None).cast("timestamp").alias("recorded_at"))


def test_readings_are_dealt_out_once(spark):
    """Counters that come from a large table do not shuffle the readings; windows and lasts share a shuffle."""
    ids = spark.range(1_000).union(spark.range(1_000)).distinct()
    refs = ids.select(F.concat(F.lit("T"), "id").alias("timeseries_id"), F.concat(F.lit("S"), "id").alias("sensor_id"), F.lit("counter").alias("reading_type"), F.lit(True).alias("preferred"))
    sensors = ids.select(F.concat(F.lit("S"), "id").alias("sensor_id"), F.concat(F.lit("M"), "id").alias("meter_id"))
    plan = planned(op.measured_flow(many_readings(spark), refs, sensors))
    assert "ReusedExchange" in plan and "BroadcastHashJoin" in plan
    # one with the readings, and those of the last reading per series and month
    assert len([x for x in plan.splitlines() if "Exchange hashpartitioning(timeseries_id" in x and "Reused" not in x]) == 3


def test_located_readings_meet_edges_where_they_are(spark):
    _, _, _, edges = site(spark)
    measured = many_readings(spark, 200_000).select(F.element_at(F.array(*map(F.lit, COUNTERS)), (F.col("value") % 6 + 1).cast("int")).alias("meter_id"), "timestamp", F.rand(1).alias("delta"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")  # less than the readings have
    try:
        plan = planned(op.meter_flow(measured, edges))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "since" in x]


def test_counters_of_suppliers_take_one_shuffle(spark, tmp_path):
    """What a supplier shipped is added up and summed over time in one deal of the lines."""
    from meterflow.fixtures import Site

    day = lambda k: dt.datetime(2024, 1, 1 + k)
    lines = [(k, float(q), day(q % 3)) for k in (1, 2) for q in range(1, 7)]
    spark.createDataFrame(lines, "l_suppkey bigint, l_quantity double, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = Site(spark, str(tmp_path)).line_readings
    assert planned(got).count("Exchange hashpartitioning") == 1
    assert {(r.timeseries_id, r.timestamp.day): r.value for r in got.collect()} == {(f"L{k}", d): v for k in (1, 2) for d, v in ((1, 9.0), (2, 14.0), (3, 21.0))}


def test_net_adds_up_by_hash(spark):
    """No sort of all rows; a flow of null stays a row, and so does one without sub-meters or feeds."""
    _, _, _, edges = site(spark)
    t = dt.datetime(2024, 1, 2)
    flow = spark.createDataFrame([("A", t, 50.0), ("M0", t, None), ("F1", t, 21.0), ("F2", t, 9.0), ("alone", t, 5.0), ("V1", t, 35.0)], "meter_id string, timestamp timestamp, delta double")
    net = op.meter_net(flow, edges)
    assert "SortAggregate" not in planned(net)
    assert {r.meter_id: r.net for r in net.collect()} == {"A": 0.0, "M0": None, "F1": 12.0, "F2": 9.0, "alone": 5.0, "V1": 35.0}
