"""Months as units of change: pruned reads, replaced months, and refreshed results against the batch."""

import datetime as dt
import random
from pathlib import Path

from meterflow.operators import flow
from meterflow.operators.rollup import attributed, consumption
from meterflow.sources.store import put_months, read_months
from meterflow.streaming.refresh import READINGS, net_table, places_table, refresh, refresh_stream

EDGE = "parent_meter_id string, child_meter_id string, relation_type string, flow_coefficient double, valid_from date, valid_to date"


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def readings(rng, months=6):
    out = []
    for m in "ABC":
        t, v = dt.datetime(2023, 11, 20), 0.0
        while t < dt.datetime(2023, 11, 20) + dt.timedelta(days=30 * months):
            if not (m == "C" and dt.datetime(2024, 1, 1) <= t < dt.datetime(2024, 2, 1)):  # C has no January
                out.append((f"T{m}", t, v, None))
            t, v = t + dt.timedelta(days=1), v + rng.randint(0, 9)
    return out


def site(spark):
    day = ("cast(null as date) as valid_from", "cast(null as date) as valid_to")
    return {
        "refs": spark.createDataFrame([(f"T{m}", f"S{m}", "counter", True) for m in "ABC"], "timeseries_id string, sensor_id string, reading_type string, preferred boolean"),
        "sensors": spark.createDataFrame([(f"S{m}", m) for m in "ABC"], "sensor_id string, meter_id string"),
        "relations": spark.createDataFrame([("A", "B", "hasSubMeter", None, None, dt.date(2024, 3, 5)), ("C", "V", "feeds", 0.5, None, None)], EDGE),
        "measures": spark.createDataFrame([("A", "building", "H"), ("B", "zone", "Z"), ("V", "campus", "K")], "meter_id string, target_kind string, target_id string").selectExpr("*", *day),
        "zones": spark.createDataFrame([("Z", "H")], "zone_id string, building_id string"),
        "buildings": spark.createDataFrame([("H", "K")], "building_id string, campus_id string"),
    }


def rows(df):
    return sorted((*(tuple(r)[:-1]), round(r[-1], 6)) for r in df.collect())


def whole(spark, all_rows, s):
    r = spark.createDataFrame(all_rows, READINGS)
    net = flow.meter_net(flow.meter_flow(flow.measured_flow(r, s["refs"], s["sensors"]), s["relations"]), s["relations"])
    return rows(net), rows(consumption(attributed(net, s["measures"], s["zones"], s["buildings"])))


def test_late_corrections_change_their_months_only(spark, tmp_path):
    s, first = site(spark), readings(random.Random(1))
    folder = f"{tmp_path}/kept"
    got = refresh(spark.createDataFrame(first, READINGS), f"file://{folder}", s)
    assert len(got) == len({t.strftime("%Y-%m") for _, t, _, _ in first})
    assert (rows(net_table(spark, f"file://{folder}")), rows(places_table(spark, f"file://{folder}"))) == whole(spark, first, s)
    before = files(folder)
    # the last reading of C's December, on which its first one in February depends, and one within March
    late = [("TC", dt.datetime(2023, 12, 31), 77.0, dt.datetime(2025, 1, 1)), ("TA", dt.datetime(2024, 3, 10), 5.0, dt.datetime(2025, 1, 1))]
    assert refresh(spark.createDataFrame(late, READINGS), f"file://{folder}", s) == ["2023-12", "2024-02", "2024-03", "2024-04"]
    assert (rows(net_table(spark, f"file://{folder}")), rows(places_table(spark, f"file://{folder}"))) == whole(spark, first + late, s)
    after = files(folder)
    kept = [p for p in before if any(f"month={m}" in p for m in ("2023-11", "2024-01", "2024-05"))]
    assert kept and all(before[p] == after.get(p) for p in kept)
    refresh(spark.createDataFrame(late, READINGS), f"file://{folder}", s)  # again, as after a failure
    assert rows(net_table(spark, f"file://{folder}")) == whole(spark, first + late, s)[0]
    assert refresh(spark.createDataFrame([], READINGS), f"file://{folder}", s) == []


def test_stream_with_late_rows(spark, tmp_path):
    """Files in any order of time, rows far behind any watermark."""
    rng = random.Random(2)
    s, all_rows = site(spark), readings(rng, 3)
    all_rows += [(n, t, v + 3, dt.datetime(2025, 1, 1)) for n, t, v, _ in all_rows if rng.random() < 0.1]
    rng.shuffle(all_rows)
    for k in range(3):
        spark.createDataFrame(all_rows[k::3], READINGS).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/inbox")
    stream = spark.readStream.schema(READINGS).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/inbox")
    refresh_stream(stream, f"file://{tmp_path}/kept", s, f"file://{tmp_path}/log").awaitTermination()
    assert (rows(net_table(spark, f"file://{tmp_path}/kept")), rows(places_table(spark, f"file://{tmp_path}/kept"))) == whole(spark, all_rows, s)


def test_reads_are_pruned(spark, tmp_path):
    path = f"file://{tmp_path}/months"
    put_months(spark.createDataFrame(readings(random.Random(3)), READINGS), path)
    some = read_months(spark, path, READINGS, "2024-01-05", "2024-02-03")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "2024-01-01" in plan and "PushedFilters" in plan
    read = {Path(f).parent.name for f in some.inputFiles()}
    assert some.count() == 29 * 2 + 2 and len(read) >= 2
