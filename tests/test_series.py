"""Derived series and register events: hand cases, and the sequential forms on random input."""

import datetime as dt
import random

from meterflow.operators import derived as d
from meterflow.operators import registers as e

READ = "timeseries_id string, timestamp timestamp, value double, recorded_at timestamp"
REF = "timeseries_id string, aggregation string, valid_from date, valid_to date, sources array<string>"
DAILY = "meter_id string, day date, v_first double, v_last double, n_readings long"


def at(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n - 1)


def readings(spark, series):
    return spark.createDataFrame([(s, at(n), float(v), None) for s, rows in series.items() for n, v in rows], READ)


def values(df, series):
    return [(r.timestamp.day, r.value) for r in df.where(f"timeseries_id = '{series}'").orderBy("timestamp").collect()]


def test_rolling_sum_boundaries(spark):
    cases = {
        "swap": ([(1, 100), (2, 110)], [(3, 7), (4, 17)], [100, 110, 110, 120]), "roll": ([(1, 9_990_000)], [(2, 200)], [9_990_000, 10_000_200]),
        "reset": ([(1, 150_000)], [(2, 300)], [150_000, 150_300]), "cont": ([(1, 1000)], [(2, 1005)], [1000, 1005]),
    }
    r = readings(spark, {f"{k}.{s}": rows for k, (a, b, _) in cases.items() for s, rows in (("A", a), ("B", b))})
    refs = spark.createDataFrame([(k, "rolling_sum", None, None, [f"{k}.A", f"{k}.B"]) for k in cases], REF)
    out = d.materialize(refs, r)
    for k, (_, _, want) in cases.items():
        assert [v for _, v in values(out, k)] == want


def test_bracket_interpolate_sum_slice(spark):
    day = lambda n: at(n).date()
    r = readings(spark, {"s": [(1, 100), (2, 805175), (3, 120), (4, 0.2), (5, 140)], "l": [(1, 100), (5, 140)], "c1": [(1, 0), (2, 5), (3, 9)], "c2": [(1, 10), (2, 8), (3, 12)], "w": [(1, 1), (2, 2), (3, 3), (4, 4)]})
    refs = spark.createDataFrame(
        [("b", "bracket", day(2), day(5), ["s"]), ("i", "interpolate", day(2), day(5), ["l"]), ("u", "sum", day(2), None, ["c1", "c2"]), ("x", "slice", day(2), day(4), ["w"]),
         ("lost", "bracket", day(1), day(5), ["s"]), ("two", "slice", None, None, ["s", "w"]), ("open", "interpolate", day(2), None, ["l"])], REF,
    )
    out = d.materialize(refs, r)
    assert values(out, "b") == [(3, 120)] and values(out, "i") == [(2, 110), (3, 120), (4, 130)]
    assert values(out, "u") == [(2, 5), (3, 13)] and values(out, "x") == [(2, 2), (3, 3)] and values(out, "lost") == []
    assert {(x.timeseries_id, x.issue) for x in d.issues(refs, r).collect()} == {("lost", "no anchor"), ("two", "needs one source"), ("open", "needs a window")}
    assert d.materialize(refs.limit(0), r).count() == 0


def fold_rolling(rows):
    """Offset and anchor kept row by row: rows (source, value) in order."""

    def kind(p, v):
        if p > 0 and abs(v - p) <= 0.01 * p:
            return "continuous"
        if v >= p * 0.5:
            return "swap"
        for c in (1e6, 1e7, 1e8):
            if 0.97 * c <= p <= c:
                return c
        return "reset" if p > 100_000 and v < 1000 else "swap"

    offset = anchor = done = raw = 0.0
    source, out = rows[0][0], []
    for s, v in rows:
        if s != source:
            k = kind(raw, v)
            if k == "reset" or isinstance(k, float):
                offset, anchor = done + (k - raw if isinstance(k, float) else 0), 0.0
            elif k == "swap":
                offset, anchor = done, v
            source = s
        done, raw = offset + v - anchor, v
        out.append(done)
    return out


def test_rolling_sum_equals_fold(spark):
    rng = random.Random(4)
    series, refs, want = {}, [], {}
    for k in range(12):
        rows = sorted((n, s) for s in "AB" for n in rng.sample(range(1, 29), rng.randint(0, 9)))
        picked = [(n, s, rng.choice([5.0, 300.0, 999_000.0, 995_000.0, 150_000.0, 9_990_000.0, 1000.0, 1004.0])) for n, s in rows]
        for s in "AB":
            series[f"{k}.{s}"] = [(n, v) for n, x, v in picked if x == s]
        refs.append((f"r{k}", "rolling_sum", None, None, [f"{k}.A", f"{k}.B"]))
        want[f"r{k}"] = fold_rolling([(s, v) for _, s, v in picked]) if picked else []
    out = d.rolling_sums(spark.createDataFrame(refs, REF), readings(spark, series))
    got = {}
    for x in out.select("timeseries_id", "timestamp", "value").collect():
        got.setdefault(x.timeseries_id, []).append(x)
    for k, w in want.items():
        mine = sorted(got.get(k, []), key=lambda x: x.timestamp)
        assert sorted(round(x.value, 6) for x in mine) == sorted(round(v, 6) for v in w)


def daily(spark, meters):
    return e.daily_delta(spark.createDataFrame([(m, at(i + 1).date(), float(a), float(b), 1) for m, rows in meters.items() for i, (a, b) in enumerate(rows)], DAILY))


def test_month_segments(spark):
    df = daily(spark, {"a": [(0, 10), (10, 20), (2, 8), (8, 15)], "b": [(0, 10), (10, 3)]})
    got = {r.meter_id: (r.delta, r.reset_days, r.zero_days, r.n_days) for r in e.monthly_register_delta(df).collect()}
    assert got == {"a": (33, 1, 0, 4), "b": (10, 1, 0, 2)}


def test_events(spark):
    up = [(i, i + 1) for i in range(3)]
    df = daily(
        spark,
        {"frozen": up + [(3, 3)] * 5, "glitch": [(499, 500), (100, 100), (494, 495), (495, 499)], "roll": [(9_990_000, 5)] + [(i, i + 1) for i in range(4)], "swap": [(19_693, 5)] + [(i, i + 1) for i in range(4)], "off": [(100, 5), (5, 6), (6, 7), (7, 7)]},
    )
    got = {(r.meter_id, r.event_type): (r.swap_date.day, r.glitch_end and r.glitch_end.day) for r in e.detect_events(df).collect()}
    assert got[("frozen", "offline")] == (4, None) and got[("glitch", "glitch")] == (2, 4)
    assert ("roll", "rollover") in got and ("swap", "swap") in got and ("off", "offline") in got


def fold_glitches(rows, handled):
    out, i = [], 1
    while i < len(rows) - 1:
        prev, cur = rows[i - 1][1], rows[i][1]
        if cur - prev >= -100 or rows[i][0] in handled:
            i += 1
            continue
        for j in range(i + 1, min(i + 6, len(rows))):
            if abs(rows[j][1] - prev) < abs(cur - prev) * 0.1:
                out.append((rows[i][0], rows[min(j + 1, len(rows) - 1)][0]))
                i = j + 1
                break
        else:
            i += 1
    return out


def fold_segments(events):
    out, cursor, on = [], None, True
    for day, kind, end in events:
        if on:
            out.append((cursor, day))
        on = kind != "offline"
        cursor = end if kind == "glitch" else day
    return out + ([(cursor, None)] if on else [])


def test_glitches_and_segments_equal_folds(spark):
    rng = random.Random(7)
    meters = {f"m{k}": [(0, rng.choice([1000, 1005, 995, 200, 10, 400])) for _ in range(25)] for k in range(15)}
    handled = spark.createDataFrame([(m, at(5).date()) for m in list(meters)[::2]], "meter_id string, swap_date date")
    got = {}
    for r in e.glitches(daily(spark, meters), handled).collect():
        got.setdefault(r.meter_id, []).append((r.swap_date, r.glitch_end))
    for i, (m, rows) in enumerate(meters.items()):
        days = [(at(n + 1).date(), float(b)) for n, (_, b) in enumerate(rows)]
        assert sorted(got.get(m, [])) == fold_glitches(days, {at(5).date()} if i % 2 == 0 else set())
    events = [(m, at(n).date(), rng.choice(["swap", "rollover", "glitch", "offline"]), 0.0, at(n + 2).date()) for m in meters for n in sorted(rng.sample(range(1, 28), rng.randint(1, 5)))]
    df = spark.createDataFrame([(a, b, c, v, g if c == "glitch" else None) for a, b, c, v, g in events], "meter_id string, swap_date date, event_type string, old_last_value double, glitch_end date")
    segs = {}
    for r in e.segments_from_events(df).orderBy("meter_id", "position").collect():
        segs.setdefault(r.meter_id, []).append((r.valid_from, r.valid_to))
    for m in {x[0] for x in events}:
        assert segs.get(m, []) == fold_segments([(b, c, g) for a, b, c, _, g in events if a == m])
