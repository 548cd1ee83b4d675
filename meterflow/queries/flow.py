"""Queries C1-C12."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from meterflow.functions.temporal import valid_at
from meterflow.operators import flow as op
from meterflow.plans.stage import new_path
from meterflow.queries.registry import Registry
from meterflow.sources.store import put_months, read_months
from meterflow.streaming.flow import run_once
from meterflow.streaming.refresh import places_table, refresh

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

LATEST = """
    latest as (
        select timeseries_id, timestamp, value, recorded_at from (
            select *, row_number() over (partition by timeseries_id, timestamp order by recorded_at desc nulls last) as rn from readings) x
        where rn = 1
    )"""
MEASURED = (
    LATEST
    + """, measured as (
        select meter_id, timestamp, delta from (
            select s.meter_id, r.timestamp, r.value - lag(r.value) over (partition by r.timeseries_id order by r.timestamp) as delta
            from latest r join refs t on t.timeseries_id = r.timeseries_id and t.preferred and t.reading_type = 'counter'
            join sensors s on s.sensor_id = t.sensor_id) x
        where delta is not null
    )"""
)
ON = "(e.valid_from is null or e.valid_from <= f.timestamp) and (e.valid_to is null or e.valid_to > f.timestamp)"
SUBS = f"""
    select e.parent_meter_id, f.timestamp, sum(f.delta * coalesce(e.flow_coefficient, 1.0)) as total
    from relations e join {{0}} f on f.meter_id = e.child_meter_id where e.relation_type = 'hasSubMeter' and {ON} group by 1, 2"""
FLOW = (
    MEASURED
    + f""", subs as ({SUBS.format("measured")}), hops as (
        select meter_id, timestamp, delta, 0 as hop from measured
        union all
        select e.child_meter_id, f.timestamp, e.flow_coefficient * (f.delta - coalesce(s.total, 0)), f.hop + 1
        from hops f join relations e on e.parent_meter_id = f.meter_id and e.relation_type = 'feeds' and {ON}
        left join subs s on s.parent_meter_id = f.meter_id and s.timestamp = f.timestamp
        where f.hop < 10
    ), flow as (select meter_id, timestamp, sum(delta) as delta from hops group by 1, 2)"""
)
NET = (
    FLOW
    + f""", hs as ({SUBS.format("flow")}), fk as (
        select e.parent_meter_id, f.timestamp, sum(e.flow_coefficient) as total_k
        from relations e join flow f on f.meter_id = e.parent_meter_id where e.relation_type = 'feeds' and {ON} group by 1, 2
    ), net as (
        select f.meter_id, f.timestamp, (f.delta - coalesce(hs.total, 0)) * (1 - coalesce(fk.total_k, 0)) as net
        from flow f left join hs on hs.parent_meter_id = f.meter_id and hs.timestamp = f.timestamp
        left join fk on fk.parent_meter_id = f.meter_id and fk.timestamp = f.timestamp
    )"""
)


def measured_of(s):
    return op.measured_flow(s.readings, s.refs, s.sensors)


def flow_of(s):
    return op.meter_flow(measured_of(s), s.relations)


def net_of(s):
    return op.meter_net(flow_of(s), s.relations)


@R.query(f"with {LATEST} select * from latest")
def c1_latest_correction(s):
    return op.latest_correction(s.readings)


@R.query(f"with {MEASURED} select * from measured")
def c2_measured_flow(s):
    return measured_of(s)


@R.query(f"""with {LATEST} select * from (
    select timeseries_id, timestamp, value - lag(value) over (partition by timeseries_id order by timestamp) as delta
    from latest where timeseries_id in (select concat('T', u) from users where u % 2 = 0)
    and timestamp >= timestamp '2024-01-05 00:00:00' and timestamp < timestamp '2024-01-20 00:00:00') x where delta is not null""")
def c3_counter_rate(s):
    series = s.users.where("u % 2 = 0").select(F.concat(F.lit("T"), "u").alias("timeseries_id"))
    return op.counter_rate(s.readings, series, "2024-01-05", "2024-01-20", corrected=True)


@R.query("""select r.timeseries_id, r.timestamp, r.value, r.recorded_at, s.meter_id, t.aggregate, t.reading_type, t.kind
    from readings r join refs t on t.timeseries_id = r.timeseries_id join sensors s on s.sensor_id = t.sensor_id""")
def c4_enrich_readings(s):
    return op.enrich_readings(s.readings, s.refs, s.sensors)


@R.query(f"with {MEASURED} {SUBS.format('measured')}")
def c5_sub_total(s):
    return op.sub_total(s.relations, measured_of(s))


@R.query(f"with recursive {FLOW} select * from flow")
def c6_meter_flow(s):
    return flow_of(s)


@R.query(f"with recursive {FLOW} {SUBS.format('flow')}")
def c7_hs_total(s):
    return op.hs_total(s.relations, flow_of(s))


@R.query(f"""with recursive {FLOW} select e.parent_meter_id, f.timestamp, sum(e.flow_coefficient) as total_k
    from relations e join flow f on f.meter_id = e.parent_meter_id where e.relation_type = 'feeds' and {ON} group by 1, 2""")
def c8_feeds_k_sum(s):
    return op.feeds_k_sum(s.relations, flow_of(s))


@R.query(f"with recursive {NET} select * from net")
def c9_meter_net(s):
    return net_of(s)


@R.query(f"""with recursive {FLOW}, hs as ({SUBS.format('flow')})
    select parent_meter_id, cast(date_trunc('month', timestamp) as date) as month, sum(total) as lost, count(*) as n_times from hs
    where not exists (select 1 from flow f where f.meter_id = hs.parent_meter_id and f.timestamp = hs.timestamp) group by 1, 2""")
def c9_lost_child_flow(s):
    return op.lost_child_flow(flow_of(s), s.relations)


@R.query(f"""with recursive {MEASURED}, paths as (
        select meter_id as ancestor, meter_id, date '0001-01-01' as lo, date '9999-12-31' as hi from (select distinct meter_id from measured) m
        union all
        select e.parent_meter_id, p.meter_id, greatest(p.lo, coalesce(e.valid_from, date '0001-01-01')), least(p.hi, coalesce(e.valid_to, date '9999-12-31'))
        from paths p join relations e on e.child_meter_id = p.ancestor
        where greatest(p.lo, coalesce(e.valid_from, date '0001-01-01')) < least(p.hi, coalesce(e.valid_to, date '9999-12-31')))
    select p.ancestor as meter_id, f.timestamp, sum(f.delta) as delta from paths p join measured f on f.meter_id = p.meter_id
    where p.lo <= f.timestamp and f.timestamp < p.hi group by 1, 2""")
def c10_subtree_rollup(s):
    return op.subtree_rollup(measured_of(s), s.relations)


# the same over the line items' counters, some hundred times as many rows
LINES = {"readings": "line_readings", "refs": "line_refs", "sensors": "line_sensors", "relations": "line_relations"}


def over_lines(sql: str) -> str:
    return re.sub(rf"\b({'|'.join(LINES)})\b", lambda m: LINES[m[0]], sql)


@R.query(over_lines(f"with {MEASURED} select * from measured"))
def c2_measured_lines(s):
    return op.measured_flow(s.line_readings, s.line_refs, s.line_sensors)


@R.query(over_lines(f"with recursive {FLOW} select * from flow"))
def c6_line_flow(s):
    return op.meter_flow(c2_measured_lines(s), s.line_relations)


@R.query(over_lines(f"with recursive {NET} select * from net"))
def c9_line_net(s):
    return op.meter_net(c6_line_flow(s), s.line_relations)


@R.query("""select r.timeseries_id, r.timestamp, m.meter_id, (m.valid_from is null or m.valid_from <= r.timestamp) and (m.valid_to is null or m.valid_to > r.timestamp) as valid
    from readings r join meters m on substr(m.meter_id, 2) = substr(r.timeseries_id, 2)""")
def c11_validity_mask(s):
    """Every reading with whether its meter's window holds its time."""
    m = s.meters.select("meter_id", "valid_from", "valid_to", F.concat(F.lit("T"), F.expr("substr(meter_id, 2)")).alias("timeseries_id"))
    rows = s.readings.join(m, "timeseries_id")
    return rows.select("timeseries_id", "timestamp", "meter_id", valid_at(F.col("timestamp"), F.col("valid_from"), F.col("valid_to")).alias("valid"))


@R.query(f"""with {LATEST} select timeseries_id, timestamp, delta from (
    select timeseries_id, timestamp, value - lag(value) over (partition by timeseries_id order by timestamp) as delta from latest) x where delta is not null""")
def x1_measured_flow_stream(s):
    """All readings through the stream as one arrival, then two that are a single reading far ahead each:
    they move the watermark on, so that the last readings are due."""
    readings = s.readings.select("timeseries_id", "timestamp", "value", "recorded_at")
    last = readings.agg(F.max("timestamp").alias("t"))
    ahead = (last.select(F.lit("").alias("timeseries_id"), (F.col("t") + F.make_interval(days=F.lit(days))).alias("timestamp"), F.lit(0.0).alias("value"), F.lit(None).cast("timestamp").alias("recorded_at")) for days in (30, 60))
    return run_once(s.spark, [readings, *ahead]).where("timeseries_id <> ''")


PLACES = NET + """, placed as (
        select n.timestamp, n.net, case when m.target_kind = 'zone' then m.target_id end as zone_id,
               case when m.target_kind = 'building' then m.target_id else z.building_id end as building_id, case when m.target_kind = 'campus' then m.target_id else b.campus_id end as campus_id
        from net n join measures m on m.meter_id = n.meter_id and (m.valid_from is null or m.valid_from <= n.timestamp) and (m.valid_to is null or m.valid_to > n.timestamp)
        left join zones z on m.target_kind = 'zone' and z.zone_id = m.target_id
        left join buildings b on b.building_id = case when m.target_kind = 'building' then m.target_id else z.building_id end
    ), places as (
        select 'zone' as level, zone_id as id, timestamp, net from placed union all select 'building', building_id, timestamp, net from placed union all select 'campus', campus_id, timestamp, net from placed
    )"""


@R.query(f"with recursive {PLACES} select level, id, timestamp, sum(net) as net from places where id is not null group by 1, 2, 3")
def x1_refreshed_places(s):
    """First readings, then corrections, applied to a folder kept by month; consumption per place as it is then."""
    folder = new_path(s.spark, "kept")
    site = {n: getattr(s, n) for n in ("refs", "sensors", "relations", "measures", "zones", "buildings")}
    for batch in ("recorded_at is null", "recorded_at is not null"):
        refresh(s.readings.where(batch), folder, site)
    return places_table(s.spark, folder)


@R.query("""select timeseries_id, timestamp, case when year(timestamp) = 1995 and month(timestamp) = 3 then value + 1000 else value end as value from line_readings
    where timestamp >= timestamp '1994-06-10 00:00:00' and timestamp < timestamp '1996-02-20 00:00:00'""")
def s2_readings_by_month(s):
    """Readings kept by month, one of them written again, and a range read back."""
    path = new_path(s.spark, "months")
    rows = s.line_readings
    put_months(rows, path)
    put_months(rows.where("year(timestamp) = 1995 and month(timestamp) = 3").withColumn("value", F.col("value") + 1000), path)
    return read_months(s.spark, path, rows.schema, "1994-06-10", "1996-02-20").select("timeseries_id", "timestamp", "value")


@R.query(f"with {MEASURED} select meter_id, cast(date_trunc('month', timestamp) as date) as month, sum(delta) as delta from measured group by 1, 2")
def c12_monthly_delta(s):
    return op.monthly_delta(measured_of(s))
