"""Queries Q1-Q15, Q19 and Q20."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.operators import flow as fl
from meterflow.operators import rollup as op
from meterflow.plans.stage import staged
from meterflow.queries.flow import MEASURED, NET, flow_of, measured_of, net_of
from meterflow.queries.registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

PLACED = (
    NET
    + """, placed as (
        select n.meter_id, n.timestamp, n.net, case when m.target_kind = 'zone' then m.target_id end as zone_id,
               case when m.target_kind = 'building' then m.target_id else z.building_id end as building_id,
               case when m.target_kind = 'campus' then m.target_id else b.campus_id end as campus_id
        from net n join measures m on m.meter_id = n.meter_id
             and (m.valid_from is null or m.valid_from <= n.timestamp) and (m.valid_to is null or m.valid_to > n.timestamp)
        left join zones z on m.target_kind = 'zone' and z.zone_id = m.target_id
        left join buildings b on b.building_id = case when m.target_kind = 'building' then m.target_id else z.building_id end
    ), consumed as (
        select 'zone' as level, zone_id as id, timestamp, sum(net) as net from placed where zone_id is not null group by 2, 3
        union all select 'building', building_id, timestamp, sum(net) from placed where building_id is not null group by 2, 3
        union all select 'campus', campus_id, timestamp, sum(net) from placed where campus_id is not null group by 2, 3
    )"""
)
MONTHS = [f"2024-0{i}" for i in range(1, 8)]


def placed_of(s):
    return op.attributed(net_of(s), s.measures, s.zones, s.buildings)


@R.query(f"with recursive {PLACED} select * from placed")
def q1_attributed(s):
    return placed_of(s)


@R.query(f"with recursive {PLACED} select * from consumed")
def q2_consumption(s):
    return op.consumption(placed_of(s))


@R.query(f"""with recursive {PLACED} select level, id, sum(net) as total from consumed
    where timestamp >= timestamp '2024-01-05 00:00:00' and timestamp < timestamp '2024-01-25 00:00:00' group by 1, 2""")
def q3_consumption_totals(s):
    return op.consumption_totals(op.consumption(placed_of(s)), "2024-01-05", "2024-01-25")


CONSERVED = (
    NET
    + """, drawn as (
        select cast(timestamp as date) as day, sum(delta) as campus from flow where meter_id in (
            select meter_id from meters where media_type_id = 'el' and building_id is null and meter_id not in (select child_meter_id from relations)) group by 1
    ), used as (
        select cast(timestamp as date) as day, sum(net) as buildings from net where meter_id in (
            select meter_id from meters where media_type_id = 'el' and building_id is not null) group by 1
    ), conserved as (select coalesce(d.day, u.day) as day, d.campus, u.buildings from drawn d full join used u on d.day = u.day)"""
)


def conserved_of(s):
    flow = staged(flow_of(s), "flow")
    return op.conservation(flow, fl.meter_net(flow, s.relations), s.meters, s.relations, "el")


@R.query(f"with recursive {CONSERVED} select * from conserved")
def q4_conservation(s):
    return conserved_of(s)


@R.query(f"""with recursive {CONSERVED}, m as (
        select strftime(day, '%Y-%m') as month, coalesce(sum(campus), 0.0) as campus, coalesce(sum(buildings), 0.0) as buildings from conserved group by 1)
    select month, campus, buildings, campus - buildings as residual, (campus - buildings) / nullif(campus, 0.0) * 100 as residual_pct from m""")
def q5_conservation_monthly(s):
    return op.conservation_monthly(conserved_of(s))


@R.query(f"""with recursive {NET}, y as (select meter_id, sum(net) as net from net where year(timestamp) = 2024 group by 1), t as (
        select building_id, media_type_id, sum(coalesce(y.net, 0.0)) as net from meters m left join y on y.meter_id = m.meter_id
        where building_id is not null group by 1, 2)
    select b.building_id, b.campus_id, max(case when t.media_type_id = 'el' then net end) as el, max(case when t.media_type_id = 'heat' then net end) as heat,
           max(case when t.media_type_id = 'water' then net end) as water
    from buildings b left join t on t.building_id = b.building_id group by 1, 2""")
def q6_building_totals(s):
    return op.building_totals(net_of(s), s.meters, s.buildings, ["el", "heat", "water"], 2024)


COMPARED = """
    both_sides as (
        select coalesce(r.building_id, c.building_id) as building_id, coalesce(r.month, c.month) as month,
               coalesce(r.value, 0.0) as reported, coalesce(c.value, 0.0) as computed
        from reported r full join computed c
             on r.building_id = c.building_id and r.month = c.month
    ), diffs as (select *, computed - reported as diff, (computed - reported) / nullif(reported, 0.0) * 100 as diff_pct from both_sides)"""


@R.query(f"""with {COMPARED} select d.building_id, d.month, d.reported, d.computed, d.diff, d.diff_pct,
        case when n.n_nationkey % 2 = 0 and d.month = '2024-02' then 'known' end as reason, sum(abs(d.diff)) over (partition by d.building_id) as total_diff
    from diffs d join nation n on concat('B', n.n_nationkey) = d.building_id""")
def q7_compare_reported(s):
    reasons = s.buildings.where("cast(substr(building_id, 2) as int) % 2 = 0").select("building_id", F.lit("2024-02").alias("month"), F.lit("known").alias("reason"))
    return op.compare_reported(s.reported, s.computed, reasons, MONTHS)


@R.query("""with u as (
        select meter_id, case when count(distinct unit) = 1 then min(unit) else 'mixed' end as unit from sensors group by 1),
    g as (select s.meter_id, arg_min(t.aggregate, t.timeseries_id) as granularity from refs t join sensors s on s.sensor_id = t.sensor_id
          where t.preferred and t.reading_type = 'counter' group by 1)
    select u.meter_id, u.unit, case u.unit when 'KiloW-HR' then 'kWh' when 'MegaW-HR' then 'MWh' when 'M3' then 'm³' else u.unit end as label, g.granularity
    from u left join g on g.meter_id = u.meter_id""")
def q10_unit_of(s):
    return op.unit_of(s.sensors, s.refs)


@R.query(f"""with {MEASURED}, w as (select meter_id, case when count(distinct unit) = 1 then min(unit) else 'mixed' end as unit from sensors group by 1)
    select m.meter_id, m.timestamp, delta * case unit when 'KiloW-HR' then 1.0 when 'MegaW-HR' then 1000.0 when 'M3' then 1.0 end as delta from measured m left join w on w.meter_id = m.meter_id""")
def q10_rescaled(s):
    return op.rescaled(measured_of(s), op.unit_of(s.sensors, s.refs))


DOWN = """down as (select meter_id from meters where meter_id in ('M1', 'M7')
        union select e.child_meter_id from down d join relations e on e.parent_meter_id = d.meter_id)"""


def down_of(s):
    return op.descendants(s.relations, s.meters.where("meter_id in ('M1', 'M7')"))


@R.query(f"with recursive {DOWN} select * from down")
def q11_descendants(s):
    return down_of(s)


DRILL = f"""with recursive {MEASURED}, {DOWN}, roles as (
        select d.meter_id, case when d.meter_id in (select child_meter_id from relations where parent_meter_id in (select meter_id from down)) then 'sub' else 'add' end as role
        from down d), drill as (
        select r.meter_id, r.role, f.timestamp, f.delta * (case when r.role = 'sub' then -1.0 else 1.0 end) as delta from roles r join measured f on f.meter_id = r.meter_id)"""


@R.query(f"{DRILL} select * from drill")
def q12_drilldown(s):
    return op.drilldown(down_of(s), s.relations, measured_of(s), flip=True)


@R.query(f"""{DRILL}, wide as (select meter_id, role, sum(delta) as "2024-01" from drill where strftime(timestamp, '%Y-%m') = '2024-01' group by 1, 2)
    select meter_id, role, "2024-01", coalesce("2024-01", 0.0) as total from wide
    union all select 'Σ', 'total', sum("2024-01"), sum(coalesce("2024-01", 0.0)) from wide""")
def q13_drilldown_pivot(s):
    return op.drilldown_pivot(op.drilldown(down_of(s), s.relations, measured_of(s), flip=True), ["2024-01"])


@R.query("""with live as (select meter_id from meters where (valid_from is null or valid_from <= date '2024-01-06') and (valid_to is null or valid_to > date '2024-01-06'))
    select * from relations where (valid_from is null or valid_from <= date '2024-01-06') and (valid_to is null or valid_to > date '2024-01-06')
    and parent_meter_id in (select meter_id from live) and child_meter_id in (select meter_id from live)""")
def q14_topology_as_of(s):
    return op.topology_as_of(s.meters, s.relations, "2024-01-06")


NAMES = ("annotations", "buildings", "devices", "media_types", "meters", "readings", "sensors", "zones")


def dataset(s):
    tables = {n: getattr(s, n) for n in NAMES}
    return tables | {"meter_relations": s.relations, "meter_measures": s.measures, "timeseries_refs": s.refs, "campuses": s.campuses}


KEYS = {
    "annotations": "annotation_id", "buildings": "building_id", "campuses": "campus_id", "devices": "device_id", "media_types": "media_type_id", "meter_measures": "meter_id", "meter_relations": "child_meter_id", "meters": "meter_id", "readings": "timeseries_id", "sensors": "sensor_id", "timeseries_refs": "timeseries_id", "zones": "zone_id",
}


@R.query("""with m as (select * from meters where media_type_id = 'heat'), sn as (select * from sensors where meter_id in (select meter_id from m)),
    r as (select * from refs where sensor_id in (select sensor_id from sn)),
    a as (select * from annotations where (media is null or lower(media) = 'heat') and (target_kind = 'campus'
        or (target_kind = 'meter' and target_id in (select meter_id from m)) or (target_kind = 'building' and target_id in (select building_id from m))
        or (target_kind = 'timeseries' and target_id in (select timeseries_id from r))))
    select 'annotations' as name, annotation_id as id, count(*) as n from a group by 2
    union all select 'buildings', building_id, count(*) from buildings where building_id in (select building_id from m) group by 2
    union all select 'campuses', campus_id, count(*) from campuses group by 2
    union all select 'devices', device_id, count(*) from devices where device_id in (select device_id from r) group by 2
    union all select 'media_types', media_type_id, count(*) from media_types where media_type_id = 'heat' group by 2
    union all select 'meter_measures', meter_id, count(*) from measures where meter_id in (select meter_id from m) group by 2
    union all select 'meter_relations', child_meter_id, count(*) from relations where parent_meter_id in (select meter_id from m) or child_meter_id in (select meter_id from m) group by 2
    union all select 'meters', meter_id, count(*) from m group by 2
    union all select 'readings', timeseries_id, count(*) from readings where timeseries_id in (select timeseries_id from r) group by 2
    union all select 'sensors', sensor_id, count(*) from sn group by 2
    union all select 'timeseries_refs', timeseries_id, count(*) from r group by 2
    union all select 'zones', zone_id, count(*) from zones where building_id in (select building_id from m) group by 2""")
def q15_filter_by_media(s):
    """The ids that are left of every table, with their rows."""
    t = op.filter_by_media(dataset(s), "heat")
    count = lambda name, key: t[name].groupBy(F.col(key).alias("id")).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "id", "n")
    return reduce(DataFrame.unionByName, (count(name, key) for name, key in KEYS.items()))


@R.query("""select b.campus_id, count(*) as n_meters, cast(sum(case when m.is_virtual_meter then 1 else 0 end) as bigint) as n_virtual
    from meters m join buildings b on b.building_id = m.building_id group by 1""")
def q19_ad_hoc_sql(s):
    op.register_views({"meters": s.meters, "buildings": s.buildings}, "site_")
    return s.spark.sql("""select b.campus_id, count(*) as n_meters, sum(case when m.is_virtual_meter then 1 else 0 end) as n_virtual
        from site_meters m join site_buildings b on b.building_id = m.building_id group by 1""")


@R.query(" union all ".join(f"select '{n}' as name, count(*) as n from {t}" for n, t in [(n, n) for n in NAMES] + [("meter_relations", "relations"), ("meter_measures", "measures"), ("timeseries_refs", "refs"), ("campuses", "campuses")]))
def q20_table_counts(s):
    return op.table_counts(dataset(s))
