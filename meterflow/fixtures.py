"""The model's tables derived from the star-schema tables, as SQL that Spark and DuckDB both read.

Every fixture is one SELECT over raw tables, written {like_this}, and other fixtures. Values are
whole numbers (hundredths of the event values), so sums are exact in any order.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

FIXTURES: dict[str, str] = {
    "ev": "select user_id as u, cast(ts as date) as d, event_type, cast(round(value * 100) as double) as v from {events}",
    "users": "select distinct user_id as u from {events}",
    "daily": "select u, d, sum(v) as dv, count(*) as n from ev group by u, d",
    "running": "select u, d, dv, n, sum(dv) over (partition by u order by d rows between unbounded preceding and current row) as c from daily",
    # every 13th reading was first recorded wrong and corrected later
    "readings": """
        select concat('T', u) as timeseries_id, cast(d as timestamp) as timestamp,
               case when (u * 31 + day(d)) % 13 = 0 then c + 1000 else c end as value, cast(null as timestamp) as recorded_at
        from running
        union all
        select concat('T', u), cast(d as timestamp), c, cast('2024-02-01 00:00:00' as timestamp) from running where (u * 31 + day(d)) % 13 = 0""",
    "campuses": "select concat('C', r_regionkey) as campus_id, r_name as name, cast(null as varchar(9)) as identifier from {region}",
    "buildings": "select concat('B', n_nationkey) as building_id, n_name as name, concat('C', n_regionkey) as campus_id, cast(null as varchar(9)) as identifier from {nation}",
    "zones": """
        select concat('Z', n_nationkey, '_', s) as zone_id, concat('zone ', s) as name, concat('B', n_nationkey) as building_id,
               'floor' as zone_type, cast(null as varchar(9)) as identifier
        from {nation} cross join (select 0 as s union all select 1 union all select 2) x""",
    "media_types": "select m as media_type_id, m as name from (select 'el' as m union all select 'heat' union all select 'water') x",
    "meters": """
        select concat('M', u) as meter_id, concat('meter ', u) as name, case when u % 10 = 0 then null else concat('B', u % 25) end as building_id,
               case u % 3 when 0 then 'el' when 1 then 'heat' else 'water' end as media_type_id, u % 12 = 5 as is_virtual_meter,
               cast(null as varchar(9)) as identifier,
               case when u % 9 = 2 then date '2024-01-08' end as valid_from, case when u % 13 = 4 then date '2024-01-25' end as valid_to
        from users""",
    "relations": """
        select concat('M', cast(floor((u - 1) / 4.0) as bigint)) as parent_meter_id, concat('M', u) as child_meter_id,
               case when u % 3 = 0 then 'feeds' else 'hasSubMeter' end as relation_type,
               case when u % 3 = 0 then 0.5e0 when u % 5 = 1 then cast(null as double) else 1.0e0 end as flow_coefficient,
               case when u % 7 = 0 then date '2024-01-10' end as valid_from, case when u % 11 = 0 then date '2024-01-20' end as valid_to,
               'tree' as derived_from
        from users where u > 0
        union all
        select concat('M', u - 2), concat('M', u), 'feeds', 0.25e0, cast(null as date), cast(null as date), 'second' from users where u % 12 = 3""",
    "measures": """
        select concat('M', u) as meter_id, case u % 3 when 0 then 'zone' when 1 then 'building' else 'campus' end as target_kind,
               case u % 3 when 0 then concat('Z', u % 25, '_', u % 2) when 1 then concat('B', u % 25) else concat('C', u % 5) end as target_id,
               cast(null as date) as valid_from, case when u % 8 = 0 then date '2024-01-15' end as valid_to
        from users""",
    "sensors": """
        select concat('S', u) as sensor_id, concat('M', u) as meter_id, 'Energy_Sensor' as point_type,
               case when u % 6 = 5 then 'MegaW-HR' else 'KiloW-HR' end as unit, cast(null as varchar(9)) as identifier
        from users
        union all
        select concat('S', u, 'b'), concat('M', u), 'Energy_Sensor', 'M3', cast(null as varchar(9)) from users where u % 14 = 3""",
    # sources is the stored, pipe-joined form
    "refs": """
        select concat('T', u) as timeseries_id, concat('S', u) as sensor_id, 'daily' as aggregate, case when u % 17 = 16 then 'delta' else 'counter' end as reading_type,
               'raw' as kind, u % 19 <> 18 as preferred, cast(null as date) as valid_from, cast(null as date) as valid_to, 'D0' as database_id, 'log' as path,
               concat('X', u) as external_id, concat('V', u % 40) as device_id, '' as sources, cast(null as varchar(20)) as aggregation
        from users""",
    "devices": "select distinct concat('V', u % 40) as device_id, concat('serial ', u % 40) as serial, 'maker' as manufacturer, cast(null as varchar(9)) as identifier from users",
    "annotations": """
        select concat('A', u) as annotation_id, case u % 4 when 0 then 'meter' when 1 then 'building' when 2 then 'campus' else 'timeseries' end as target_kind,
               case u % 4 when 0 then concat('M', u) when 1 then concat('B', u % 25) when 2 then concat('C', u % 5) else concat('T', u) end as target_id,
               case when u % 2 = 0 then 'outage' else 'swap' end as category,
               case when u % 5 = 0 then null else date '2024-01-05' end as valid_from,
               case when u % 7 = 0 then null when u % 7 = 1 then date '2024-01-06' else date '2024-01-18' end as valid_to,
               '' as description, case when u % 6 = 0 then 'el' end as media, u % 3 <> 0 as is_resolved
        from users""",
    # registers that wrap at 200,000
    "register": """
        select concat('X', u) as meter_id, 'energy' as quantity, d as day, (c - dv) % 200000 as v_first, c % 200000 as v_last, n as n_readings from running where u % 29 <> 28
        union all
        select concat('X', u), 'power', d, dv, dv, n from running where u % 10 = 0""",
    "listed": "select concat('X', u) as meter_id from users where u % 4 <> 3",
    "timeseries_daily": """
        select meter_id, day, v_first, v_last, v_last - v_first as delta, n_readings, v_last - v_first < 0 as is_reset
        from register where quantity = 'energy'""",
    # a month is a decade of January, to have several
    "meter_monthly": "select concat('M', u) as meter_id, concat('2024-0', cast(floor((day(d) - 1) / 5.0) + 1 as int)) as month, sum(dv) as delta from running group by 1, 2",
    "reported": """
        select concat('B', u % 25) as building_id, month, sum(dv) * (case when max(u) % 3 = 0 then 2 else 1 end) as value
        from (select u, dv, concat('2024-0', cast(floor((day(d) - 1) / 5.0) + 1 as int)) as month from running where u % 10 <> 0) x
        where u % 25 <> 7 group by u % 25, month""",
    # series that hand over on 15 January: by number a plain swap, a rollover, a reset, or one counter
    "parts": """
        select concat('P', u, 'a') as timeseries_id, cast(d as timestamp) as timestamp,
               case u % 4 when 0 then c when 1 then 990000 + day(d) * 10.0 when 2 then 150000 + day(d) * 100.0 else 100000 + day(d) * 7.0 end as value
        from running where d < date '2024-01-15'
        union all
        select concat('P', u, 'b'), cast(d as timestamp), case u % 4 when 0 then c + 5000 when 1 then c % 900 when 2 then day(d) * 11.0 else 100000 + day(d) * 7.0 end
        from running where d >= date '2024-01-15'""",
    "derived_refs": """
        select concat('M', u, '.x') as timeseries_id, case u % 5 when 0 then 'slice' when 1 then 'sum' when 2 then 'bracket' when 3 then 'interpolate' else 'rolling_sum' end as aggregation,
               case u % 5 when 0 then date '2024-01-05' when 1 then date '2024-01-08' when 2 then date '2024-01-10' when 3 then date '2024-01-10' end as valid_from,
               case u % 5 when 0 then date '2024-01-20' when 2 then date '2024-01-14' when 3 then (case when u % 2 = 0 then date '2024-01-15' else date '2024-03-01' end) end as valid_to,
               case u % 5 when 1 then concat('T', u, '|T', u + 1) when 4 then concat('P', u, 'a|P', u, 'b') else concat('T', u) end as sources
        from users""",
    # counters of suppliers' shipments: by far the largest tables here
    "line_daily": "select l_suppkey as k, cast(l_shipdate as date) as d, cast(sum(l_quantity) as double) as q from {lineitem} group by l_suppkey, cast(l_shipdate as date)",
    "line_readings": """
        select concat('L', k) as timeseries_id, cast(d as timestamp) as timestamp,
               sum(q) over (partition by k order by d rows between unbounded preceding and current row) as value, cast(null as timestamp) as recorded_at
        from line_daily""",
    "line_refs": "select concat('L', k) as timeseries_id, concat('LS', k) as sensor_id, 'counter' as reading_type, true as preferred from (select distinct l_suppkey as k from {lineitem}) x",
    "line_sensors": "select concat('LS', k) as sensor_id, concat('K', k) as meter_id from (select distinct l_suppkey as k from {lineitem}) x",
    "line_relations": """
        select concat('K', cast(floor((k - 1) / 4.0) as bigint)) as parent_meter_id, concat('K', k) as child_meter_id, case when k % 3 = 0 then 'feeds' else 'hasSubMeter' end as relation_type,
               case when k % 3 = 0 then 0.5e0 when k % 5 = 1 then cast(null as double) else 1.0e0 end as flow_coefficient,
               case when k % 7 = 0 then date '1994-01-10' end as valid_from, case when k % 11 = 0 then date '1997-01-20' end as valid_to
        from (select distinct l_suppkey as k from {lineitem}) x where k > 4""",
    "computed": """
        select building_id, month, sum(delta) as value
        from meter_monthly join meters on meter_monthly.meter_id = meters.meter_id
        where building_id is not null and building_id <> 'B9' group by building_id, month""",
}

#: a raw table that is dealt out once, by the column that a fixture's sums and windows have in common
DEALT = {"line_readings": ("lineitem", "l_suppkey")}

_NAME = re.compile("|".join(rf"\b{n}\b" for n in sorted(FIXTURES, key=len, reverse=True)))


def _needed(sql: str) -> list[str]:
    """The fixtures that `sql` names, and theirs, in an order in which each follows those it names."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in sorted(set(_NAME.findall(text)), key=list(FIXTURES).index):
            if name not in found:
                visit(_body(name))
                found.append(name)

    visit(sql)
    return found


def _body(name: str) -> str:
    # the fixture's own name may stand as an alias or column in its text
    return re.sub(rf"\b{name}\b", "_", FIXTURES[name])


def oracle(sql: str) -> str:
    """`sql` for DuckDB, with the fixtures that it names as common table expressions. A leading
    "with" of its own is continued."""
    parts = ",\n".join(f"{n} as ({FIXTURES[n]})" for n in _needed(sql))
    raw = parts.format(**{t: t for t in RAW})
    sql = sql.strip()
    recursive = "recursive " if sql.lower().startswith("with recursive ") else ""
    rest = re.sub(r"(?is)^with\s+(recursive\s+)?", ", ", sql) if sql.lower().startswith("with") else sql
    return f"with {recursive}{raw}\n{rest}" if raw else sql


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a DataFrame over the star-schema tables of `sf_dir`."""
    parts = ", ".join(f"{n} as ({FIXTURES[n]})" for n in _needed(_body(name)))
    sql = f"with {parts} {FIXTURES[name]}" if parts else FIXTURES[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in RAW if "{" + t + "}" in sql}
    if name in DEALT:
        table, column = DEALT[name]
        used[table] = used[table].repartition(column)
    return spark.sql(sql, **used)


class Site:
    """Fixtures by attribute: Site(spark, sf_dir).readings."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name not in FIXTURES:
            raise AttributeError(name)
        return fixture(self.spark, self.sf_dir, name)
