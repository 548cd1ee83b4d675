"""Queries V1-V18: each rule over tables with planted faults."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from meterflow.operators import validate as op
from meterflow.queries.registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

# edges with faults: coefficients out of range or missing, repeated windows, unknown ends, cycles in time
EDGES = """bad_edges as (
    select parent_meter_id, child_meter_id, relation_type, flow_coefficient, valid_from, valid_to from relations
    union all select concat('M', u), concat('M', u + 1), case when u % 3 = 0 then 'feeds' else 'hasSubMeter' end,
        case u % 5 when 0 then null when 1 then -0.5 when 2 then 1.5 else 0.25 end, null, null from users where u % 10 = 3 or u % 14 = 2 or u % 9 = 6
    union all select parent_meter_id, child_meter_id, relation_type, flow_coefficient, date '2024-01-15', null from relations where child_meter_id like 'M_4'
    union all select 'M9999', concat('M', u), 'hasSubMeter', 1.0, null, null from users where u % 50 = 7
    union all select concat('M', u), concat('M', cast(floor((u - 1) / 4.0) as bigint)), 'hasSubMeter', 1.0, date '2024-01-18', null from users where u % 58 = 5 or u % 41 = 22 or u % 72 = 5)"""
COLS = ["parent_meter_id", "child_meter_id", "relation_type", "flow_coefficient", "valid_from", "valid_to"]


def edges_of(s):
    u, m = F.col("u"), lambda c: F.concat(F.lit("M"), c)
    day = lambda d: F.lit(d).cast("date")

    def rows(df, parent, child, kind, k, start=None, end=None):
        return df.select(parent.alias(COLS[0]), child.alias(COLS[1]), kind.alias(COLS[2]), k.cast("double").alias(COLS[3]), day(start).alias(COLS[4]), day(end).alias(COLS[5]))

    r, one, sub = s.relations.select(COLS), F.lit(1.0), F.lit("hasSubMeter")
    k = F.when(u % 5 == 0, None).when(u % 5 == 1, -0.5).when(u % 5 == 2, 1.5).otherwise(0.25)
    up = F.floor((u - 1) / 4.0)
    return (
        r.unionByName(rows(s.users.where("u % 10 = 3 or u % 14 = 2 or u % 9 = 6"), m(u), m(u + 1), F.when(u % 3 == 0, "feeds").otherwise("hasSubMeter"), k))
        .unionByName(r.where("child_meter_id like 'M_4'").withColumn("valid_from", day("2024-01-15")).withColumn("valid_to", day(None)))
        .unionByName(rows(s.users.where("u % 50 = 7"), F.lit("M9999"), m(u), sub, one))
        .unionByName(rows(s.users.where("u % 58 = 5 or u % 41 = 22 or u % 72 = 5"), m(u), m(up), sub, one, "2024-01-18"))
    )


# references with faults
REFS = """bad_refs as (
    select timeseries_id, sensor_id, aggregate, case when cast(substr(timeseries_id, 2) as int) % 23 = 0 then 'other' else kind end as kind, preferred, valid_from, valid_to,
           case when cast(substr(timeseries_id, 2) as int) % 11 = 0 then '' else database_id end as database_id, path,
           case when cast(substr(timeseries_id, 2) as int) % 22 = 0 then null else external_id end as external_id,
           case when cast(substr(timeseries_id, 2) as int) % 31 = 0 then 'T1' else '' end as sources, aggregation from refs
    union all select concat('D', u), concat('S', u), 'daily', 'derived', u % 3 = 0, null, null, case when u % 4 = 0 then 'D0' end, null, null,
           case u % 5 when 0 then '' when 1 then concat('D', u) when 2 then concat('T', u, '|T9999') else concat('T', u) end, case u % 7 when 0 then null when 1 then 'mean' else 'sum' end from users where u % 6 = 0
    union all select concat('T', u, 'r'), concat('S', u), 'daily', 'raw', false, date '2024-01-10', null, 'D0', 'log', 'x', '', null from users where u % 40 = 9)"""
RCOLS = ["timeseries_id", "sensor_id", "aggregate", "kind", "preferred", "valid_from", "valid_to", "database_id", "path", "external_id", "sources", "aggregation"]


def refs_of(s):
    from meterflow.sources.tables import split_list

    n, u = F.expr("cast(substr(timeseries_id, 2) as int)"), F.col("u")
    day = lambda d: F.lit(d).cast("date")
    text = F.lit(None).cast("string")
    a = s.refs.withColumn("kind", F.when(n % 23 == 0, "other").otherwise(F.col("kind"))).withColumn("database_id", F.when(n % 11 == 0, "").otherwise(F.col("database_id")))
    a = a.withColumn("external_id", F.when(n % 22 != 0, F.col("external_id"))).withColumn("sources", F.when(n % 31 == 0, "T1").otherwise("")).select(RCOLS)
    own = F.concat(F.lit("D"), u)
    src = F.when(u % 5 == 0, "").when(u % 5 == 1, own).when(u % 5 == 2, F.concat(F.lit("T"), u, F.lit("|T9999"))).otherwise(F.concat(F.lit("T"), u))
    b = s.users.where("u % 6 = 0").select(
        own.alias(RCOLS[0]), F.concat(F.lit("S"), u).alias(RCOLS[1]), F.lit("daily").alias(RCOLS[2]), F.lit("derived").alias(RCOLS[3]), (u % 3 == 0).alias(RCOLS[4]), day(None).alias(RCOLS[5]), day(None).alias(RCOLS[6]),
        F.when(u % 4 == 0, "D0").alias(RCOLS[7]), text.alias(RCOLS[8]), text.alias(RCOLS[9]), src.alias(RCOLS[10]), F.when(u % 7 == 1, "mean").when(u % 7 != 0, "sum").alias(RCOLS[11]),
    )
    c = s.users.where("u % 40 = 9").select(
        F.concat(F.lit("T"), u, F.lit("r")).alias(RCOLS[0]), F.concat(F.lit("S"), u).alias(RCOLS[1]), F.lit("daily").alias(RCOLS[2]), F.lit("raw").alias(RCOLS[3]), F.lit(False).alias(RCOLS[4]),
        day("2024-01-10").alias(RCOLS[5]), day(None).alias(RCOLS[6]), F.lit("D0").alias(RCOLS[7]), F.lit("log").alias(RCOLS[8]), F.lit("x").alias(RCOLS[9]), F.lit("").alias(RCOLS[10]), text.alias(RCOLS[11]),
    )
    return a.unionByName(b).unionByName(c).withColumn("sources", split_list(F.col("sources")))


EDGE = "concat(parent_meter_id, '->', child_meter_id)"


MESSAGES = {
    "no_cycles": "edges that hold at one time form a cycle", "feeds_requires_flow_coefficient": "a feeds edge needs a coefficient", "feeds_flow_coefficient_positive": "a feeds coefficient must be positive",
    "feeds_flow_coefficients_sum_to_one": "coefficients do not add up to 1", "hassubmeter_flow_coefficient_out_of_range": "a sub-meter's coefficient must be in (0, 1]",
    "exactly_one_preferred_ref": "a sensor needs exactly one preferred reference", "validity_non_overlapping": "windows of one edge overlap", "ref_kind_invalid": "kind is neither raw nor derived",
    "ref_raw_missing_addressing": "a raw reference needs an address", "ref_raw_has_derived_fields": "a raw reference has no sources or aggregation", "ref_derived_missing_declaration": "a derived reference needs sources and an aggregation",
    "ref_derived_has_addressing": "a derived reference has no address", "ref_aggregation_vocabulary": "unknown aggregation", "ref_validity_non_overlapping": "windows of raw references of one sensor overlap",
    "media_consistency": "an edge joins two media", "orphan_meter": "a meter without edges",
}


def rule(name: str, sql: str, of, details: str = ""):
    """Register a rule: rows (rule, subject), with the message if it is a fixed one and, if `details` has
    SQL for it, the context as text; the SQL selects rule and subject."""
    which = re.findall(r"select '(\w+)' as rule", sql)
    fixed = len(set(which)) == 1 and which[0] in MESSAGES
    text = sql.replace(" as subject", f" as subject, {details} as details") if details else sql
    if fixed:
        text = "select *, '" + MESSAGES[which[0]].replace("'", "''") + f"' as message from ({text}) violations"

    @R.query(text, name=name)
    def run(s):
        entry = lambda k: F.concat(k, F.lit("="), F.coalesce(F.col("context")[k], F.lit("")))
        context = F.array_join(F.transform(F.array_sort(F.map_keys("context")), entry), ",").alias("details")
        return of(s).select("rule", "subject", *(["message"] if fixed else []), *([context] if details else []))


rule(
    "v1_no_cycles",
    f"""with recursive {EDGES}, e as (select distinct parent_meter_id as a, child_meter_id as b, coalesce(valid_from, date '0001-01-01') as lo, coalesce(valid_to, date '9999-12-31') as hi from bad_edges),
    p as (select a as start, b as z, [a, b] as path, lo, hi from e where a <= b and lo < hi
          union all select p.start, e.b, list_append(p.path, e.b), greatest(p.lo, e.lo), least(p.hi, e.hi) from p join e on e.a = p.z
          where p.z <> p.start and (e.b = p.start or (e.b > p.start and not list_contains(p.path, e.b))) and greatest(p.lo, e.lo) < least(p.hi, e.hi))
    select 'no_cycles' as rule, array_to_string(path[1:len(path) - 1], '->') as subject from p where z = start
    qualify row_number() over (partition by start order by len(path), path) = 1""",
    lambda s: op.no_cycles(edges_of(s)),
    "concat('length=', len(path) - 1)",
)
rule("v2_feeds_requires_k", f"with {EDGES} select 'feeds_requires_flow_coefficient' as rule, {EDGE} as subject from bad_edges where relation_type = 'feeds' and flow_coefficient is null", lambda s: op.feeds_requires_coefficient(edges_of(s)))
rule("v3_feeds_k_positive", f"with {EDGES} select 'feeds_flow_coefficient_positive' as rule, {EDGE} as subject from bad_edges where relation_type = 'feeds' and flow_coefficient <= 0", lambda s: op.feeds_coefficient_positive(edges_of(s)), "concat('coefficient=', flow_coefficient)")
rule(
    "v4_feeds_sum_to_one",
    f"with {EDGES} select 'feeds_flow_coefficients_sum_to_one' as rule, parent_meter_id as subject from bad_edges where relation_type = 'feeds' and flow_coefficient is not null group by 2 having abs(sum(flow_coefficient) - 1) > 1e-9",
    lambda s: op.feeds_sum_to_one(edges_of(s)),
)
rule("v5_sub_k_range", f"with {EDGES} select 'hassubmeter_flow_coefficient_out_of_range' as rule, {EDGE} as subject from bad_edges where relation_type = 'hasSubMeter' and (flow_coefficient <= 0 or flow_coefficient > 1)", lambda s: op.sub_coefficient_range(edges_of(s)), "concat('coefficient=', flow_coefficient)")


def dataset(s):
    some = lambda df, key, skip: df.where(~F.col(key).isin(skip))
    return {
        "campuses": some(s.campuses, "campus_id", ["C2"]), "buildings": some(s.buildings, "building_id", ["B3", "B4"]), "zones": some(s.zones, "zone_id", ["Z6_1"]),
        "media_types": some(s.media_types, "media_type_id", ["water"]), "meters": some(s.meters, "meter_id", ["M8", "M21"]), "meter_relations": s.relations, "meter_measures": s.measures,
        "sensors": some(s.sensors, "sensor_id", ["S5", "S5b"]), "timeseries_refs": s.refs, "devices": some(s.devices, "device_id", ["V7"]),
        "databases": s.spark.sql("select 'D1' as database_id, 'other' as name, 'internal' as kind, '' as identifier"),
    }


def _gone(name: str, table: str, column: str, known: str, where: str = "true") -> str:
    return f"select 'referential_integrity' as rule, concat('{name}.{column} ', {column}) as subject from {table} where {column} is not null and {column} not in (select {known}) and {where}"


rule(
    "v6_referential_integrity",
    "with c as (select campus_id as k from campuses where campus_id <> 'C2'), b as (select building_id as k, campus_id from buildings where building_id not in ('B3', 'B4')), z as (select zone_id as k, building_id from zones where zone_id <> 'Z6_1'),"
    " m as (select * from meters where meter_id not in ('M8', 'M21')), sn as (select * from sensors where sensor_id not in ('S5', 'S5b')), dv as (select device_id as k from devices where device_id <> 'V7') "
    + " union all ".join(
        [
            _gone("meters", "m", "building_id", "k from b"), _gone("meters", "m", "media_type_id", "media_type_id from media_types where media_type_id <> 'water'"), _gone("buildings", "b", "campus_id", "k from c"),
            _gone("zones", "z", "building_id", "k from b"), _gone("meter_relations", "relations", "parent_meter_id", "meter_id from m"), _gone("meter_relations", "relations", "child_meter_id", "meter_id from m"),
            _gone("meter_measures", "measures", "meter_id", "meter_id from m"), _gone("meter_measures", "measures", "target_id", "k from z", "target_kind = 'zone'"),
            _gone("meter_measures", "measures", "target_id", "k from b", "target_kind = 'building'"), _gone("meter_measures", "measures", "target_id", "k from c", "target_kind = 'campus'"),
            _gone("sensors", "sn", "meter_id", "meter_id from m"), _gone("timeseries_refs", "refs", "sensor_id", "sensor_id from sn"), _gone("timeseries_refs", "refs", "database_id", "'D1'"), _gone("timeseries_refs", "refs", "device_id", "k from dv"),
        ]
    ),
    lambda s: op.referential_integrity(dataset(s)),
)
rule("v7_one_preferred_ref", f"with {REFS} select 'exactly_one_preferred_ref' as rule, sensor_id as subject from bad_refs group by 2 having sum(preferred::int) <> 1", lambda s: op.one_preferred_ref(refs_of(s)), "concat('n=', sum(preferred::int))")
OVER = "(a.valid_to is null or b.valid_from is null or b.valid_from < a.valid_to) and (b.valid_to is null or a.valid_from is null or a.valid_from < b.valid_to)"
rule(
    "v8_validity_overlap",
    f"""with {EDGES}, n as (select *, row_number() over (partition by parent_meter_id, child_meter_id, relation_type order by valid_from nulls first, valid_to nulls first, flow_coefficient nulls first) as i from bad_edges)
    select 'validity_non_overlapping' as rule, concat(a.parent_meter_id, '->', a.child_meter_id) as subject from n a join n b using (parent_meter_id, child_meter_id, relation_type) where a.i < b.i and {OVER}""",
    lambda s: op.validity_non_overlapping(edges_of(s)),
    "concat('first=', cast(a.valid_from as varchar), ',second=', cast(b.valid_from as varchar))",
)
rule("v9_ref_kind", f"with {REFS} select 'ref_kind_invalid' as rule, timeseries_id as subject from bad_refs where kind not in ('raw', 'derived')", lambda s: op.ref_kind(refs_of(s)), "concat('kind=', kind)")
rule("v10_raw_missing_address", f"with {REFS} select 'ref_raw_missing_addressing' as rule, timeseries_id as subject from bad_refs where kind = 'raw' and (coalesce(database_id, '') = '' or coalesce(path, '') = '' or coalesce(external_id, '') = '')", lambda s: op.raw_missing_address(refs_of(s)))
rule("v11_raw_has_derived", f"with {REFS} select 'ref_raw_has_derived_fields' as rule, timeseries_id as subject from bad_refs where kind = 'raw' and (sources <> '' or coalesce(aggregation, '') <> '')", lambda s: op.raw_has_derived_fields(refs_of(s)))
rule("v12_derived_undeclared", f"with {REFS} select 'ref_derived_missing_declaration' as rule, timeseries_id as subject from bad_refs where kind = 'derived' and (sources = '' or coalesce(aggregation, '') = '')", lambda s: op.derived_missing_declaration(refs_of(s)))
rule("v13_derived_has_address", f"with {REFS} select 'ref_derived_has_addressing' as rule, concat(timeseries_id, ' database_id') as subject from bad_refs where kind = 'derived' and database_id is not null", lambda s: op.derived_has_address(refs_of(s)), "'field=database_id'")
rule("v14_aggregation_vocabulary", f"with {REFS} select 'ref_aggregation_vocabulary' as rule, timeseries_id as subject from bad_refs where aggregation = 'mean'", lambda s: op.aggregation_vocabulary(refs_of(s)), "concat('aggregation=', aggregation)")
rule(
    "v15_ref_sources",
    f"""with {REFS}, x as (select timeseries_id, unnest(string_split(sources, '|')) as source from bad_refs where sources <> '')
    select case when source = timeseries_id then 'ref_source_self' else 'ref_source_missing' end as rule, concat(timeseries_id, ' ', source) as subject from x
    where source = timeseries_id or source not in (select timeseries_id from bad_refs)""",
    lambda s: op.ref_sources(refs_of(s)),
)
rule(
    "v16_ref_overlap",
    f"""with {REFS}, n as (select *, row_number() over (partition by sensor_id, aggregate, database_id, path order by timeseries_id) as i from bad_refs where kind = 'raw')
    select 'ref_validity_non_overlapping' as rule, a.timeseries_id as subject from n a join n b on a.sensor_id = b.sensor_id and a.aggregate = b.aggregate
    and a.database_id is not distinct from b.database_id and a.path is not distinct from b.path where a.i < b.i and {OVER}""",
    lambda s: op.ref_validity_non_overlapping(refs_of(s)),
    "concat('second=', cast(b.valid_from as varchar))",
)
rule(
    "v17_media_consistency",
    f"with {EDGES} select 'media_consistency' as rule, {EDGE} as subject from bad_edges e join meters p on p.meter_id = parent_meter_id join meters c on c.meter_id = child_meter_id where p.media_type_id <> c.media_type_id",
    lambda s: op.media_consistency(edges_of(s), s.meters),
    "concat('child=', c.media_type_id, ',parent=', p.media_type_id)",
)
rule(
    "v18_orphan_meter",
    "with e as (select * from relations where parent_meter_id not like '%1') select 'orphan_meter' as rule, meter_id as subject from meters where meter_id not in (select parent_meter_id from e) and meter_id not in (select child_meter_id from e)",
    lambda s: op.orphan_meter(s.meters, s.relations.where("parent_meter_id not like '%1'")),
)
