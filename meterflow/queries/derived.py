"""Queries D1-D9."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import derived as op
from meterflow.operators.flow import latest_correction
from meterflow.queries.flow import LATEST
from meterflow.queries.registry import Registry
from meterflow.sources.tables import split_list

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

BASE = f"""{LATEST}, base as (select * from latest union all select timeseries_id, timestamp, value, null from parts),
    src as (select timeseries_id, aggregation, valid_from, valid_to, len(string_split(sources, '|')) as n_sources, unnest(range(len(string_split(sources, '|')))) as position,
            unnest(string_split(sources, '|')) as source from derived_refs),
    slices as (select s.timeseries_id, b.timestamp, b.value, b.recorded_at from src s join base b on b.timeseries_id = s.source
               where aggregation = 'slice' and n_sources = 1 and (valid_from is null or valid_from <= b.timestamp) and (valid_to is null or valid_to > b.timestamp)),
    steps as (select s.timeseries_id, s.valid_from, b.timestamp, b.value - lag(b.value) over (partition by s.timeseries_id, s.position order by b.timestamp) as delta
              from src s join base b on b.timeseries_id = s.source where aggregation = 'sum'),
    sums as (select timeseries_id, timestamp, sum(delta) over (partition by timeseries_id order by timestamp) as value from (
             select timeseries_id, timestamp, sum(greatest(delta, 0)) as delta from steps where delta is not null and (valid_from is null or timestamp >= valid_from) group by 1, 2) x),
    ends as (select s.timeseries_id, s.aggregation, s.source, s.valid_from, s.valid_to,
             max(b.timestamp) filter (b.timestamp < s.valid_from) as t_lo, arg_max(b.value, b.timestamp) filter (b.timestamp < s.valid_from) as v_lo,
             min(b.timestamp) filter (b.timestamp >= s.valid_to) as t_hi, arg_min(b.value, b.timestamp) filter (b.timestamp >= s.valid_to) as v_hi
             from src s left join base b on b.timeseries_id = s.source where n_sources = 1 and aggregation in ('bracket', 'interpolate') group by 1, 2, 3, 4, 5),
    brackets as (select e.timeseries_id, b.timestamp, b.value from ends e join base b on b.timeseries_id = e.source
                 where e.aggregation = 'bracket' and b.timestamp >= e.valid_from and b.timestamp < e.valid_to and b.value between least(v_lo, v_hi) and greatest(v_lo, v_hi)),
    days as (select *, unnest(generate_series(valid_from, valid_to - interval 1 day, interval 1 day)) as timestamp, date_diff('day', t_lo, t_hi) as span from ends
             where aggregation = 'interpolate' and v_lo is not null and v_hi is not null),
    lines as (select timeseries_id, cast(timestamp as timestamp) as timestamp, round_even(v_lo + (v_hi - v_lo) * (date_diff('day', t_lo, timestamp) / span), 3) as value from days where span > 0),
    ordered as (select s.timeseries_id, b.timestamp, s.position, b.value as v, lag(b.value) over w as p, lag(s.source) over w = s.source as same
                from src s join base b on b.timeseries_id = s.source where aggregation = 'rolling_sum' window w as (partition by s.timeseries_id order by b.timestamp, s.position)),
    kinds as (select *, case when p is null then 'first' when same then 'same' when p > 0 and abs(v - p) <= 0.01 * p then 'continuous' when v >= p * 0.5 then 'swap'
              when p between 970000 and 1000000 or p between 9700000 and 10000000 or p between 97000000 and 100000000 then 'rollover' when p > 100000 and v < 1000 then 'reset' else 'swap' end as kind from ordered),
    stitched as (select timeseries_id, timestamp, sum(case when kind in ('same', 'continuous') then v - p when kind = 'rollover' then (case when p <= 1e6 then 1e6 when p <= 1e7 then 1e7 else 1e8 end) - p + v
                 when kind = 'swap' then 0 else v end) over (partition by timeseries_id order by timestamp, position) as value, kind from kinds)"""


def refs_of(s):
    return s.derived_refs.withColumn("sources", split_list(F.col("sources")))


def base_of(s):
    return latest_correction(s.readings).unionByName(s.parts, allowMissingColumns=True)


@R.query(f"with {BASE} select * from slices")
def d1_slice(s):
    return op.slices(refs_of(s), base_of(s))


@R.query(f"with {BASE} select * from sums")
def d2_sum(s):
    return op.sums(refs_of(s), base_of(s))


@R.query(f"with {BASE} select timeseries_id, source, valid_from, valid_to, t_lo, v_lo, t_hi, v_hi from ends where aggregation = 'interpolate'")
def d3_endpoints(s):
    return op.endpoints(refs_of(s), base_of(s), "interpolate")


@R.query(f"with {BASE} select * from brackets")
def d4_bracket(s):
    return op.brackets(refs_of(s), base_of(s))


@R.query(f"with {BASE} select * from lines")
def d5_interpolate(s):
    return op.interpolations(refs_of(s), base_of(s))


@R.query(f"with {BASE} select timeseries_id, timestamp, value from stitched")
def d6_rolling_sum(s):
    return op.rolling_sums(refs_of(s), base_of(s)).drop("kind")


@R.query(f"with {BASE} select kind, count(*) as n from stitched group by 1")
def d7_classify_boundary(s):
    return op.rolling_sums(refs_of(s), base_of(s)).groupBy("kind").agg(F.count("*").alias("n"))


@R.query(f"""with {BASE} select timeseries_id, timestamp, value from slices union all select * from sums union all select * from brackets union all select * from lines
    union all select timeseries_id, timestamp, value from stitched""")
def d8_materialize(s):
    return op.materialize(refs_of(s), base_of(s))


# references with faults: two sources, no window, a window that ends before it starts
FAULTY = """faulty as (select timeseries_id, aggregation, case when k % 30 = 2 then null else valid_from end as valid_from, case when k % 35 = 3 then date '2024-01-03' else valid_to end as valid_to,
    case when k % 20 = 0 then concat(sources, '|', sources) else sources end as sources from (select *, cast(regexp_extract(timeseries_id, '[0-9]+', 0) as int) as k from derived_refs) x)"""


@R.query(f"""with {LATEST}, {FAULTY}, one as (select *, len(string_split(sources, '|')) as n from faulty where aggregation in ('slice', 'bracket', 'interpolate')),
    w as (select * from one where n = 1 and aggregation <> 'slice'),
    e as (select w.timeseries_id, w.aggregation, max(b.timestamp) filter (b.timestamp < w.valid_from) as lo, min(b.timestamp) filter (b.timestamp >= w.valid_to) as hi
          from w left join latest b on b.timeseries_id = w.sources where w.valid_from is not null and w.valid_to is not null group by 1, 2)
    select timeseries_id, 'needs one source' as issue from one where n <> 1 union all select timeseries_id, 'needs a window' from w where valid_from is null or valid_to is null
    union all select timeseries_id, 'no anchor' from e where lo is null or hi is null union all select timeseries_id, 'no span' from e where aggregation = 'interpolate' and cast(hi as date) <= cast(lo as date)""")
def d8_issues(s):
    k = F.regexp_extract("timeseries_id", "[0-9]+", 0).cast("int")
    refs = s.derived_refs.select(
        "timeseries_id", "aggregation", F.when(k % 30 != 2, F.col("valid_from")).alias("valid_from"), F.when(k % 35 == 3, F.lit("2024-01-03").cast("date")).otherwise(F.col("valid_to")).alias("valid_to"),
        split_list(F.when(k % 20 == 0, F.concat("sources", F.lit("|"), "sources")).otherwise(F.col("sources"))).alias("sources"),
    )
    return op.issues(refs, latest_correction(s.readings))


# sums that read a slice
STACKED = "stacked as (select concat('N', u) as timeseries_id, concat('M', u, '.x') as source from users where u % 5 = 0)"


@R.query(f"""with {BASE}, {STACKED}, st as (select k.timeseries_id, b.timestamp, b.value - lag(b.value) over (partition by k.timeseries_id order by b.timestamp) as delta from stacked k join slices b on b.timeseries_id = k.source)
    select timeseries_id, timestamp, value from slices union all select timeseries_id, timestamp, sum(greatest(delta, 0)) over (partition by timeseries_id order by timestamp) from st where delta is not null""")
def d8_sums_of_slices(s):
    sliced = refs_of(s).where("aggregation = 'slice'").select("timeseries_id", "aggregation", "valid_from", "valid_to", "sources")
    day = F.lit(None).cast("date")
    stacked = s.users.where("u % 5 = 0").select(F.concat(F.lit("N"), "u").alias("timeseries_id"), F.lit("sum").alias("aggregation"), day.alias("valid_from"), day.alias("valid_to"), F.array(F.concat(F.lit("M"), "u", F.lit(".x"))).alias("sources"))
    return op.materialize(sliced.unionByName(stacked), base_of(s))


# sums over stitched counters and over other sums, and two that need each other
CHAINED = """chained as (
    select timeseries_id, aggregation, valid_from, valid_to, sources from derived_refs where aggregation = 'rolling_sum'
    union all select concat('N', u), 'sum', null, null, concat('M', u, '.x') from users where u % 5 = 4
    union all select concat('O', u), 'sum', null, null, concat('N', u, '|T', u) from users where u % 10 = 4
    union all select concat('Q', u), 'sum', null, null, concat('Q', case when u % 10 = 6 then u + 1 else u - 1 end) from users where u % 10 in (6, 7))"""


def chained_of(s):
    u, day = F.col("u"), F.lit(None).cast("date")
    named = lambda c, n=u: F.concat(F.lit(c), n)

    def sums(where, name, *sources):
        return s.users.where(where).select(name.alias("timeseries_id"), F.lit("sum").alias("aggregation"), day.alias("valid_from"), day.alias("valid_to"), F.array(*sources).alias("sources"))

    rows = refs_of(s).where("aggregation = 'rolling_sum'").select("timeseries_id", "aggregation", "valid_from", "valid_to", "sources")
    rows = rows.unionByName(sums("u % 5 = 4", named("N"), F.concat(F.lit("M"), u, F.lit(".x")))).unionByName(sums("u % 10 = 4", named("O"), named("N"), named("T")))
    return rows.unionByName(sums("u % 10 in (6, 7)", named("Q"), named("Q", F.when(u % 10 == 6, u + 1).otherwise(u - 1))))


SUM_OVER = """select {0} as timeseries_id, timestamp, sum(delta) over (partition by {0} order by timestamp) as value from (
    select {0}, timestamp, sum(greatest(delta, 0)) as delta from (
        select k.{0}, b.timestamp, b.value - lag(b.value) over (partition by k.{0}, k.source order by b.timestamp) as delta from {1} k join {2} b on b.timeseries_id = k.source) d
    where delta is not null group by 1, 2) x"""


@R.query(f"""with {BASE}, ns as (select concat('N', u) as n, concat('M', u, '.x') as source from users where u % 5 = 4), n_rows as ({SUM_OVER.format('n', 'ns', 'stitched')}),
    os as (select concat('O', u) as o, unnest([concat('N', u), concat('T', u)]) as source from users where u % 10 = 4),
    o_base as (select timeseries_id, timestamp, value from n_rows union all select timeseries_id, timestamp, value from base), o_rows as ({SUM_OVER.format('o', 'os', 'o_base')})
    select timeseries_id, timestamp, value from stitched union all select * from n_rows union all select * from o_rows""")
def d8_by_dependency(s):
    return op.materialize(chained_of(s), base_of(s), by_dependency=True)


@R.query(f"""with {CHAINED} select timeseries_id, 'source made later' as issue from chained where timeseries_id like 'N%' or timeseries_id like 'O%' or timeseries_id like 'Q%'""")
def d8_issues_by_kind(s):
    """In the default order a sum over a stitched counter, or over another sum, finds no readings."""
    return op.issues(chained_of(s), base_of(s))


@R.query(f"with {CHAINED} select timeseries_id, 'cycle of sources' as issue from chained where timeseries_id like 'Q%'")
def d8_issues_by_dependency(s):
    return op.issues(chained_of(s), base_of(s), by_dependency=True)


# a full-period series stitched to the parts of another, as well as parts that follow each other
@R.query(f"""with {BASE}, r as (select u, concat('R', u) as timeseries_id, concat('P', u, 'a') as a, concat('P', u, 'b') as b, case when u % 3 = 0 then concat('T', u) end as c from users where u % 5 = 4),
    x as (select timeseries_id, unnest([a, b, c]) as source, unnest([0, 1, 2]) as position from r),
    span as (select timeseries_id as source, min(timestamp) as lo, max(timestamp) as hi from base group by 1), y as (select x.*, lo, hi from x join span using (source))
    select p.timeseries_id, p.source, q.source as source_2 from y p join y q on p.timeseries_id = q.timeseries_id and p.position < q.position where p.lo <= q.hi and q.lo <= p.hi""")
def d6_overlapping_sources(s):
    u, day = F.col("u"), F.lit(None).cast("date")
    part = lambda x: F.concat(F.lit("P"), u, F.lit(x))
    refs = s.users.where("u % 5 = 4").select(
        F.concat(F.lit("R"), u).alias("timeseries_id"), F.lit("rolling_sum").alias("aggregation"), day.alias("valid_from"), day.alias("valid_to"),
        F.when(u % 3 == 0, F.array(part("a"), part("b"), F.concat(F.lit("T"), u))).otherwise(F.array(part("a"), part("b"))).alias("sources"),
    )
    return op.overlapping_sources(refs, base_of(s))


@R.query(f"with {BASE} select timeseries_id, aggregation, valid_from, valid_to, cast(n_sources as int) as n_sources, cast(position as int) as position, source from src")
def d9_explode_sources(s):
    return op.explode_sources(refs_of(s))
