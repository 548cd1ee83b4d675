"""Queries E1-E18."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import registers as op
from meterflow.queries.registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles


def register_of(s):
    return s.register.where("quantity = 'energy'")


@R.query("select *, v_last - v_first as delta, v_last - v_first < 0 as is_reset from register where quantity = 'energy'")
def e1_daily_delta(s):
    return op.daily_delta(register_of(s))


SEGMENTS = """r as (select *, strftime(day, '%Y-%m') as month from register where quantity = 'energy'), f as (
        select *, v_last < v_first - 1e-6 as inside, coalesce(v_first < lag(v_last) over (partition by meter_id, month order by day) - 1e-6, false) as between_ from r), g as (
        select *, sum(case when inside or between_ then 1 else 0 end) over (partition by meter_id, month order by day) as segment from f), p as (
        select meter_id, month, segment, arg_max(v_last, day) - arg_min(v_first, day) as d, count(*) as n, count(*) filter (abs(v_last - v_first) < 1e-9) as zero,
               sum(inside::int + between_::int) as reset, min(day) as a, max(day) as b from g group by 1, 2, 3)"""


@R.query(f"""with {SEGMENTS} select meter_id, month, sum(case when d >= 0 then d else 0.0 end) as delta, cast(sum(n) as bigint) as n_days, cast(sum(zero) as bigint) as zero_days,
    cast(sum(reset) as bigint) as reset_days, min(a) as first_day, max(b) as last_day from p group by 1, 2""", name="e2_monthly_delta")  # fmt: skip
def _monthly(s):
    return op.monthly_register_delta(register_of(s))


@R.query(f"""with {SEGMENTS} select month, cast(sum(zero) as bigint) as zero_days, cast(sum(reset) as bigint) as reset_days, cast(sum(n) as bigint) as n_days from p group by 1""")
def e3_month_statistics(s):
    return op.monthly_register_delta(register_of(s)).groupBy("month").agg(*(F.sum(c).alias(c) for c in ("zero_days", "reset_days", "n_days")))


@R.query("select distinct meter_id, 'no_readings' as flag, '' as detail from listed where meter_id not in (select meter_id from timeseries_daily)")
def e4_no_readings(s):
    return op.no_readings(s.listed, s.timeseries_daily)


# some registers that never move, or move rarely
QUIET = """quiet as (select meter_id, day, v_first, case when cast(substr(meter_id, 2) as int) % 6 = 0 then v_first
    when cast(substr(meter_id, 2) as int) % 6 = 1 and day(day) % 3 <> 0 then v_first when cast(substr(meter_id, 2) as int) % 6 = 2 and day(day) > 18 then v_first else v_last end as v_last, n_readings
    from timeseries_daily), q as (select *, v_last - v_first as delta, v_last - v_first < 0 as is_reset from quiet)"""


def quiet_of(s):
    n, d = F.expr("cast(substr(meter_id, 2) as int) % 6"), F.dayofmonth("day")
    still = (n == 0) | ((n == 1) & (d % 3 != 0)) | ((n == 2) & (d > 18))
    rows = s.timeseries_daily.select("meter_id", "day", "v_first", F.when(still, F.col("v_first")).otherwise(F.col("v_last")).alias("v_last"), "n_readings")
    return op.daily_delta(rows)


@R.query(f"with {QUIET} select meter_id, 'flat_all_window' as flag, '' as detail from q group by 1 having sum(greatest(delta, 0)) = 0")
def e5_flat_all_window(s):
    return op.flat_all_window(quiet_of(s))


@R.query("select meter_id, 'reset_days' as flag, string_agg(cast(day as varchar), ',' order by day) as detail from timeseries_daily where is_reset group by 1")
def e6_reset_days(s):
    return op.reset_days(s.timeseries_daily)


@R.query(f"""with {QUIET}, m as (select meter_id, count(*) filter (abs(delta) < 1e-9) as z, count(*) as n, sum(greatest(delta, 0)) as t from q group by 1)
    select meter_id, 'mostly_zero' as flag, concat(z, '/', n) as detail from m where z > 0.5 * n and t > 0""")
def e7_mostly_zero(s):
    return op.mostly_zero(quiet_of(s))


@R.query("""with m as (select meter_id, count(*) as n, date_diff('day', min(day), max(day)) + 1 as span from timeseries_daily group by 1)
    select meter_id, 'coverage_gap' as flag, concat(n, '/', span) as detail from m where n < span""")
def e8_coverage_gap(s):
    return op.coverage_gap(s.timeseries_daily)


EVENTS = f"""{QUIET}, a as (select *, coalesce(sum(case when delta > 0.1 then 1 else 0 end) over (partition by meter_id order by day rows between 1 following and 14 following), 0) as active from q),
    resets as (select meter_id, day as swap_date, case when active < 3 then 'offline' when v_first between 970000 and 1000000 or v_first between 9700000 and 10000000 or v_first between 97000000 and 100000000
               then 'rollover' else 'swap' end as event_type, v_first as old_last_value from a where is_reset),
    act as (select meter_id, max(day) as last_active from q where delta <> 0 group by 1),
    frozen as (select q.meter_id, min(q.day) as swap_date, 'offline' as event_type, arg_min(q.v_last, q.day) as old_last_value from q join act using (meter_id)
               where q.day > last_active group by 1 having count(*) >= 5),
    moved as (select r.meter_id, case when r.event_type = 'offline' then least(r.swap_date, coalesce(f.swap_date, r.swap_date)) else r.swap_date end as swap_date, r.event_type, r.old_last_value,
              0 as rank, r.swap_date as was from resets r left join frozen f on f.meter_id = r.meter_id
              union all select *, 1, swap_date from frozen),
    merged as (select meter_id, swap_date, event_type, old_last_value from moved where event_type <> 'offline'
               union all select meter_id, swap_date, event_type, old_last_value from (
                   select *, row_number() over (partition by meter_id order by swap_date, rank, was) as rn from moved where event_type = 'offline') x where rn = 1)"""


@R.query(f"with {EVENTS} select * from resets")
def e9_reset_events(s):
    return op.reset_events(quiet_of(s))


@R.query(f"with {EVENTS} select * from frozen")
def e10_frozen_tail(s):
    return op.frozen_tail(quiet_of(s))


def merged_of(s):
    return op.merge_offline(op.reset_events(quiet_of(s)), op.frozen_tail(quiet_of(s)))


@R.query(f"with {EVENTS} select * from merged")
def e11_merge_offline(s):
    return merged_of(s)


def dipped_of(s):
    # registers that dip for a day or two and come back
    dip = (F.expr("cast(substr(meter_id, 2) as int) % 5") == 3) & (F.dayofmonth("day") % 9 < 2) & (F.dayofmonth("day") > 5)
    return op.daily_delta(quiet_of(s).withColumn("v_last", F.when(dip, 1.0).otherwise(F.col("v_last"))))


BACK = "abs(a{0} - prev) < abs(v_last - prev) * 0.1"


@R.query(f"""with recursive {EVENTS}, dq as (select meter_id, day, case when cast(substr(meter_id, 2) as int) % 5 = 3 and day(day) % 9 < 2 and day(day) > 5 then 1.0 else v_last end as v_last from q),
    dw as (select *, row_number() over w as i, lag(v_last) over w as prev, lead(day) over w as next_day, {", ".join(f"lead(v_last, {k}) over w as a{k}, lead(day, {k}) over w as d{k}" for k in range(1, 7))}
           from dq window w as (partition by meter_id order by day)),
    dk as (select *, case {" ".join(f"when {BACK.format(k)} then {k}" for k in range(1, 6))} end as k, case {" ".join(f"when {BACK.format(k)} then coalesce(d{k + 1}, d{k})" for k in range(1, 6))} end as glitch_end
           from dw where v_last - prev < -100 and next_day is not null),
    df as (select * from dk where k is not null and not exists (select 1 from merged m where m.meter_id = dk.meter_id and m.swap_date = dk.day)),
    dn as (select x.meter_id, x.i, min(y.i) as after from df x left join df y on y.meter_id = x.meter_id and y.i > x.i + x.k group by 1, 2),
    picked as (select meter_id, min(i) as i from df group by 1 union all select p.meter_id, dn.after from picked p join dn on dn.meter_id = p.meter_id and dn.i = p.i where dn.after is not null)
    select df.meter_id, day as swap_date, 'glitch' as event_type, prev as old_last_value, glitch_end from df join picked on picked.meter_id = df.meter_id and picked.i = df.i""")
def e12_glitches(s):
    return op.glitches(dipped_of(s), merged_of(s))


SEG = f"""{EVENTS}, o as (select *, case event_type when 'swap' then 0 when 'rollover' then 1 else 3 end as k from merged),
    l as (select *, lag(k) over w as pk, lag(swap_date) over w as pd, lead(k) over w as nk, row_number() over w as i from o window w as (partition by meter_id order by swap_date, k)),
    s as (select meter_id, i, case when pk is not null then pd end as valid_from, swap_date as valid_to from l where pk is null or pk <> 3
          union all select meter_id, i + 1, swap_date, null from l where nk is null and k <> 3),
    segments as (select meter_id, cast(row_number() over (partition by meter_id order by i) - 1 as int) as position, valid_from, valid_to from s)"""


def segments_of(s):
    return op.segments_from_events(merged_of(s).withColumn("glitch_end", F.lit(None).cast("date")))


@R.query(f"with {SEG} select * from segments")
def e13_segments(s):
    return segments_of(s)


@R.query(f"""with {SEG}, n as (select meter_id, count(*) as n from segments group by 1), m as (select concat('M', u) as facit_id, concat('X', u) as meter_id from users),
    b as (select m.*, coalesce(n.n, 0) as n, g.position, g.valid_from, g.valid_to from m left join n using (meter_id) left join segments g using (meter_id))
    select case when n <= 1 then concat(facit_id, ':d') else concat(facit_id, ':d.', chr(65 + position)) end as timeseries_id, 'raw' as kind, n <= 1 as preferred, valid_from, valid_to,
           meter_id as external_id, '' as sources from b
    union all select concat(facit_id, ':d'), 'derived', true, null, null, null, string_agg(concat(facit_id, ':d.', chr(65 + position)), '|' order by position) from b where n > 1 group by facit_id""")
def e14_refs_from_segments(s):
    meters = s.users.select(F.concat(F.lit("M"), "u").alias("facit_id"), F.concat(F.lit("X"), "u").alias("meter_id"))
    refs = op.refs_from_segments(meters, segments_of(s), "D0", "log")
    return refs.select("timeseries_id", "kind", "preferred", "valid_from", "valid_to", "external_id", F.array_join("sources", "|").alias("sources"))


PATCH = f"""{EVENTS}, down as (select concat('M', substr(meter_id, 2), ':d') as id, min(swap_date) as since from merged where event_type = 'offline' group by 1),
    kids as (select concat(parent_meter_id, ':d') as id, string_agg(concat(child_meter_id, ':d'), '|' order by concat(child_meter_id, ':d')) as children from relations group by 1),
    todo as (select down.id, since, children from down join kids using (id)),
    base as (select concat('M', u, ':d') as timeseries_id, case when u % 4 = 0 then 'derived' else 'raw' end as kind, true as preferred, cast(null as date) as valid_from,
             case when u % 4 = 0 then concat('M', u, ':d.A') else '' end as sources from users)"""


@R.query(f"""with {PATCH} select case when id is not null and kind = 'raw' then concat(timeseries_id, '.raw') else timeseries_id end as timeseries_id, kind,
        preferred and not (id is not null and kind = 'raw') as preferred, valid_from, case when id is not null and kind = 'derived' then concat(sources, '|', timeseries_id, '.patch') else sources end as sources
    from base left join todo on id = timeseries_id
    union all select concat(timeseries_id, '.patch'), 'derived', false, since, children from base join todo on id = timeseries_id
    union all select timeseries_id, 'derived', true, null, concat(timeseries_id, '.raw|', timeseries_id, '.patch') from base join todo on id = timeseries_id where kind = 'raw'""")
def e15_outage_patches(s):
    u = F.col("u")
    own = F.concat(F.lit("M"), u, F.lit(":d"))
    none = F.lit(None).cast("string")
    refs = s.users.select(
        own.alias("timeseries_id"), F.when(u % 4 == 0, "derived").otherwise("raw").alias("kind"), F.lit(True).alias("preferred"), F.lit(None).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"), F.when(u % 4 == 0, F.array(F.concat(own, F.lit(".A")))).otherwise(F.array().cast("array<string>")).alias("sources"), none.alias("aggregation"),
    )
    crosswalk = s.users.select(F.concat(F.lit("X"), u).alias("key"), F.concat(F.lit("M"), u).alias("id"))
    out = op.outage_patches(refs, merged_of(s).where("event_type = 'offline'").select("meter_id", "swap_date"), crosswalk, s.relations)
    return out.select("timeseries_id", "kind", "preferred", "valid_from", F.array_join("sources", "|").alias("sources"))


@R.query("""with m as (select meter_id, min(month) as first, bool_and(delta = 0) as idle from (select meter_id, month, case when length(meter_id) = 2 then 0 else delta end as delta from meter_monthly
        where not (meter_id like 'M_5' and month < '2024-03')) x group by 1)
    select meter_id, case when first > '2024-01' then cast(concat(first, '-01') as date) end as valid_from, case when idle then cast(concat(first, '-01') as date) end as valid_to from m""")
def e16_validity_hint(s):
    rows = s.meter_monthly.where("not (meter_id like 'M_5' and month < '2024-03')")
    return op.meter_validity_hint(rows.withColumn("delta", F.when(F.length("meter_id") == 2, 0.0).otherwise(F.col("delta"))), "2024-01")


@R.query(f"""with {QUIET}, r as (select *, sum(case when delta <> 0 then 1 else 0 end) over (partition by meter_id order by day) as run from q),
    f as (select meter_id, run, count(*) as n from r where delta = 0 group by 1, 2 having count(*) >= 4),
    p as (select meter_id, quantile_cont(delta, 0.5) as p50, quantile_cont(delta, 0.75) as p75, quantile_cont(delta, 0.99) as p99 from q group by 1)
    select meter_id, 'flat_run' as flag, count(*) as n from f group by 1
    union all select q.meter_id, 'spike', count(*) from q join p on p.meter_id = q.meter_id where delta > greatest(3 * p99, 10 * p50) group by 1
    union all select q.meter_id, 'outlier', count(*) from q join p on p.meter_id = q.meter_id where delta > 10 * p75 group by 1""")
def e17_quality_scan(s):
    return op.quality_scan(quiet_of(s))


@R.query(f"""with {QUIET}, r as (select *, sum(case when delta <> 0 or day(day) not between 4 and 25 then 1 else 0 end) over (partition by meter_id order by day) as run from q),
    f as (select meter_id, run from r where delta = 0 and day(day) between 4 and 25 group by 1, 2 having count(*) >= 4) select meter_id, 'flat_run' as flag, count(*) as n from f group by 1""")
def e17_flat_runs_in_season(s):
    return op.quality_scan(quiet_of(s), active=F.dayofmonth("day").between(4, 25)).where("flag = 'flat_run'")


@R.query("""with d as (select meter_id, day from timeseries_daily where not (meter_id like 'X%3' and day(day) % 2 = 0) and not (meter_id like 'X%4' and day(day) > 12)),
    g as (select meter_id, day, date_diff('day', lag(day) over (partition by meter_id order by day), day) as gap from d),
    m as (select meter_id, median(gap) as gap, max(day) as last from g group by 1)
    select meter_id, 'sparse' as signal from m where gap >= 2
    union all select meter_id, 'offline' from m where date_diff('day', last, date '2024-01-31') > 7
    union all select meter_id, 'unknown_source' from m where meter_id not in (select external_id from refs where timeseries_id not like '%7')""")
def e18_signal_table(s):
    rows = s.timeseries_daily.where("not (meter_id like 'X%3' and day(day) % 2 = 0) and not (meter_id like 'X%4' and day(day) > 12)")
    return op.signal_table(rows, s.refs.where("timeseries_id not like '%7'"), "2024-01-31")


KIN = "kin as (select concat('X', substr(parent_meter_id, 2)) as parent, concat('X', substr(child_meter_id, 2)) as meter_id from relations where derived_from = 'tree')"


@R.query(f"""with {QUIET}, {KIN}, r as (select k.parent, q.meter_id, q.day, q.delta, sum(q.delta) over (partition by k.parent, q.day) as total from q join kin k using (meter_id)),
    z as (select *, delta = 0 and total > 0 as silent from r), n as (select *, sum(case when silent then 0 else 1 end) over (partition by parent, meter_id order by day) as run from z)
    select meter_id, parent, min(day) as starts, max(day) as ends, count(*) as n from n where silent group by meter_id, parent, run having count(*) >= 4""")
def e17_silent_among_siblings(s):
    x = lambda c: F.concat(F.lit("X"), F.expr(f"substr({c}, 2)"))
    kin = s.relations.where("derived_from = 'tree'").select(x("parent_meter_id").alias("parent"), x("child_meter_id").alias("meter_id"))
    return op.silent_among_siblings(quiet_of(s), kin, least=4)


@R.query(f"""with {QUIET}, b as (select *, sum(case when delta = 0 then 1 else 0 end) over (partition by meter_id order by day rows between 2 preceding and 1 preceding) as still from q)
    select cast(substr(meter_id, 2) as int) % 3 as place, day, count(distinct meter_id) as n from b where delta > 0 and still = 2 group by 1, 2 having count(distinct meter_id) >= 3""")
def e17_synchronized_catch_up(s):
    places = s.listed.select("meter_id", F.expr("cast(substr(meter_id, 2) as int) % 3").alias("place"))
    more = s.users.where("u % 4 = 3").select(F.concat(F.lit("X"), "u").alias("meter_id"), (F.col("u") % 3).cast("int").alias("place"))
    return op.synchronized_catch_up(quiet_of(s), places.unionByName(more))


@R.query(f"""with {SEG}, p as (select *, lag(v_last) over (partition by meter_id order by day) as before_ from q)
    select p.meter_id, p.day, abs(v_first - before_) as jump from p join segments g on g.meter_id = p.meter_id and g.valid_from = p.day where g.position > 0 and before_ > 0 and abs(v_first - before_) > 0.01 * before_""")
def e17_stitch_artefacts(s):
    return op.stitch_artefacts(quiet_of(s), segments_of(s))
