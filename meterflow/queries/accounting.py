"""Queries A1-A9, Q8, Q9 and Q16-Q18."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import accounting as op
from meterflow.operators import annotations as an
from meterflow.queries.registry import Registry

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

# parents that lose nothing, a steady share, or all
BALANCE = """edges as (select parent_meter_id as parent, child_meter_id as child, flow_coefficient as coefficient from relations where derived_from = 'tree'),
    own as (select meter_id, month, case when cast(substr(meter_id, 2) as int) >= 40 then delta when cast(substr(meter_id, 2) as int) % 7 = 3 then 0 else delta * 4 end as delta from meter_monthly
            where not (meter_id like 'M%9' and month = '2024-02')),
    months as (select distinct month from own),
    kids as (select e.parent, m.month, coalesce(o.delta, 0.0) as d from edges e cross join months m left join own o on o.meter_id = e.child and o.month = m.month),
    per as (select parent, month, sum(d) as children, count(*) as n_children, count(*) filter (d = 0) as dead_children from kids group by 1, 2),
    cons as (select p.parent, p.month, coalesce(o.delta, 0.0) as delta, children, coalesce(o.delta, 0.0) - children as residual,
             case when coalesce(o.delta, 0.0) > 0.01 then 100 * (coalesce(o.delta, 0.0) - children) / coalesce(o.delta, 0.0) end as residual_pct, n_children, dead_children
             from per p left join own o on o.meter_id = p.parent and o.month = p.month)"""


def edges_of(s):
    return s.relations.where("derived_from = 'tree'").select(F.col("parent_meter_id").alias("parent"), F.col("child_meter_id").alias("child"), F.col("flow_coefficient").alias("coefficient"))


def own_of(s):
    n = F.expr("cast(substr(meter_id, 2) as int)")
    delta = F.when(n >= 40, F.col("delta")).when(n % 7 == 3, 0.0).otherwise(F.col("delta") * 4)
    return s.meter_monthly.where("not (meter_id like 'M%9' and month = '2024-02')").withColumn("delta", delta)


def conserved_of(s):
    return op.monthly_conservation(edges_of(s), own_of(s))


@R.query(f"with {BALANCE} select * from cons")
def a1_monthly_conservation(s):
    return conserved_of(s)


FLAGS = f"""{BALANCE}, j as (select *, abs(residual_pct - lag(residual_pct) over (partition by parent order by month)) as jump from cons where residual_pct is not null),
    st as (select parent, avg(residual_pct) as mean, stddev_pop(residual_pct) as sd, max(jump) as jump, bool_and(abs(residual_pct - 100) < 5) as dead from j group by 1),
    flags as (select p.parent, case when mean is null then 'no_data' when dead then 'dead_children' when abs(mean) < 5 and sd < 5 then 'clean' when sd < 5 and mean between 5 and 50 then 'losses_stable'
              when coalesce(jump, 0) > 20 then 'swap_event' when sd > 10 then 'drift_seasonal' else 'review' end as flag from (select distinct parent from cons) p left join st using (parent))"""


@R.query(f"with {FLAGS} select * from flags")
def a2_classify_conservation(s):
    return op.classify_conservation(conserved_of(s))


@R.query(f"with {FLAGS} select flag, parent, count(*) over (partition by flag) as n from flags")
def a3_flag_breakdown(s):
    return op.flag_breakdown(op.classify_conservation(conserved_of(s)))


# terms: every meter in the formula of its number mod 20, some unmapped or silent
TERMS = """terms as (select concat('B', u % 20) as building, cast(u % 2 as int) as row, case when u % 3 = 2 then '-' else '+' end as sign, concat('M', u) as meter_id from users),
    walk as (select concat('M', u) as key, case when u % 16 = 9 then concat('S', u) else concat('M', u) end as id from users where u % 17 <> 3),
    v as (select meter_id as id, month, sum(delta) as d from meter_monthly where not (month = '2024-03' and meter_id like 'M1%') group by 1, 2), months as (select distinct month from v),
    bal as (select t.building, t.row, m.month, coalesce(sum(case when t.sign = '+' then v.d else -v.d end), 0.0) as sum, count(*) filter (t.sign = '+') as n_add, count(*) filter (t.sign = '-') as n_sub,
            bool_or(v.d is not null) as any_data from terms t cross join months m left join walk w on w.key = t.meter_id left join v on v.id = w.id and v.month = m.month group by 1, 2, 3)"""


def terms_of(s):
    u = F.col("u")
    return s.users.select(F.concat(F.lit("B"), u % 20).alias("building"), (u % 2).cast("int").alias("row"), F.when(u % 3 == 2, "-").otherwise("+").alias("sign"), F.concat(F.lit("M"), u).alias("meter_id"))


def walk_of(s):
    u = F.col("u")
    return s.users.where("u % 17 <> 3").select(F.concat(F.lit("M"), u).alias("key"), F.when(u % 16 == 9, F.concat(F.lit("S"), u)).otherwise(F.concat(F.lit("M"), u)).alias("id"))


def values_of(s):
    return s.meter_monthly.where("not (month = '2024-03' and meter_id like 'M1%')")


def balance_of(s):
    return op.accounting_balance(terms_of(s), walk_of(s), values_of(s))


@R.query(f"with {TERMS} select * from bal")
def a4_accounting_balance(s):
    return balance_of(s)


@R.query(f"""with {TERMS}, st as (select building, count(*) filter (sum < -0.01) as neg, avg(sum) as m, stddev_pop(sum) as sd from bal where any_data group by 1),
    f as (select building, concat_ws(' ', case when neg > 0 then concat('negative_month×', neg) end, case when m > 0 and sd / m * 100 > 120 then 'erratic' end, case when m < 0.1 then 'near_zero' end) as flags from st)
    select building, case when flags = '' then 'ok' else flags end as flags from f""")
def a5_accounting_flags(s):
    return op.accounting_flags(balance_of(s))


@R.query(f"""with {TERMS} select distinct meter_id, 'silent' as problem from terms join walk on key = meter_id where id not in (select id from v)
    union all select distinct meter_id, 'no_crosswalk' from terms where meter_id not in (select key from walk)""")
def a6_silent_meters(s):
    return op.silent_meters(terms_of(s), walk_of(s), values_of(s))


# formulas F0..F39 of meters; some terms are formulas of smaller numbers, some names lead nowhere
FORMULAS = """formulas as (
    select concat('F', u % 40) as building, cast(floor(u / 40.0) as int) as position, case when u % 3 = 2 then '-' else '+' end as sign,
           case when u % 40 >= 10 and u % 7 = 0 then concat('F', u % 40 - 10) when u % 23 = 0 then concat('gone', u) else concat('M', u) end as meter_id,
           case when u % 4 = 0 then 0.5e0 else 1.0e0 end as faktor from users),
    v as (select meter_id, month, sum(delta) as value from meter_monthly group by 1, 2), months as (select distinct month from v),
    walk as (select building, month, meter_id, case when sign = '+' then faktor else -faktor end as k, [concat(case when sign = '+' then '0' else '1' end, printf('%06d', position))] as path, 0 as depth from formulas cross join months
             union all select w.building, w.month, f.meter_id, w.k * case when f.sign = '+' then f.faktor else -f.faktor end, list_append(w.path, concat(case when f.sign = '+' then '0' else '1' end, printf('%06d', f.position))), w.depth + 1
             from walk w join formulas f on f.building = w.meter_id left join v on v.meter_id = w.meter_id and v.month = w.month where v.value is null and w.depth < 4),
    leaf as (select w.*, case when w.depth < 4 then v.value end as value from walk w left join v on v.meter_id = w.meter_id and v.month = w.month
             where w.depth = 4 or v.value is not null or w.meter_id not in (select building from formulas)),
    evaluated as (select building, month, case when count(*) filter (value is null) = 0 then sum(k * value) end as value, arg_min(meter_id, path) filter (value is null) as unresolved from leaf group by 1, 2)"""


def formulas_of(s):
    u = F.col("u")
    meter = F.when((u % 40 >= 10) & (u % 7 == 0), F.concat(F.lit("F"), u % 40 - 10)).when(u % 23 == 0, F.concat(F.lit("gone"), u)).otherwise(F.concat(F.lit("M"), u))
    return s.users.select(
        F.concat(F.lit("F"), u % 40).alias("building"), F.floor(u / 40.0).cast("int").alias("position"), F.when(u % 3 == 2, "-").otherwise("+").alias("sign"), meter.alias("meter_id"),
        F.when(u % 4 == 0, 0.5).otherwise(1.0).alias("faktor"),
    )


def evaluated_of(s):
    return op.evaluate_formulas(formulas_of(s), s.meter_monthly.withColumnRenamed("delta", "value"))


@R.query(f"with recursive {FORMULAS} select * from evaluated")
def a7_evaluate_formulas(s):
    return evaluated_of(s)


# the same meters and formulas under drifted names: dashes, VM for VMM, an energy suffix
DRIFT = "case when {0} like 'M%' then concat('B', substr({0}, 2), case when length({0}) % 2 = 0 then '-VP1-VM61' else '.VP1_VM61_E' end) when {0} like 'F%' then concat({0}, '-KB2') else {0} end"


@R.query(f"with recursive {FORMULAS} select concat(building, '-KB2') as building, month, value, {DRIFT.format('unresolved')} as unresolved from evaluated")
def a7_resolve_names(s):
    t = formulas_of(s).withColumn("building", F.concat("building", F.lit("-KB2"))).withColumn("meter_id", F.expr(DRIFT.format("meter_id")))
    t = t.withColumn("meter_id", F.when(F.col("meter_id").like("F%"), F.replace(F.replace("meter_id", F.lit("-"), F.lit(".")), F.lit("KB2"), F.lit("KB2_E"))).otherwise(F.col("meter_id")))
    walk = s.meter_monthly.select(F.concat(F.lit("B"), F.expr("substr(meter_id, 2)"), F.lit(".VP1_VMM61")).alias("key"), F.col("meter_id").alias("id")).distinct()
    out = op.evaluate_formulas(t, s.meter_monthly.withColumnRenamed("delta", "value"), walk)
    return out.withColumn("unresolved", F.replace("unresolved", F.lit(".KB2_E"), F.lit("-KB2")))


CHECKED = f"""{FORMULAS}, rep as (select building, month, case when building like '%3' then value * 2 when building like '%4' then 0 else value + 3 end as reported from evaluated where building not like '%5'),
    checked as (select e.building, e.month, r.reported, e.value as computed, e.value - r.reported as delta, case when abs(r.reported) > 0.1 then (e.value - r.reported) / r.reported * 100 end as delta_pct
                from evaluated e left join rep r on r.building = e.building and r.month = e.month)"""


def checked_of(s):
    e = evaluated_of(s).select("building", "month", "value")
    b = F.col("building")
    rep = e.where("building not like '%5'").withColumn("value", F.when(b.like("%3"), F.col("value") * 2).when(b.like("%4"), 0.0).otherwise(F.col("value") + 3))
    return op.spot_check(e, rep)


@R.query(f"with recursive {CHECKED} select *, coalesce(abs(delta) > 5 and (delta_pct is null or abs(delta_pct) > 10), false) as flagged from checked")
def a8_spot_check(s):
    return checked_of(s)


@R.query(f"with recursive {CHECKED} select month, sum(reported) as reported, sum(computed) as computed, sum(computed) - sum(reported) as delta from checked where delta is not null group by 1")
def a8_spot_totals(s):
    return op.spot_totals(checked_of(s))


@R.query("""with v as (select meter_id, case when cast(substr(meter_id, 2) as int) % 2 = 0 then 'heat' else 'el' end as media, month, delta as value from meter_monthly
        union all select meter_id, 'water', month, delta + 7 from meter_monthly where meter_id like 'M%1'),
    t1 as (select u, concat('B', u % 20) as building, case when u % 40 < 20 then 'water' else 'heat' end as media, case when u % 3 = 2 then '-' else '+' end as sign, concat('M', u) as meter_id, case when u % 4 = 0 then 0.5e0 else 1.0e0 end as faktor from users),
    t as (select *, u * 2 as position from t1 union all select *, u * 2 + 1 from t1 where u % 6 = 0),
    m as (select distinct month from v), p as (select t.*, m.month, (select arg_min(v.value, concat(case when v.media = t.media then '0' else '1' end, v.media)) from v where v.meter_id = t.meter_id and v.month = m.month) as value from t cross join m),
    c as (select building, media, month, sum((case when sign = '+' then 1.0 else -1.0 end) * faktor * coalesce(value, 0.0)) * 2 as computed from p group by 1, 2, 3),
    r as (select building_id as building, 'water' as media, month, case when building_id = 'B2' then 0 else value end as reported from reported
          union all select building, media, month, computed + case when building like '%3' then 0.5 else 0 end from c where media = 'heat')
    select r.building, r.media, r.month, r.reported, c.computed, abs(c.computed - r.reported) < 0.001 as ok from r join c using (building, media, month) where r.reported <> 0""")
def a9_formula_check(s):
    u, n = F.col("u"), F.expr("cast(substr(meter_id, 2) as int)")
    v = s.meter_monthly.select("meter_id", F.when(n % 2 == 0, "heat").otherwise("el").alias("media"), "month", F.col("delta").alias("value"))
    v = v.unionByName(s.meter_monthly.where("meter_id like 'M%1'").select("meter_id", F.lit("water").alias("media"), "month", (F.col("delta") + 7).alias("value")))
    t = s.users.select(
        "u", F.concat(F.lit("B"), u % 20).alias("building"), F.when(u % 40 < 20, "water").otherwise("heat").alias("media"), F.when(u % 3 == 2, "-").otherwise("+").alias("sign"),
        F.concat(F.lit("M"), u).alias("meter_id"), F.when(u % 4 == 0, 0.5).otherwise(1.0).alias("faktor"),
    )
    # terms that stand twice in their formula
    t = t.withColumn("position", u * 2).unionByName(t.where(u % 6 == 0).withColumn("position", u * 2 + 1))
    r = s.reported.select(F.col("building_id").alias("building"), F.lit("water").alias("media"), "month", F.when(F.col("building_id") == "B2", 0.0).otherwise(F.col("value")).alias("value"))
    # totals that agree, and some that are off by a half
    best = F.min_by("value", F.struct((F.col("vm") != F.col("media")).cast("int"), "vm"))
    each = t.where("media = 'heat'").join(v.withColumnRenamed("media", "vm"), "meter_id").groupBy("building", "media", "month", "position", "sign", "faktor").agg(best.alias("value"))
    total = F.sum(F.when(F.col("sign") == "+", 1.0).otherwise(-1.0) * F.col("faktor") * F.col("value")) * 2
    sums = each.groupBy("building", "media", "month").agg(total.alias("value")).withColumn("value", F.col("value") + F.when(F.col("building").like("%3"), 0.5).otherwise(0.0))
    return op.formula_check(t, v, r.unionByName(sums), unit_factor=2.0)


DIFFS = """o as (select concat('B', n_nationkey) as b, case when n_nationkey % 6 = 1 then '2024-02' end as month, case when n_nationkey % 6 = 1 then 'month override' else 'building override' end as reason from nation where n_nationkey % 6 in (1, 3)),
    both_sides as (select coalesce(r.building_id, c.building_id) as building_id, coalesce(r.month, c.month) as month, coalesce(r.value, 0.0) as reported, coalesce(c.value, 0.0) as computed
        from (select building_id, month, case when building_id = 'B4' then value * 1.001 else value end as value from reported) r full join computed c on r.building_id = c.building_id and r.month = c.month),
    reasons as (select d.building_id, d.month, d.reported, d.computed, computed - reported as diff, case when reported = 0 and computed = 0 then 'match' when reported > 0 and abs((computed - reported) / reported * 100) < 0.25 then 'match'
        when reported = 0 and abs(computed - reported) < 10 then 'match' when d.building_id not in (select building_id from meters where building_id is not null and building_id <> 'B9') and reported > 0 and computed = 0 then 'campus_attributed'
        when m.reason is not null then m.reason when x.reason is not null then x.reason else 'ontology_drift' end as reason
        from both_sides d left join o m on m.b = d.building_id and m.month = d.month left join o x on x.b = d.building_id and x.month is null)"""


def reasons_of(s):
    n = F.expr("cast(substr(building_id, 2) as int)")
    o = s.buildings.where(n.isin(*range(25)) & (n % 6).isin(1, 3)).select(
        "building_id", F.when(n % 6 == 1, "2024-02").alias("month"), F.when(n % 6 == 1, "month override").otherwise("building override").alias("reason"), F.lit("known").alias("explanation")
    )
    rep = s.reported.withColumn("value", F.when(F.col("building_id") == "B4", F.col("value") * 1.001).otherwise(F.col("value")))
    metered = s.meters.where("building_id is not null and building_id <> 'B9'").select("building_id")
    return op.classify_diffs(rep, s.computed, metered, o)


@R.query(f"with {DIFFS} select * from reasons")
def q8_classify_diffs(s):
    return reasons_of(s).drop("explanation")


@R.query(f"with {DIFFS} select 'site' as workstream, reason, count(*) as n from reasons group by 2")
def q9_reason_counts(s):
    return op.reason_counts(reasons_of(s), F.lit("site"))


TARGETS = """targets as (
    select a.annotation_id, m.meter_id, m.building_id from annotations a join meters m on a.target_kind = 'meter' and m.meter_id = a.target_id
    union select a.annotation_id, m.meter_id, a.target_id from annotations a left join meters m on m.building_id = a.target_id where a.target_kind = 'building'
    union select a.annotation_id, m.meter_id, b.building_id from annotations a join buildings b on b.campus_id = a.target_id left join meters m on m.building_id = b.building_id where a.target_kind = 'campus'
    union select a.annotation_id, m.meter_id, m.building_id from annotations a join refs r on a.target_kind = 'timeseries' and r.timeseries_id = a.target_id join sensors sn on sn.sensor_id = r.sensor_id join meters m on m.meter_id = sn.meter_id)"""


@R.query(f"""with {TARGETS}, a as (select *, coalesce(valid_from, date '2024-01-03') as s, greatest(coalesce(valid_to, date '2024-01-12'), coalesce(valid_from, date '2024-01-03') + 1) as e from annotations
        where not is_resolved and annotation_id in (select annotation_id from targets where meter_id in (select meter_id from meters where media_type_id = 'el')))
    select annotation_id, category, greatest(s, date '2024-01-03') as starts, least(e, date '2024-01-12') as ends from a where s <= date '2024-01-12' and e >= date '2024-01-03'""")
def q16_annotations_view(s):
    chosen = s.meters.where("media_type_id = 'el'").select("meter_id")
    return an.annotations_view(s.annotations, s.meters, s.buildings, s.sensors, s.refs, chosen, "2024-01-03", "2024-01-12", resolved=False)


@R.query(f"with {TARGETS} select * from targets")
def q17_annotation_targets(s):
    return an.resolve_targets(s.annotations, s.meters, s.buildings, s.sensors, s.refs)


@R.query("""select meter_id, 'not_yet_online' as band, date '2024-01-03' as starts, least(valid_from, date '2024-01-28') as ends from meters where valid_from > date '2024-01-03'
    union all select meter_id, 'retired', greatest(valid_to, date '2024-01-03'), date '2024-01-28' from meters where valid_to < date '2024-01-28'""")
def q18_validity_gaps(s):
    return an.validity_gaps(s.meters, "2024-01-03", "2024-01-28")
