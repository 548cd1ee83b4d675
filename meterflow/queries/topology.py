"""Queries T1-T22."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterflow.operators import topology as op
from meterflow.plans.components import connected_components
from meterflow.plans.stage import staged
from meterflow.queries.registry import Registry
from meterflow.sources.reports import building_id_of

R = Registry()
QUERIES, ORACLES = R.queries, R.oracles

# meter names with every shape that is parsed, and some that are not
NAMES = """names as (
    select u, concat('B', cast(floor(u / 6.0) as int) + 100, case when u % 11 = 0 then 'N' else '' end, case when u % 13 = 12 then '-' else '.' end,
           case u % 6 when 0 then 'VP1' when 1 then 'VS1' when 2 then 'VÅ9' when 3 then 'VP2' when 4 then 'VS2' else 'Å1' end,
           case when u % 13 = 12 then '-' else '_' end, case when u % 5 = 0 then 'VM' else 'VMM' end, 61 + u % 4, case when u % 7 = 0 then '_E' else '' end) as meter_id,
           case when u % 2 = 0 then 'drawing' else 'accounts' end as source from users
    union all select u, concat('B', cast(floor(u / 6.0) as int) + 100, '.VP1_VMM', 62 + u % 3), 'accounts' from users where u % 6 = 0
    union all select u, concat('loose ', u), 'accounts' from users where u % 25 = 0)"""
ID = r"^(B\\d+[A-Z]?)\\.([A-ZÅÄÖ]+\\d*)_VM{1,2}(\\d+)(_E)?$".replace("\\\\", "\\")


def canon(c: str) -> str:
    return f"case when regexp_matches({c}, '{ID}') then concat(regexp_extract({c}, '{ID}', 1), '.', regexp_extract({c}, '{ID}', 2), '_VMM', regexp_extract({c}, '{ID}', 3)) else {c} end"


MEDIA = "case when {0} in ('VP1','VP2','VP3','VS1','VS2','VÅ9','VÅ2') then 'värme' when {0} = 'Å1' then 'ånga' else 'unknown' end"
PARSED = f"""{NAMES}, parsed as (select distinct meter_id, {canon("meter_id")} as canonical_id, regexp_replace(regexp_replace(regexp_extract(meter_id, '{ID}', 1), '^B', ''), '[NSEW]+$', '') as building,
    regexp_extract(meter_id, '{ID}', 2) as role, cast(regexp_extract(meter_id, '{ID}', 3) as int) as vmm_index, regexp_extract(meter_id, '{ID}', 4) <> '' as is_energy,
    {MEDIA.format(f"regexp_extract(meter_id, '{ID}', 2)")} as media from names where regexp_matches(meter_id, '{ID}'))"""


def names_of(s):
    u = F.col("u")
    role = F.get(F.array(*map(F.lit, ("VP1", "VS1", "VÅ9", "VP2", "VS2", "Å1"))), (u % 6).cast("int"))
    b = F.concat(F.lit("B"), F.floor(u / 6.0).cast("int") + 100)
    dash = u % 13 == 12
    name = F.concat(b, F.when(u % 11 == 0, "N").otherwise(""), F.when(dash, "-").otherwise("."), role, F.when(dash, "-").otherwise("_"), F.when(u % 5 == 0, "VM").otherwise("VMM"), 61 + u % 4, F.when(u % 7 == 0, "_E").otherwise(""))
    one = s.users.select("u", name.alias("meter_id"), F.when(u % 2 == 0, "drawing").otherwise("accounts").alias("source"))
    two = s.users.where("u % 6 = 0").select("u", F.concat(b, F.lit(".VP1_VMM"), 62 + u % 3).alias("meter_id"), F.lit("accounts").alias("source"))
    return one.unionByName(two).unionByName(s.users.where("u % 25 = 0").select("u", F.concat(F.lit("loose "), u).alias("meter_id"), F.lit("accounts").alias("source")))


def loose(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '_E$', ''), '\\.([0-9A-Za-z_À-ÖØ-öø-ÿ]+?)_VM([0-9]+)$', '.\\1_VMM\\2')"


DOTTED = "case when contains(meter_id, '-') and not contains(meter_id, '.') then concat(split_part(meter_id, '-', 1), '.', replace(substr(meter_id, strpos(meter_id, '-') + 1), '-', '_')) else meter_id end"


@R.query(f"""with {NAMES}, d as (select distinct meter_id, {DOTTED} as m from (select meter_id from names union all select concat('B', u, case when u % 2 = 0 then '-KB2' else '.X_E' end) from users) x)
    select meter_id, {canon("meter_id")} as plain, {loose("meter_id")} as loose, {loose("m")} as dashed from d""")
def t1_canonical_meter_id(s):
    m = F.col("meter_id")
    more = s.users.select(F.concat(F.lit("B"), "u", F.when(F.col("u") % 2 == 0, "-KB2").otherwise(".X_E")).alias("meter_id"))
    ids = names_of(s).select("meter_id").union(more).distinct()
    return ids.select("meter_id", op.canonical_meter_id(m).alias("plain"), op.canonical_meter_id(m, "any").alias("loose"), op.canonical_meter_id(m, "dashes").alias("dashed"))


@R.query(f"with {PARSED} select * from parsed")
def t2_parse_meter_id(s):
    return op.parse_meter_id(names_of(s).select("meter_id").distinct())


ROLES = f"""{PARSED}, roles as (select canonical_id, min(building) as building, min(role) as role, min(vmm_index) as vmm_index, bool_or(is_energy) as has_energy, min(media) as media,
    string_agg(distinct meter_id, '|' order by meter_id) as variants, string_agg(distinct source, '|' order by source) as sources from parsed join (select distinct meter_id, source from names) n using (meter_id) group by 1)"""


@R.query(f"with {ROLES} select * from roles")
def t3_meter_roles(s):
    return op.meter_roles(names_of(s))


@R.query(f"with {NAMES} select distinct meter_id from names where not regexp_matches(meter_id, '{ID}')")
def t3_unparsable(s):
    return op.unparsable(names_of(s))


NAMING = f"""{ROLES}, m as (select canonical_id as meter_id, building, role, vmm_index from roles),
    firsts as (select building, role, arg_min(meter_id, concat(printf('%06d', vmm_index), meter_id)) as from_meter from m group by 1, 2),
    feeds as (select 'VP1' as p, 'VS1' as c union all select 'VP1', 'VS2' union all select 'VP1', 'VÅ9' union all select 'VP2', 'VÅ9' union all select 'VS1', 'VÅ9'),
    by_role as (select f.from_meter, m.meter_id as to_meter, 'naming_role_hierarchy' as derived_from from firsts f join feeds r on r.p = f.role join m on m.building = f.building and m.role = r.c),
    by_index as (select meter_id as from_meter, next as to_meter, 'naming_index_chain' as derived_from from (
        select *, lead(meter_id) over w as next, lead(vmm_index) over w - vmm_index as step from m window w as (partition by building, role order by vmm_index, meter_id)) x where step <= 2)"""


def roles_of(s):
    return op.meter_roles(names_of(s)).withColumnRenamed("canonical_id", "meter_id")


@R.query(f"with {NAMING} select * from by_role")
def t4_role_edges(s):
    return op.role_edges(roles_of(s))


@R.query(f"with {NAMING} select * from by_index")
def t5_index_chain(s):
    return op.index_chain_edges(roles_of(s))


@R.query(f"with {NAMING} select from_meter, to_meter, max(derived_from) as derived_from from (select * from by_role union all select * from by_index) x group by 1, 2")
def t6_naming_edges(s):
    return op.naming_edges(roles_of(s))


TERMS = f"""{PARSED}, terms as (select concat('', u % 30) as building, cast(u as int) as position, case when cast(floor(u / 3.0) as int) % 3 = 2 then 'sub' else 'add' end as role, meter_id,
        case when u % 4 = 1 then 0.5e0 when u % 4 = 2 then cast(null as double) else 1.0e0 end as faktor from names where source = 'accounts'),
    ct as (select building, position, role, {canon("meter_id")} as meter_id, coalesce(faktor, 1.0) as faktor from terms),
    bucketed as (select *, case when meter_id like '%.VP1_%' then 0 when regexp_matches(meter_id, '\\.VP\\d*_') then 1 when regexp_matches(meter_id, '\\.VS\\d*_') then 2 when regexp_matches(meter_id, '\\.Å\\d*_') then 3 else 4 end as b from ct where role = 'add'),
    inlets as (select building, arg_min(meter_id, o) as inlet, arg_min(faktor, o) as factor from (
        select *, concat(b, printf('%06d', case when b = 4 then 0 else coalesce(try_cast(regexp_extract(meter_id, 'VMM(\\d+)', 1) as int), 999) end), printf('%09d', position)) as o from bucketed) x group by 1),
    acc as (select i.inlet as from_meter, t.meter_id as to_meter, t.building, regexp_extract(i.inlet, '\\.([A-ZÅÄÖ]+\\d*)_', 1) as inlet_role, case when abs(t.faktor - 1) > 1e-9 then t.faktor else i.factor end as coefficient
            from ct t join inlets i on i.building = t.building where t.role = 'sub' and t.meter_id <> i.inlet)"""


def terms_of(s):
    u = F.col("u")
    faktor = F.when(u % 4 == 1, 0.5).when(u % 4 == 2, None).otherwise(1.0)
    return names_of(s).where("source = 'accounts'").select((u % 30).cast("string").alias("building"), u.cast("int").alias("position"), F.when(F.floor(u / 3.0) % 3 == 2, "sub").otherwise("add").alias("role"), "meter_id", faktor.alias("faktor"))


@R.query(f"with {TERMS} select * from inlets")
def t7_principal_inlet(s):
    return op.principal_inlet(terms_of(s).withColumn("meter_id", op.canonical_meter_id(F.col("meter_id"))), "VP1")


@R.query(f"""with {TERMS}, known as (select distinct canonical_id as id from parsed where vmm_index <> 63)
    select *, case when from_meter not in (select id from known) then 'unknown inlet' when to_meter not in (select id from known) then 'unknown child' end as dropped from acc""")
def t8_accounting_edges(s):
    known = op.parse_meter_id(names_of(s)).where("vmm_index <> 63").select(F.col("canonical_id").alias("meter_id"))
    return op.accounting_edges(terms_of(s), "VP1", known)


def candidates_of(s):
    """Edges of three layers: the tree, reversed edges, second parents and repeats."""
    e = s.relations.select(F.col("parent_meter_id").alias("p"), F.col("child_meter_id").alias("c"), F.expr("cast(substr(child_meter_id, 2) as int)").alias("u"), "derived_from")
    u = F.col("u")
    a = e.where(u % 4 != 1).select("p", "c", (u * 10 + F.when(F.col("derived_from") == "tree", 0).otherwise(5)).alias("rank"))
    b = e.where((u % 5 == 2) & (F.col("derived_from") == "tree")).select(F.col("c").alias("p"), F.col("p").alias("c"), (u * 10 - 17).alias("rank"))
    c = e.where("derived_from = 'tree'").select(F.concat(F.lit("M"), (u * 7) % 40).alias("p"), "c", (u + 100_000).alias("rank"))
    return a.unionByName(b).unionByName(c).where("p <> c").groupBy("rank").agg(F.min("p").alias("from_meter"), F.min("c").alias("to_meter"))


CU = "cast(substr(child_meter_id, 2) as int)"
CANDIDATES = f"""ce as (select parent_meter_id as p, child_meter_id as c, {CU} as u, derived_from as d from relations),
    cl as (select p, c, u * 10 + case when d = 'tree' then 0 else 5 end as rank from ce where u % 4 <> 1
           union all select c, p, u * 10 - 17 from ce where u % 5 = 2 and d = 'tree' union all select concat('M', u * 7 % 40), c, u + 100000 from ce where d = 'tree'),
    cand as (select rank, min(p) as f, min(c) as t from cl where p <> c group by 1),
    turn as (select *, row_number() over (order by rank) as i from cand),
    state as (select cast(0 as bigint) as i, cast([] as varchar[]) as kept, cast([] as varchar[]) as kids, cast(null as bigint) as rank, cast(null as varchar) as f, cast(null as varchar) as t, false as accepted
        union all select n.i, case when n.ok then list_append(n.kept, concat(n.f, '>', n.t)) else n.kept end, case when n.ok then list_append(n.kids, n.t) else n.kids end, n.rank, n.f, n.t, n.ok
        from (select x.i, s.kept, s.kids, x.rank, x.f, x.t, not list_contains(s.kids, x.t) and not list_contains(s.kept, concat(x.t, '>', x.f)) as ok from state s join turn x on x.i = s.i + 1) n)"""


@R.query(f"with recursive {CANDIDATES} select f as from_meter, t as to_meter, rank, accepted from state where i > 0")
def t9_merge_candidates(s):
    return op.merge_candidates(candidates_of(s))


@R.query(f"""with recursive {CANDIDATES}, m as (select *, concat('L', rank % 10) as source from state where i > 0), k as (select * from m where accepted)
    select m.f as from_meter, m.t as to_meter, m.rank, case when r.f is not null then 'reverse-direction' else 'child already has parent' end as reason, m.source as dropped, coalesce(r.source, k.source) as kept
    from m left join k r on r.f = m.t and r.t = m.f and r.rank < m.rank left join k on k.t = m.t where not m.accepted and not exists (select 1 from k x where x.f = m.f and x.t = m.t)""")
def t9_dropped_candidates(s):
    c = staged(candidates_of(s).withColumn("source", F.concat(F.lit("L"), F.col("rank") % 10)), "candidates")
    return op.dropped_candidates(c, op.merge_candidates(c))


def overrides_of(s):
    u = F.col("u")
    action = F.when(u % 3 == 0, "add").when(u % 3 == 1, "remove").otherwise("force_direction")
    up = F.floor((u - 1) / 4.0)
    row = lambda df, a, f, t, p: df.select(a.alias("action"), F.concat(F.lit("M"), f).alias("from_meter"), F.concat(F.lit("M"), t).alias("to_meter"), F.when(u % 2 == 0, 0.5).alias("coefficient"), F.lit("why").alias("reason"), F.lit("2024-01-02").alias("date"), F.lit("me").alias("author"), p.alias("position"))
    one = row(s.users.where("u > 0 and u % 2 = 1"), action, up, u, u * 10)
    two = row(s.users.where("u > 0 and u % 5 = 2"), F.lit("force_direction"), u, up, u * 10 + 1)
    three = row(s.users.where("u > 0 and u % 7 = 3"), F.lit("add"), up, u, u * 10 + 2)
    return one.unionByName(two).unionByName(three)


def tree_of(s):
    return s.relations.where("derived_from = 'tree' and child_meter_id not like '%7'").select(F.col("parent_meter_id").alias("from_meter"), F.col("child_meter_id").alias("to_meter"), F.coalesce("flow_coefficient", F.lit(1.0)).alias("coefficient"), "derived_from")


OVERRIDES = f"""ou as (select u, cast(floor((u - 1) / 4.0) as bigint) as up, case when u % 2 = 0 then 0.5e0 end as k from users where u > 0),
    ov as (select case u % 3 when 0 then 'add' when 1 then 'remove' else 'force_direction' end as action, up as f, u as t, k, u * 10 as position from ou where u % 2 = 1
           union all select 'force_direction', u, up, k, u * 10 + 1 from ou where u % 5 = 2 union all select 'add', up, u, k, u * 10 + 2 from ou where u % 7 = 3),
    opair as (select action, k, position, concat('M', f) as f, concat('M', t) as t, least(concat('M', f), concat('M', t)) as x, greatest(concat('M', f), concat('M', t)) as y from ov),
    oturn as (select *, f = x as forward, row_number() over (partition by x, y order by position) as i from opair),
    otree as (select parent_meter_id as f, child_meter_id as t, coalesce(flow_coefficient, 1.0) as k, derived_from as d from relations where derived_from = 'tree' and child_meter_id not like '%7'),
    start as (select x, y, max(k) filter (f = x) as xk, max(d) filter (f = x) as xd, max(k) filter (f <> x) as yk, max(d) filter (f <> x) as yd
        from (select x, y, null as f, null as k, null as d from opair union select least(f, t), greatest(f, t), f, k, d from otree) z group by 1, 2),
    fold as (select x, y, xk, xd, yk, yd, cast(0 as bigint) as i, cast(null as bigint) as position, cast(null as varchar) as result from start
        union all select x, y, case when forward then hk2 else bk2 end, case when forward then hd2 else bd2 end, case when forward then bk2 else hk2 end, case when forward then bd2 else hd2 end, i, position, result
        from (select *, case when action = 'add' and hk is null then coalesce(k, 1.0) when action = 'remove' or action = 'force_direction' and hk is not null then null else hk end as hk2,
                case when action = 'add' and hk is null then tag when action = 'remove' or action = 'force_direction' and hk is not null then null else hd end as hd2,
                case when action = 'force_direction' and hk is not null then hk else bk end as bk2, case when action = 'force_direction' and hk is not null then concat(tag, ' [was ', hd, ']') else bd end as bd2,
                case action when 'add' then case when hk is null then 'applied' else 'skipped (edge already present)' end
                    when 'remove' then case when hk is null then 'error (edge not present to remove)' else concat('applied (removed ', hd, ')') end
                    else case when hk is not null then 'applied (flipped edge)' when bk is not null then 'skipped (edge already in forced direction)' else 'error (no edge between these meters)' end end as result
            from (select o.*, 'override_2024-01-02_me' as tag, case when forward then xk else yk end as hk, case when forward then xd else yd end as hd,
                    case when forward then yk else xk end as bk, case when forward then yd else xd end as bd from fold g join oturn o on o.x = g.x and o.y = g.y and o.i = g.i + 1) w) v)"""


@R.query(f"""with recursive {OVERRIDES}, final as (select * from fold qualify row_number() over (partition by x, y order by i desc) = 1)
    select x as from_meter, y as to_meter, xk as coefficient, xd as derived_from from final where xk is not null union all select y, x, yk, yd from final where yk is not null""")
def t10_apply_overrides(s):
    return op.apply_overrides(tree_of(s), overrides_of(s))[0]


@R.query(f"with recursive {OVERRIDES} select position, result from fold where i > 0")
def t10_override_audit(s):
    return op.apply_overrides(tree_of(s), overrides_of(s))[1]


VIRT = f"""{TERMS}, vt as (select concat('B', building, '.heat_BUILDING') as virtual, building, role, meter_id, faktor from ct)"""


@R.query(f"""with {VIRT} select meter_id, building, meter_type from (select distinct virtual as meter_id, building, 'virtual' as meter_type from vt) x where meter_id <> 'B3.heat_BUILDING'""")
def t11_virtual_meters(s):
    have = s.spark.sql("select 'B3.heat_BUILDING' as meter_id")
    return op.building_virtuals(terms_of(s), "heat", have, tree_of(s))[0]


@R.query(f"""with {VIRT}, e as (select case when role = 'add' then meter_id else virtual end as from_meter, case when role = 'add' then virtual else meter_id end as to_meter, faktor as coefficient, concat('building_virtual_B', building) as derived_from from vt)
    select from_meter, to_meter, min(coefficient) as coefficient, min(derived_from) as derived_from from e where from_meter not like 'loose 25%' group by 1, 2""")
def t11_virtual_edges(s):
    none = s.spark.sql("select 'x' as meter_id")
    edges = terms_of(s).where("meter_id like 'loose 25%'").select(F.col("meter_id").alias("from_meter"), F.concat(F.lit("B"), "building", F.lit(".heat_BUILDING")).alias("to_meter"))
    return op.building_virtuals(terms_of(s), "heat", none, edges)[1]


@R.query(f"""with {TERMS}, e as (select *, case when to_meter like '%62' then 'feeds' end as relation_type, case when building = '7' then 'building_virtual_B7' else 'accounts' end as derived_from from acc)
    select from_meter as parent_meter_id, to_meter as child_meter_id, k as relation_type, case when k = 'feeds' then coefficient end as flow_coefficient from (
        select *, coalesce(relation_type, case when abs(coefficient - 1) > 1e-9 and abs(coefficient - 0.001) > 1e-9 then 'feeds' else 'hasSubMeter' end) as k from e where derived_from not like 'building_virtual%') x""")
def t12_relation_type(s):
    e = op.accounting_edges(terms_of(s), "VP1").withColumn("relation_type", F.when(F.col("to_meter").like("%62"), "feeds"))
    return op.relation_type_of(e.withColumn("derived_from", F.when(F.col("building") == "7", "building_virtual_B7").otherwise("accounts")))


@R.query("""select concat('M', u) as meter_id, concat('M', u) as name, case when u % 6 <> 0 then concat('B', u % 25) end as building_id, 'el' as media_type_id, u % 8 = 1 as is_virtual_meter,
    concat_ws('; ', case when u % 3 <> 0 then concat('register:X', u) end, case when u % 4 = 0 then concat('label:L', u) end) as identifier from users where u % 9 <> 4""")
def t13_meters_out(s):
    u = F.col("u")
    rows = s.users.select(
        F.concat(F.lit("M"), u, F.when(u % 9 == 4, "_BUILDING").otherwise("")).alias("meter_id"), F.when(u % 6 != 0, (u % 25).cast("string")).otherwise("").alias("building"), F.when(u % 8 == 1, "virtual").otherwise("real").alias("meter_type"),
        F.when(u % 3 != 0, F.concat(F.lit("X"), u)).alias("register_id"), F.when(u % 4 == 0, F.concat(F.lit("L"), u)).otherwise("").alias("label"),
    )
    return op.meters_out(rows, "el")


@R.query(f"""with {TERMS} select concat('B', building) as building_id, cast(position as int) as formula_row, case when role = 'add' then '+' else '-' end as sign, role, meter_id, faktor from ct where building <> '9'""")
def t14_allocations_out(s):
    t = terms_of(s).withColumn("row", F.col("position"))
    label = F.when(F.col("building") == "9", "Summa 9").otherwise(F.concat(F.col("building"), F.lit(" (T)")))
    return op.allocations_out(t, building_id_of(label))


# sixty meters share a building; every fifth meter has lost its edge
FIT = """fe as (select parent_meter_id as p, child_meter_id as c from relations where derived_from = 'tree' and cast(substr(child_meter_id, 2) as int) % 5 <> 3),
    fv as (select meter_id, month, case when cast(substr(meter_id, 2) as int) < 15 then delta * 6 else delta end as delta from meter_monthly),
    kids as (select p, month, sum(delta) as k from fe join fv on meter_id = c group by 1, 2),
    resid as (select v.meter_id as p, v.month, v.delta - coalesce(k, 0) as r from fv v left join kids k on k.p = v.meter_id and k.month = v.month where v.meter_id in (select p from fe)),
    enough as (select p from resid group by 1 having count(*) >= 4),
    alone as (select * from fv where meter_id not in (select p from fe) and meter_id not in (select c from fe)),
    fits as (select r.p, a.meter_id as o, count(*) as months, sum(abs(r)) as before_, sum(abs(r - a.delta)) as after_ from resid r join alone a on a.month = r.month
             and floor(cast(substr(r.p, 2) as int) / 60.0) = floor(cast(substr(a.meter_id, 2) as int) / 60.0) where r.p in (select p from enough) group by 1, 2),
    ok as (select *, (before_ - after_) / before_ as gain from fits where months >= 4 and before_ >= 5 and (before_ - after_) / before_ >= 0.05)"""


@R.query(f"with {FIT} select p as from_meter, o as to_meter, gain as improvement, months from (select *, row_number() over (partition by o order by gain desc, p) as rn from ok) x where rn = 1")
def t15_residual_fit(s):
    n = lambda c: F.expr(f"cast(substr({c}, 2) as int)")
    e = s.relations.where("derived_from = 'tree'").where(n("child_meter_id") % 5 != 3).select(F.col("parent_meter_id").alias("from_meter"), F.col("child_meter_id").alias("to_meter"))
    v = s.meter_monthly.withColumn("delta", F.when(n("meter_id") < 15, F.col("delta") * 6).otherwise(F.col("delta")))
    b = s.meters.select("meter_id", F.floor(n("meter_id") / 60.0).alias("building"))
    return op.residual_fit(e, v, b, min_months=4, threshold=0.05)


SOURCED = f"""{NAMING}, es as (select from_meter, to_meter, 'naming' as source from by_role union all select to_meter, from_meter, 'drawing' from by_role where hash_even(to_meter) union all select from_meter, to_meter, 'accounts' from by_index
    union all select from_meter, to_meter, 'drawing' from by_index where hash_even(from_meter))""".replace("hash_even(to_meter)", "length(to_meter) % 2 = 0 and to_meter like '%1'").replace("hash_even(from_meter)", "from_meter like '%2'")


def sourced_of(s):
    role, chain = op.role_edges(roles_of(s)), op.index_chain_edges(roles_of(s))
    src = lambda df, name: df.select("from_meter", "to_meter", F.lit(name).alias("source"))
    back = role.where("length(to_meter) % 2 = 0 and to_meter like '%1'").select(F.col("to_meter").alias("from_meter"), F.col("from_meter").alias("to_meter"))
    return src(role, "naming").unionByName(src(back, "drawing")).unionByName(src(chain, "accounts")).unionByName(src(chain.where("from_meter like '%2'"), "drawing"))


@R.query(f"""with {SOURCED}, g as (select least(from_meter, to_meter) as x, greatest(from_meter, to_meter) as y, string_agg(distinct case when from_meter <= to_meter then source end, '|' order by case when from_meter <= to_meter then source end) as forward,
        string_agg(distinct case when from_meter > to_meter then source end, '|' order by case when from_meter > to_meter then source end) as backward, count(distinct source) as n from es group by 1, 2)
    select x, y, case when forward is not null and backward is not null then 'direction_conflict' when n >= 2 then 'confirmed' else 'source_only' end as status, coalesce(forward, '') as forward, coalesce(backward, '') as backward from g""")
def t16_source_conflicts(s):
    return op.source_conflicts(sourced_of(s))


@R.query(f"""with {SOURCED}, ot as (select distinct {canon("meter_id")} as id, case when cast(floor(u / 3.0) as int) % 3 = 2 then 'sub' else 'add' end as role from names where source = 'accounts'), om as (select distinct {canon("meter_id")} as id from names)
    select id as meter_id, case when id in (select id from ot where role = 'sub') then 'missing_parent' when id in (select id from ot where role = 'add') then 'terminal_leaf' else 'absent' end as verdict
    from om where id not in (select to_meter from es)""")
def t17_orphan_verdict(s):
    return op.orphan_verdict(names_of(s), sourced_of(s), terms_of(s))


AUDIT = """parsed as (select case when u % 5 = 0 then c else p end as f, case when u % 5 = 0 then p else c end as t from te where u % 7 <> 0 union all select concat('M', u), concat('M', u + 1) from users where u % 11 = 0)"""
TE = "te as (select parent_meter_id as p, child_meter_id as c, cast(substr(child_meter_id, 2) as int) as u from relations where derived_from = 'tree')"


@R.query(f"""with {TE}, {AUDIT}, absent as (select p, c from te except select f, t from parsed), flipped as (select p, c from absent where exists (select 1 from parsed where f = c and t = p))
    select p as from_meter, c as to_meter, 'flipped' as status from flipped union all select p, c, 'missed' from (select p, c from absent except select p, c from flipped) x
    union all select f, t, 'extra' from (select f, t from parsed except select p, c from te except select c, p from flipped) y""")
def t18_edge_audit(s):
    u = F.expr("cast(substr(c, 2) as int)")
    te = s.relations.where("derived_from = 'tree'").select(F.col("parent_meter_id").alias("p"), F.col("child_meter_id").alias("c")).withColumn("u", u)
    flip = F.col("u") % 5 == 0
    parsed = te.where("u % 7 <> 0").select(F.when(flip, F.col("c")).otherwise(F.col("p")).alias("from_meter"), F.when(flip, F.col("p")).otherwise(F.col("c")).alias("to_meter"))
    more = s.users.where("u % 11 = 0").select(F.concat(F.lit("M"), "u").alias("from_meter"), F.concat(F.lit("M"), F.col("u") + 1).alias("to_meter"))
    return op.edge_audit(parsed.unionByName(more), te.select(F.col("p").alias("from_meter"), F.col("c").alias("to_meter")))


# an undirected graph of several trees with some rings
GRAPH = """ge as (select parent_meter_id as a, child_meter_id as b from relations where cast(substr(child_meter_id, 2) as int) not in (1, 2, 3, 7, 11, 19)),
    gb as (select a, b from ge union select b, a from ge), comp as (select a as id, a as c from (select distinct a from gb) x union select gb.b, comp.c from comp join gb on gb.a = comp.id),
    components as (select id, min(c) as component from comp group by 1)"""


def graph_of(s):
    return s.relations.where("cast(substr(child_meter_id, 2) as int) not in (1, 2, 3, 7, 11, 19)").select(F.col("parent_meter_id").alias("a"), F.col("child_meter_id").alias("b"))


@R.query(f"with recursive {GRAPH} select * from components")
def t19_components(s):
    return connected_components(graph_of(s), "a", "b")


ROOTS = f"""{GRAPH}, mt as (select id from components where id not like '%0'), deg as (select a as id, count(distinct b) as degree from gb where a <> b group by 1),
    arrows as (select distinct a as id from ge where a like '%4' and a not in (select b from ge where a like '%4')),
    ranked as (select c.component, m.id, case when m.id in ('M8', 'M30') then 0 when m.id in (select id from arrows) then 1 else 2 end as rank, coalesce(degree, 0) as degree from mt m join components c on c.id = m.id left join deg d on d.id = m.id),
    roots as (select component, id as root, case rank when 0 then 'explicit' when 1 then 'arrow' else 'auto_root_degree' end as why from (
        select *, row_number() over (partition by component order by rank, case when rank = 2 then -degree else 0 end, id) as rn from ranked) x where rn = 1)"""


def roots_of(s):
    g = graph_of(s)
    meters = g.select(F.col("a").alias("meter_id")).union(g.select("b")).distinct().where("meter_id not like '%0'")
    directed = g.where("a like '%4'").select(F.col("a").alias("up"), F.col("b").alias("down"))
    return op.component_roots(g, meters, s.spark.sql("select explode(array('M8', 'M30')) as meter_id"), directed)


@R.query(f"with recursive {ROOTS} select * from roots")
def t20_component_root(s):
    return roots_of(s)


TREE = f"""{ROOTS}, levels as (select root as id, root, 0 as depth from roots union select gb.b, l.root, l.depth + 1 from levels l join gb on gb.a = l.id where l.depth < 40),
    depths as (select id, root, min(depth) as depth from levels group by 1, 2),
    tree as (select d.id, (select min(p.id) from depths p join gb on gb.a = p.id and gb.b = d.id where p.root = d.root and p.depth = d.depth - 1) as parent, d.root, d.depth from depths d)"""


@R.query(f"with recursive {TREE} select id, parent, root, cast(depth as int) as depth from tree")
def t21_bfs_parents(s):
    return op.bfs_parents(graph_of(s), roots_of(s))


@R.query(f"""with recursive {TREE}, up as (select id, parent as at from tree where id not like '%0' union all select up.id, t.parent from up join tree t on t.id = up.at where up.at like '%0')
    select up.at as up, up.id as meter_id, t.root from up join tree t on t.id = up.id where up.at is not null and up.at not like '%0'""")
def t21_nearest_upstream(s):
    tree = op.bfs_parents(graph_of(s), roots_of(s))
    return op.nearest_upstream(tree, tree.select(F.col("id").alias("meter_id")).where("meter_id not like '%0'"))


# known ids: drifted names of each kind, some in another building or of another quantity
KNOWN = """case u % 8 when 0 then lower(replace(meter_id, '.', ' ')) when 1 then replace(meter_id, '_E', '') when 2 then concat(meter_id, '_V') when 3 then replace(meter_id, 'VMM', 'VM')
    when 4 then concat('B999.', {rest}) when 5 then concat({b}, 'Z.', {rest}) when 6 then meter_id else concat('none', u) end"""
B_SQL = "concat('B', cast(floor(u / 6.0) as int) + 100)"
NORM, TAIL = "lower(regexp_replace({0}, '[^A-Za-z0-9]', '', 'g'))", "lower(regexp_replace(regexp_replace({0}, '^B[0-9]+[A-Z]?[^0-9A-Za-z]+', ''), '[^A-Za-z0-9]', '', 'g'))"
SUFFIXES = ["concat(id, '" + x + "')" for x in ("_E", "_V", "-S", "-1", "_1_1", "-A1", "-B1")] + ["case when id like '%\\_E' escape '\\' or id like '%\\_V' escape '\\' then substr(id, 1, length(id) - 2) end"]
FORMS = [r"regexp_replace(id, 'VMM([0-9])', 'VM\1', 'g')", r"regexp_replace(id, 'VM([0-9])', 'VMM\1', 'g')", r"regexp_replace(id, '^([^-]*)-', '\1.')", "regexp_replace(id, '-[0-9]+-', '-', 'g')", "replace(id, '-', '_')", "replace(id, '_', '-')"]
PLAIN = [(0, "{0}"), (1, NORM), (4, "concat(building, '|', " + TAIL + ")"), (5, TAIL)]
WANT_KEYS = " union all ".join(f"select id, quantity, {r} as rank, {k} as key from w" for r, k in [(r, k.format("id")) for r, k in PLAIN] + [(2, k) for k in SUFFIXES] + [(3, k) for k in FORMS])
HAVE_KEYS = " union all ".join(f"select m, quantity, {r} as rank, {k} as key from k" for r, k in [(r, k.format("m")) for r, k in [*PLAIN, (2, "{0}"), (3, "{0}")]])


@R.query(f"""with {NAMES}, w as (select distinct meter_id as id, {B_SQL} as building, case when u % 9 <> 1 then 'q' end as quantity from names),
    k as (select distinct {KNOWN.format(rest="regexp_extract(meter_id, '^[^.-]*[.-](.*)$', 1)", b=B_SQL)} as m, case when u % 8 = 4 then 'B999' else {B_SQL} end as building, case when u % 8 = 6 then 'r' else 'q' end as quantity from names),
    wk as ({WANT_KEYS}), hk as ({HAVE_KEYS}),
    hit as (select wk.id, coalesce(wk.quantity <> hk.quantity, false) as other, wk.rank, hk.m from wk join hk on hk.rank = wk.rank and hk.key = wk.key where wk.key <> '')
    select id, m as match, case when other then 'other_quantity' else ['exact', 'normalised', 'suffix', 'transformed', 'tail_in_building', 'tail'][rank + 1] end as rule
    from hit qualify row_number() over (partition by id order by other, rank, m) = 1""")
def t22_match_ids(s):
    n, q = names_of(s), F.when(F.col("u") % 9 != 1, "q")
    m = F.expr(KNOWN.format(rest="regexp_extract(meter_id, '^[^.-]*[.-](.*)$', 1)", b=B_SQL))
    wanted = n.select(F.col("meter_id").alias("id"), F.expr(B_SQL).alias("building"), q.alias("quantity")).distinct()
    place = F.when(F.col("u") % 8 == 4, "B999").otherwise(F.expr(B_SQL))
    return op.match_ids(wanted, n.select(m.alias("meter_id"), place.alias("building"), F.when(F.col("u") % 8 == 6, "r").otherwise("q").alias("quantity")).distinct())
