"""Inference and merging of the meter graph."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.plans.components import connected_components
from meterflow.plans.stage import staged

#: Roles of a meter id, and which roles' meters a role's meter feeds in a building.
ROLE_MEDIA = {
    "VP1": "värme", "VP2": "värme", "VP3": "värme", "VS1": "värme", "VS2": "värme", "VÅ9": "värme", "VÅ2": "värme",
    "Å1": "ånga", "KV1": "kallvatten", "VV1": "tappvatten", "VVC1": "tappvatten",
}
ROLE_FEEDS = {"VP1": ("VS1", "VS2", "VÅ9"), "VP2": ("VÅ9",), "VS1": ("VÅ9",)}
#: Building, role, index, energy suffix.
METER_ID = r"^(B\d+[A-Z]?)\.([A-ZÅÄÖ]+\d*)_VM{1,2}(\d+)(_E)?$"


#: Letters, digits and underscores of ids.
_WORD = "[0-9A-Za-z_À-ÖØ-öø-ÿ]"


def canonical_meter_id(meter: Column, scope: str = "parsed") -> Column:
    """The id without the energy suffix _E and with VMM for VM.

    Of scope "parsed" only ids that `METER_ID` parses change; of scope "any" every id does; of scope
    "dashes" an id with dashes and no dot is first read with a dot for the first dash and underscores
    for the others, so that B600-KB2 is B600.KB2.
    """
    if scope == "parsed":
        part = lambda i: F.regexp_extract(meter, METER_ID, i)
        return F.when(meter.rlike(METER_ID), F.concat(part(1), F.lit("."), part(2), F.lit("_VMM"), part(3))).otherwise(meter)
    if scope not in ("any", "dashes"):
        raise ValueError(f"unknown scope {scope!r}")
    m = meter
    if scope == "dashes":
        dotted = F.concat(F.regexp_replace(m, "-.*$", ""), F.lit("."), F.translate(F.regexp_replace(m, "^[^-]*-", ""), "-", "_"))
        m = F.when(m.contains("-") & ~m.contains("."), dotted).otherwise(m)
    return F.regexp_replace(F.regexp_replace(m, "_E$", ""), rf"\.({_WORD}+?)_VM(\d+)$", r".$1_VMM$2")


def parse_meter_id(meters: DataFrame, col: str = "meter_id") -> DataFrame:
    """(meter_id, canonical_id, building, role, vmm_index, is_energy, media) of the ids that can be parsed."""
    part = lambda i: F.regexp_extract(col, METER_ID, i)
    media = F.coalesce(F.create_map(*(F.lit(x) for kv in ROLE_MEDIA.items() for x in kv))[part(2)], F.lit("unknown"))
    return meters.where(F.col(col).rlike(METER_ID)).select(
        F.col(col).alias("meter_id"), canonical_meter_id(F.col(col)).alias("canonical_id"), F.regexp_replace(F.regexp_replace(part(1), "^B", ""), "[NSEW]+$", "").alias("building"),
        part(2).alias("role"), part(3).cast("int").alias("vmm_index"), (part(4) != "").alias("is_energy"), media.alias("media"),
    )


def meter_roles(seen: DataFrame) -> DataFrame:
    """(canonical_id, building, role, vmm_index, has_energy, media, variants, sources) from ids
    (meter_id, source); sets sorted and pipe-joined."""
    p = parse_meter_id(seen.select("meter_id").distinct()).join(seen.select("meter_id", "source").distinct(), "meter_id")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    return p.groupBy("canonical_id").agg(
        F.min("building").alias("building"), F.min("role").alias("role"), F.min("vmm_index").alias("vmm_index"), F.bool_or("is_energy").alias("has_energy"),
        F.min("media").alias("media"), joined("meter_id").alias("variants"), joined("source").alias("sources"),
    )


def unparsable(seen: DataFrame) -> DataFrame:
    return seen.where(~F.col("meter_id").rlike(METER_ID)).select("meter_id").distinct()


def role_edges(meters: DataFrame) -> DataFrame:
    """(from_meter, to_meter, derived_from): in a building, the lowest-index meter of a role feeds all
    meters of the roles below it. meters (meter_id, building, role, vmm_index)."""
    first = meters.groupBy("building", "role").agg(F.min_by("meter_id", F.struct("vmm_index", "meter_id")).alias("from_meter"))
    rules = F.create_map(*(x for k, v in ROLE_FEEDS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    parents = first.select("building", "from_meter", F.explode(rules[F.col("role")]).alias("role"))
    children = meters.select("building", "role", F.col("meter_id").alias("to_meter"))
    return parents.join(children, ["building", "role"]).select("from_meter", "to_meter", F.lit("naming_role_hierarchy").alias("derived_from"))


def index_chain_edges(meters: DataFrame, gap: int = 2) -> DataFrame:
    """Consecutive meters of a building and role whose indices differ by at most `gap`."""
    w = Window.partitionBy("building", "role").orderBy("vmm_index", "meter_id")
    rows = meters.withColumn("to_meter", F.lead("meter_id").over(w)).withColumn("step", F.lead("vmm_index").over(w) - F.col("vmm_index"))
    return rows.where(F.col("step") <= gap).select(F.col("meter_id").alias("from_meter"), "to_meter", F.lit("naming_index_chain").alias("derived_from"))


def naming_edges(meters: DataFrame) -> DataFrame:
    """Role and chain edges; an edge that both give counts as a role edge."""
    both = role_edges(meters).withColumn("rank", F.lit(0)).unionByName(index_chain_edges(meters).withColumn("rank", F.lit(1)))
    return both.groupBy("from_meter", "to_meter").agg(F.min_by("derived_from", "rank").alias("derived_from"))


def principal_inlet(terms: DataFrame, primary_role: str) -> DataFrame:
    """(building, inlet, factor): of a building's + terms (building, position, role, meter_id, faktor)
    the meter of the primary role, else of role VP, VS, Å, else the first; lowest index within these."""
    m = F.col("meter_id")
    bucket = F.when(m.contains(f".{primary_role}_"), 0).when(m.rlike(r"\.VP\d*_"), 1).when(m.rlike(r"\.VS\d*_"), 2).when(m.rlike(r"\.Å\d*_"), 3).otherwise(4)
    index = F.when(bucket == 4, 0).otherwise(F.coalesce(F.regexp_extract(m, r"VMM(\d+)", 1).try_cast("int"), F.lit(999)))
    plus = terms.where("role = 'add'").withColumn("faktor", F.coalesce("faktor", F.lit(1.0)))
    first = F.min_by(F.struct("meter_id", "faktor"), F.struct(bucket, index, "position"))
    return plus.groupBy("building").agg(first.alias("i")).select("building", F.col("i.meter_id").alias("inlet"), F.col("i.faktor").alias("factor"))


def accounting_edges(terms: DataFrame, primary_role: str, known: DataFrame | None = None) -> DataFrame:
    """(from_meter, to_meter, building, inlet_role, coefficient, dropped): inlet -> every - term. The
    coefficient is the child's unless that is 1, then the inlet's. With `known` (meter_id), edges of
    other meters are kept with a reason in `dropped`, which is null for good ones."""
    t = terms.withColumn("meter_id", canonical_meter_id(F.col("meter_id"))).withColumn("faktor", F.coalesce("faktor", F.lit(1.0)))
    rows = t.where("role = 'sub'").join(principal_inlet(t, primary_role), "building").where("inlet <> meter_id")
    k = F.when(F.abs(F.col("faktor") - 1) > 1e-9, F.col("faktor")).otherwise(F.col("factor"))
    role = F.regexp_extract("inlet", r"\.([A-ZÅÄÖ]+\d*)_", 1)
    edges = rows.select(F.col("inlet").alias("from_meter"), F.col("meter_id").alias("to_meter"), "building", role.alias("inlet_role"), k.alias("coefficient"))
    if known is None:
        return edges.withColumn("dropped", F.lit(None).cast("string"))
    ids = known.select(F.col("meter_id").alias("from_meter")).distinct()
    ends = edges.join(ids.withColumn("f", F.lit(1)), "from_meter", "left").join(ids.select(F.col("from_meter").alias("to_meter"), F.lit(1).alias("t")), "to_meter", "left")
    return ends.select(*edges.columns, F.when(F.col("f").isNull(), "unknown inlet").when(F.col("t").isNull(), "unknown child").alias("dropped"))


def merge_candidates(edges: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(from_meter, to_meter, rank, accepted) of candidate edges with distinct ranks: in rank order an
    edge is accepted unless an accepted one has the same child or is its reverse.

    In rounds: edges without an earlier undecided rival are accepted, their rivals dropped. An edge
    is the only rival of its reverse, so the two kinds of conflict are a join on the child and one on
    the pair.
    """
    rest = staged(edges.select("from_meter", "to_meter", "rank"), "undecided")
    done = None
    for _ in range(max_rounds):
        first = F.min("rank").over(Window.partitionBy("to_meter"))
        pair = Window.partitionBy(F.least("from_meter", "to_meter"), F.greatest("from_meter", "to_meter"))
        ahead = rest.withColumn("a", first).withColumn("b", F.min("rank").over(pair))
        win = staged(ahead.where("rank = a and rank = b").select("from_meter", "to_meter", "rank"), "accepted")
        done = win if done is None else done.unionByName(win)
        reverse = win.select(F.col("from_meter").alias("to_meter"), F.col("to_meter").alias("from_meter"))
        left = rest.join(win.select("to_meter"), "to_meter", "left_anti").join(reverse, ["from_meter", "to_meter"], "left_anti")
        rest = staged(left.select("from_meter", "to_meter", "rank"), "undecided")
        if rest.isEmpty():
            return edges.join(done.select("rank", F.lit(True).alias("ok")), "rank", "left").select("from_meter", "to_meter", "rank", F.coalesce("ok", F.lit(False)).alias("accepted"))
    raise RuntimeError(f"undecided edges after {max_rounds} rounds")


def dropped_candidates(edges: DataFrame, merged: DataFrame) -> DataFrame:
    """(from_meter, to_meter, rank, reason, dropped, kept) of the rejected edges that do not merely
    repeat an accepted one, with their own source and the one they yield to: of the accepted edge that
    is their reverse, or else of their child's parent. edges (rank, source), merged of
    `merge_candidates`."""
    rows = merged.join(edges.select("rank", "source"), "rank")
    kept = rows.where("accepted").select("from_meter", "to_meter", "rank", F.col("source").alias("s"))
    out = rows.where("not accepted").join(kept.select("from_meter", "to_meter"), ["from_meter", "to_meter"], "left_anti")
    back = kept.select(F.col("to_meter").alias("from_meter"), F.col("from_meter").alias("to_meter"), F.col("s").alias("reverse"), F.col("rank").alias("r"))
    out = out.join(back, ["from_meter", "to_meter"], "left").join(kept.select("to_meter", F.col("s").alias("parent")), "to_meter", "left")
    flipped = F.coalesce(F.col("r") < F.col("rank"), F.lit(False))
    reason = F.when(flipped, "reverse-direction").otherwise("child already has parent")
    return out.select("from_meter", "to_meter", "rank", reason.alias("reason"), F.col("source").alias("dropped"), F.when(flipped, F.col("reverse")).otherwise(F.col("parent")).alias("kept"))


def _override_state(edges: DataFrame, overrides: DataFrame) -> DataFrame:
    """Per unordered pair (x <= y): fold of its overrides in order over the state of its two
    directions, as structs (coefficient, derived_from) or null."""
    pair = lambda df: df.withColumn("x", F.least("from_meter", "to_meter")).withColumn("y", F.greatest("from_meter", "to_meter"))
    edge = F.struct(F.col("coefficient").cast("double").alias("k"), F.col("derived_from").alias("d"))
    forward = F.col("from_meter") == F.col("x")
    state = pair(edges).groupBy("x", "y").agg(F.first(F.when(forward, edge), ignorenulls=True).alias("xy"), F.first(F.when(~forward, edge), ignorenulls=True).alias("yx"))
    tag = F.concat(F.lit("override_"), F.col("date").cast("string"), F.lit("_"), "author")
    one = F.struct("position", "action", forward.alias("forward"), F.col("coefficient").cast("double").alias("k"), tag.alias("tag"))
    todo = pair(overrides).groupBy("x", "y").agg(F.array_sort(F.collect_list(one)).alias("ops"))
    return state.join(todo, ["x", "y"], "full_outer")


_EDGE = "struct<k:double,d:string>"


def apply_overrides(edges: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(edges, audit) after add, remove and force_direction in the order of `position`.

    edges (from_meter, to_meter, coefficient, derived_from), audit (position, result). Overrides of
    different pairs of meters do not touch each other, so each pair is folded on its own. Missing
    columns raise.
    """
    cols = ["action", "from_meter", "to_meter", "coefficient", "reason", "date", "author", "position"]
    if missing := [c for c in cols if c not in overrides.columns]:
        raise ValueError(f"overrides lack columns: {missing}")
    none = F.lit(None).cast(_EDGE)

    def step(a, o):
        here, back = F.when(o["forward"], a["xy"]).otherwise(a["yx"]), F.when(o["forward"], a["yx"]).otherwise(a["xy"])
        new = F.struct(F.coalesce(o["k"], F.lit(1.0)).alias("k"), o["tag"].alias("d"))
        flipped = F.struct(here["k"].alias("k"), F.concat(o["tag"], F.lit(" [was "), F.coalesce(here["d"], F.lit("?")), F.lit("]")).alias("d"))
        act = o["action"]
        here2 = F.when((act == "add") & here.isNull(), new).when(act == "remove", none).when((act == "force_direction") & here.isNotNull(), none).otherwise(here)
        back2 = F.when((act == "force_direction") & here.isNotNull(), flipped).otherwise(back)
        result = (
            F.when(act == "add", F.when(here.isNull(), "applied").otherwise("skipped (edge already present)"))
            .when(act == "remove", F.when(here.isNull(), "error (edge not present to remove)").otherwise(F.concat(F.lit("applied (removed "), F.coalesce(here["d"], F.lit("?")), F.lit(")"))))
            .when(
                act == "force_direction",
                F.when(here.isNotNull(), "applied (flipped edge)")
                .when(back.isNotNull(), "skipped (edge already in forced direction)")
                .otherwise("error (no edge between these meters)"),
            )
            .otherwise("error (unknown action)")
        )
        log = F.array_append(a["log"], F.struct(o["position"].alias("position"), result.alias("result")))
        return F.struct(F.when(o["forward"], here2).otherwise(back2).cast(_EDGE).alias("xy"), F.when(o["forward"], back2).otherwise(here2).cast(_EDGE).alias("yx"), log.alias("log"))

    place = overrides.schema["position"].dataType.simpleString()
    no_log = F.array().cast(f"array<struct<position:{place},result:string>>")
    start = F.struct(F.col("xy").cast(_EDGE).alias("xy"), F.col("yx").cast(_EDGE).alias("yx"), no_log.alias("log"))
    rows = _override_state(edges, overrides)
    ops = F.coalesce("ops", F.array().cast(rows.schema["ops"].dataType))
    rows = staged(rows.select("x", "y", F.aggregate(ops, start, step).alias("s")), "overrides")
    sides = F.array(F.struct(F.col("x").alias("f"), F.col("y").alias("t"), F.col("s.xy").alias("e")), F.struct(F.col("y").alias("f"), F.col("x").alias("t"), F.col("s.yx").alias("e")))
    out = rows.select(F.explode(sides).alias("r")).where("r.e is not null")
    out = out.selectExpr("r.f as from_meter", "r.t as to_meter", "r.e.k as coefficient", "r.e.d as derived_from")
    return out, rows.select(F.explode("s.log").alias("l")).select("l.position", "l.result")


def building_virtuals(terms: DataFrame, media: str, meters: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(meters, edges) to add: a virtual meter per building of the formula terms (building, role,
    meter_id, faktor), its + terms feeding it, it feeding its - terms; what exists is left out."""
    b = F.regexp_replace("building", r"[ ()]", "")
    t = terms.withColumn("virtual", F.concat(F.lit("B"), b, F.lit(f".{media}_BUILDING"))).withColumn("meter_id", canonical_meter_id(F.col("meter_id")))
    number = F.regexp_extract(b, r"^(\d+)", 1)
    new = t.select(F.col("virtual").alias("meter_id"), F.when(number != "", number).otherwise(b).alias("building"), F.lit("virtual").alias("meter_type"))
    new = new.distinct().join(meters.select("meter_id"), "meter_id", "left_anti")
    plus = F.col("role") == "add"
    rows = t.where("role in ('add', 'sub')").select(
        F.when(plus, F.col("meter_id")).otherwise(F.col("virtual")).alias("from_meter"), F.when(plus, F.col("virtual")).otherwise(F.col("meter_id")).alias("to_meter"),
        F.coalesce("faktor", F.lit(1.0)).alias("coefficient"), F.concat(F.lit("building_virtual_B"), b).alias("derived_from"),
    )
    one = rows.groupBy("from_meter", "to_meter").agg(F.min(F.struct("coefficient", "derived_from")).alias("e")).select("from_meter", "to_meter", "e.*")
    return new, one.join(edges.select("from_meter", "to_meter"), ["from_meter", "to_meter"], "left_anti")


def relation_type_of(edges: DataFrame) -> DataFrame:
    """(parent, child, relation_type, flow_coefficient): an explicit type wins; else a coefficient
    other than 1 and 0.001 makes a feeds edge; else a sub-meter without coefficient. Edges of
    building virtuals are left out."""
    k = F.coalesce("coefficient", F.lit(1.0))
    given = F.nullif(F.col("relation_type"), F.lit("")) if "relation_type" in edges.columns else F.lit(None).cast("string")
    kind = F.coalesce(given, F.when((F.abs(k - 1) > 1e-9) & (F.abs(k - 0.001) > 1e-9), "feeds").otherwise("hasSubMeter"))
    rows = edges.where(~F.coalesce(F.col("derived_from"), F.lit("")).startswith("building_virtual")).withColumn("kind", kind)
    parent, child = F.col("from_meter").alias("parent_meter_id"), F.col("to_meter").alias("child_meter_id")
    return rows.select(parent, child, F.col("kind").alias("relation_type"), F.when(F.col("kind") == "feeds", k).alias("flow_coefficient"))


def meters_out(meters: DataFrame, media: str) -> DataFrame:
    """Meters of the model from (meter_id, building, meter_type, register_id, label): building
    virtuals are left out, the identifier lists what is known."""
    pair = lambda key, c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.concat(F.lit(f"{key}:"), c))
    return meters.where(~F.col("meter_id").endswith("_BUILDING")).select(
        "meter_id", F.col("meter_id").alias("name"), F.when(F.coalesce(F.col("building"), F.lit("")) != "", F.concat(F.lit("B"), "building")).alias("building_id"),
        F.lit(media).alias("media_type_id"), (F.col("meter_type") == "virtual").alias("is_virtual_meter"),
        F.concat_ws("; ", pair("register", "register_id"), pair("label", "label")).alias("identifier"),
    )


def allocations_out(terms: DataFrame, building_id: Column) -> DataFrame:
    """(building_id, formula_row, sign, role, meter_id, faktor) of terms whose label is a building."""
    sign = F.when(F.col("role") == "add", "+").otherwise("-")
    rows = terms.select(
        building_id.alias("building_id"), F.col("row").alias("formula_row"), sign.alias("sign"), "role",
        canonical_meter_id(F.col("meter_id")).alias("meter_id"), F.coalesce("faktor", F.lit(1.0)).alias("faktor"),
    )
    return rows.where("building_id is not null")


def residual_fit(edges: DataFrame, monthly: DataFrame, buildings: DataFrame, min_months: int = 6, least: float = 5.0, threshold: float = 0.2) -> DataFrame:
    """(from_meter, to_meter, improvement, months): for every meter without edges the parent of its
    building whose monthly residual it explains best. edges (from_meter, to_meter), monthly (meter_id,
    month, delta), buildings (meter_id, building)."""
    ends = edges.select(F.col("from_meter").alias("meter_id")).union(edges.select("to_meter")).distinct()
    v = monthly.select("meter_id", "month", "delta")
    kids = edges.join(v.withColumnRenamed("meter_id", "to_meter"), "to_meter").groupBy(F.col("from_meter").alias("p"), "month").agg(F.sum("delta").alias("kids"))
    parents = edges.select(F.col("from_meter").alias("p")).distinct()
    resid = v.withColumnRenamed("meter_id", "p").join(parents, "p", "left_semi").join(kids, ["p", "month"], "left").select("p", "month", (F.col("delta") - F.coalesce("kids", F.lit(0.0))).alias("r"))
    resid = resid.join(resid.groupBy("p").count().where(F.col("count") >= min_months), "p", "left_semi").join(buildings.withColumnRenamed("meter_id", "p"), "p")
    alone = v.join(ends, "meter_id", "left_anti").join(buildings, "meter_id").select(F.col("meter_id").alias("o"), "month", "building", F.col("delta").alias("x"))
    fit = resid.join(alone, ["building", "month"]).groupBy("p", "o").agg(F.count("*").alias("months"), F.sum(F.abs("r")).alias("before"), F.sum(F.abs(F.col("r") - F.col("x"))).alias("after"))
    fit = fit.where((F.col("months") >= min_months) & (F.col("before") >= least)).withColumn("gain", (F.col("before") - F.col("after")) / F.col("before")).where(F.col("gain") >= threshold)
    best = fit.groupBy("o").agg(F.min(F.struct((-F.col("gain")).alias("g"), "p", "months")).alias("b"))
    return best.select(F.col("b.p").alias("from_meter"), F.col("o").alias("to_meter"), (-F.col("b.g")).alias("improvement"), F.col("b.months").alias("months"))


def source_conflicts(edges: DataFrame) -> DataFrame:
    """(x, y, status, forward, backward) per unordered pair x <= y of canonical meters: both directions
    are a direction_conflict; one from two sources or more is confirmed, else source_only. The
    columns forward (x -> y) and backward list the sources."""
    e = edges.select(canonical_meter_id(F.col("from_meter")).alias("f"), canonical_meter_id(F.col("to_meter")).alias("t"), "source")
    names = lambda hit: F.array_sort(F.collect_set(F.when(hit, F.col("source"))))
    forward = F.col("f") <= F.col("t")
    p = e.groupBy(F.least("f", "t").alias("x"), F.greatest("f", "t").alias("y")).agg(names(forward).alias("a"), names(~forward).alias("b"))
    status = F.when((F.size("a") > 0) & (F.size("b") > 0), "direction_conflict").when(F.size("a") + F.size("b") >= 2, "confirmed").otherwise("source_only")
    return p.select("x", "y", status.alias("status"), F.array_join("a", "|").alias("forward"), F.array_join("b", "|").alias("backward"))


def orphan_verdict(meters: DataFrame, edges: DataFrame, terms: DataFrame) -> DataFrame:
    """(meter_id, verdict) of meters without an incoming edge, by their roles in formula terms (meter_id, role)."""
    canon = lambda df, c, name: df.select(canonical_meter_id(F.col(c)).alias(name)).distinct()
    alone = canon(meters, "meter_id", "meter_id").join(canon(edges, "to_meter", "meter_id"), "meter_id", "left_anti")
    plus, minus = (canon(terms.where(f"role = '{r}'"), "meter_id", "meter_id").withColumn(r, F.lit(True)) for r in ("add", "sub"))
    rows = alone.join(plus, "meter_id", "left").join(minus, "meter_id", "left")
    return rows.select("meter_id", F.when(F.col("sub"), "missing_parent").when(F.col("add"), "terminal_leaf").otherwise("absent").alias("verdict"))


def edge_audit(parsed: DataFrame, expected: DataFrame) -> DataFrame:
    """(from_meter, to_meter, status): expected edges that are missed or flipped, parsed ones that are extra."""
    cols = ["from_meter", "to_meter"]
    p, e = parsed.select(cols).distinct(), expected.select(cols).distinct()
    back = lambda df: df.select(F.col("to_meter").alias("from_meter"), F.col("from_meter").alias("to_meter"))
    absent = e.join(p, cols, "left_anti")
    flipped = absent.join(back(p), cols, "left_semi")
    missed = absent.join(back(p), cols, "left_anti")
    extra = p.join(e, cols, "left_anti").join(back(flipped), cols, "left_anti")
    return reduce(DataFrame.unionByName, (df.withColumn("status", F.lit(s)) for df, s in ((missed, "missed"), (flipped, "flipped"), (extra, "extra"))))


def component_roots(edges: DataFrame, meters: DataFrame, declared: DataFrame, directed: DataFrame | None = None) -> DataFrame:
    """(component, root, why) per component of undirected edges (a, b) that has a meter: a declared
    source; else a meter that directed edges (up, down) leave but never enter; else the meter of the
    highest degree; the smallest id on a tie."""
    comp = connected_components(edges, "a", "b")
    ends = edges.where("a <> b").select(F.col("a").alias("id"), F.col("b").alias("n")).union(edges.where("a <> b").select("b", "a")).distinct()
    degree = ends.groupBy("id").agg(F.count("*").alias("degree"))
    none = edges.sparkSession.createDataFrame([], "up string, down string")
    d = none if directed is None else directed
    arrows = d.select(F.col("up").alias("id")).distinct().join(d.select(F.col("down").alias("id")), "id", "left_anti").withColumn("arrow", F.lit(True))
    said = declared.select(F.col("meter_id").alias("id"), F.lit(True).alias("said")).distinct()
    rows = comp.join(meters.select(F.col("meter_id").alias("id")).distinct(), "id", "left_semi").join(degree, "id", "left").join(arrows, "id", "left").join(said, "id", "left")
    rank = F.when(F.col("said"), 0).when(F.col("arrow"), 1).otherwise(2)
    by_degree = F.when(rank == 2, -F.coalesce("degree", F.lit(0))).otherwise(0)
    best = rows.groupBy("component").agg(F.min(F.struct(rank.alias("rank"), by_degree.alias("deg"), "id")).alias("r"))
    why = F.element_at(F.array(*map(F.lit, ("explicit", "arrow", "auto_root_degree"))), F.col("r.rank") + 1)
    return best.select("component", F.col("r.id").alias("root"), why.alias("why"))


def bfs_parents(edges: DataFrame, roots: DataFrame, max_rounds: int = 1000) -> DataFrame:
    """(id, parent, root, depth): breadth-first trees from the roots (root) along undirected edges
    (a, b); of several possible parents the smallest."""
    both = staged(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    seen = staged(roots.select(F.col("root").alias("id"), F.lit(None).cast(both.schema["a"].dataType).alias("parent"), "root", F.lit(0).alias("depth")).distinct(), "bfs")
    front = seen
    for depth in range(1, max_rounds):
        step = both.join(front.select(F.col("id").alias("a"), "root"), "a").join(seen.select(F.col("id").alias("b")), "b", "left_anti")
        front = staged(step.groupBy("b").agg(F.min(F.struct("a", "root")).alias("p")).select(F.col("b").alias("id"), F.col("p.a").alias("parent"), "p.root", F.lit(depth).alias("depth")), "bfs")
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
    raise RuntimeError(f"more than {max_rounds} levels")


def nearest_upstream(tree: DataFrame, meters: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(up, meter_id, root): for every meter of the tree (id, parent, root) the nearest meter above it,
    by pointer jumping over nodes that are no meters."""
    ids = meters.select(F.col("meter_id").alias("id")).distinct().withColumn("is_meter", F.lit(True))
    jump = staged(tree.select("id", F.col("parent").alias("up")), "jump")
    known = ids.select(F.col("id").alias("up"), F.col("is_meter").alias("stop"))
    for _ in range(max_rounds):
        marked = jump.join(known, "up", "left")
        if marked.where("up is not null and stop is null").isEmpty():
            break
        over = jump.select(F.col("id").alias("up"), F.col("up").alias("next"))
        jump = staged(marked.join(over, "up", "left").select("id", F.when(F.col("stop"), F.col("up")).otherwise(F.col("next")).alias("up")), "jump")
    found = jump.join(ids, "id", "left_semi").where("up is not null")
    return found.join(tree.select("id", "root"), "id").select("up", F.col("id").alias("meter_id"), "root")


#: Rules of `match_ids`, by rank.
MATCH_RULES = ("exact", "normalised", "suffix", "transformed", "tail_in_building", "tail")


def match_ids(wanted: DataFrame, known: DataFrame) -> DataFrame:
    """(id, match, rule): the known id that the first rule of a cascade finds, the smallest on a tie.

    Rules: the same id; the same ASCII letters and digits, whatever their case; the id with a suffix
    added or taken away; the id after a known change of its form (VM and VMM, a dot for the first dash,
    no system code between dashes, underscores and dashes); the same letters and digits behind the
    building prefix in the same building, then in any. An id of another quantity counts only if none
    of the wanted quantity is found, as "other_quantity". wanted (id, building, quantity or null),
    known (meter_id, building, quantity).
    """
    norm = lambda c: F.lower(F.regexp_replace(c, "[^A-Za-z0-9]", ""))
    tail = lambda c: norm(F.regexp_replace(c, r"^B\d+[A-Z]?[^0-9A-Za-z]+", ""))
    i = F.col("id")
    # fixed values: suffixes that ids gain or lose
    suffixes = [F.concat(i, F.lit(x)) for x in ("_E", "_V", "-S", "-1", "_1_1", "-A1", "-B1")] + [F.when(i.rlike("_[EV]$"), F.regexp_replace(i, "_[EV]$", ""))]
    forms = [
        F.regexp_replace(i, r"VMM(\d)", "VM$1"), F.regexp_replace(i, r"VM(\d)", "VMM$1"), F.regexp_replace(i, "^([^-]*)-", "$1."),
        F.regexp_replace(i, r"-\d+-", "-"), F.translate(i, "-", "_"), F.translate(i, "_", "-"),
    ]
    keys = lambda c, two, three: F.array(
        *(F.struct(F.lit(r).alias("rank"), k.alias("key")) for r, k in [(0, c), (1, norm(c)), *((2, x) for x in two), *((3, x) for x in three)]),
        F.struct(F.lit(4).alias("rank"), F.concat_ws("|", "building", tail(c)).alias("key")), F.struct(F.lit(5).alias("rank"), tail(c).alias("key")),
    )
    m = F.col("meter_id")
    have = known.select("meter_id", "quantity", F.explode(keys(m, [m], [m])).alias("k")).groupBy("k.rank", "k.key", "quantity").agg(F.min("meter_id").alias("match"))
    have = have.withColumnRenamed("quantity", "found_quantity")
    want = wanted.select("id", "quantity", F.explode(keys(i, suffixes, forms)).alias("k")).select("id", "quantity", "k.*").where("key is not null and key <> ''")
    other = F.coalesce(F.col("quantity") != F.col("found_quantity"), F.lit(False))
    best = want.join(have, ["rank", "key"]).groupBy("id").agg(F.min(F.struct(other.alias("other"), "rank", "match")).alias("b"))
    rule = F.when(F.col("b.other"), "other_quantity").otherwise(F.element_at(F.array(*map(F.lit, MATCH_RULES)), F.col("b.rank") + 1))
    return best.select("id", F.col("b.match").alias("match"), rule.alias("rule"))
