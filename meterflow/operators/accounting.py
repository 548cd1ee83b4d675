"""Conservation, accounting and reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.operators.topology import canonical_meter_id
from meterflow.plans.stage import staged

#: Levels of terms that formulas may nest; a term one level further is unresolved.
MAX_DEPTH = 4


def _every_month(rows: DataFrame, values: DataFrame) -> DataFrame:
    """`rows` repeated for every `month` that `values` has. The months come as one row, an array."""
    months = values.agg(F.array_sort(F.collect_set("month")).alias("months"))
    return rows.crossJoin(months).withColumn("month", F.explode("months")).drop("months")


def monthly_conservation(edges: DataFrame, monthly: DataFrame, coefficients: bool = False) -> DataFrame:
    """(parent, month, delta, children, residual, residual_pct, n_children, dead_children) of every
    parent in every month. edges (parent, child[, coefficient]), monthly (meter_id, month, delta);
    what is missing counts as 0, coefficients as 1 unless asked for."""
    one = monthly.groupBy("meter_id", "month").agg(F.sum("delta").alias("d"))
    k = F.coalesce("coefficient", F.lit(1.0)) if coefficients else F.lit(1.0)
    kids = _every_month(edges, monthly).join(one.withColumnRenamed("meter_id", "child"), ["child", "month"], "left")
    kids = kids.withColumn("d", F.coalesce("d", F.lit(0.0)))
    sums = kids.groupBy("parent", "month").agg(F.sum(F.col("d") * k).alias("children"), F.count("*").alias("n_children"), F.count_if(F.col("d") == 0).alias("dead_children"))
    both = sums.join(one.withColumnRenamed("meter_id", "parent"), ["parent", "month"], "left").withColumn("delta", F.coalesce("d", F.lit(0.0)))
    residual = F.col("delta") - F.col("children")
    pct = F.when(F.col("delta") > 0.01, 100 * residual / F.col("delta"))
    return both.select("parent", "month", "delta", "children", residual.alias("residual"), pct.alias("residual_pct"), "n_children", "dead_children")


def classify_conservation(rows: DataFrame) -> DataFrame:
    """(parent, flag): from the monthly residual percentages, population deviations."""
    by_month = Window.partitionBy("parent").orderBy("month")
    p = F.col("residual_pct")
    known = rows.where(p.isNotNull()).withColumn("jump", F.abs(p - F.lag("residual_pct").over(by_month)))
    s = known.groupBy("parent").agg(F.avg("residual_pct").alias("mean"), F.stddev_pop("residual_pct").alias("sd"), F.max("jump").alias("jump"), F.bool_and(F.abs(p - 100) < 5).alias("dead"))
    flag = (
        F.when(F.col("mean").isNull(), "no_data").when(F.col("dead"), "dead_children").when((F.abs("mean") < 5) & (F.col("sd") < 5), "clean")
        .when((F.col("sd") < 5) & F.col("mean").between(5, 50), "losses_stable").when(F.coalesce("jump", F.lit(0.0)) > 20, "swap_event")
        .when(F.col("sd") > 10, "drift_seasonal").otherwise("review")
    )
    return rows.select("parent").distinct().join(s, "parent", "left").select("parent", flag.alias("flag"))


def flag_breakdown(flags: DataFrame) -> DataFrame:
    """(flag, parent, n): every parent with the number of parents of its flag."""
    n = flags.groupBy("flag").agg(F.count("*").alias("n"))
    return flags.select("flag", "parent").join(n, "flag")


def accounting_balance(terms: DataFrame, crosswalk: DataFrame, monthly: DataFrame) -> DataFrame:
    """(building, row, month, sum, n_add, n_sub, any_data) of every formula row in every month. terms
    (building, row, sign, meter_id), crosswalk (key, id); factors are not applied, terms without id
    or value are left out of the sum."""
    known = terms.join(crosswalk.select(F.col("key").alias("meter_id"), "id"), "meter_id", "left")
    values = monthly.groupBy(F.col("meter_id").alias("id"), "month").agg(F.sum("delta").alias("d"))
    rows = _every_month(known, monthly).join(values, ["id", "month"], "left")
    signed = F.when(F.col("sign") == "+", F.col("d")).otherwise(-F.col("d"))
    return rows.groupBy("building", "row", "month").agg(
        F.coalesce(F.sum(signed), F.lit(0.0)).alias("sum"), F.count_if(F.col("sign") == "+").alias("n_add"), F.count_if(F.col("sign") == "-").alias("n_sub"),
        F.bool_or(F.col("d").isNotNull()).alias("any_data"),
    )


def accounting_flags(balance: DataFrame) -> DataFrame:
    """(building, flags): negative months, erratic sums (deviation over 120 % of the mean), near zero; else ok."""
    s = balance.where("any_data").groupBy("building").agg(F.count_if(F.col("sum") < -0.01).alias("neg"), F.avg("sum").alias("m"), F.stddev_pop("sum").alias("sd"))
    flags = F.concat_ws(
        " ", F.when(F.col("neg") > 0, F.concat(F.lit("negative_month×"), "neg")), F.when((F.col("m") > 0) & (F.col("sd") / F.col("m") * 100 > 120), "erratic"), F.when(F.col("m") < 0.1, "near_zero")
    )
    return s.select("building", F.when(flags == "", "ok").otherwise(flags).alias("flags"))


def silent_meters(terms: DataFrame, crosswalk: DataFrame, monthly: DataFrame) -> DataFrame:
    """(meter_id, problem): "silent" for mapped meters without any month, "no_crosswalk" for unmapped ones."""
    m = terms.select("meter_id").distinct()
    known = m.join(crosswalk.select(F.col("key").alias("meter_id"), "id"), "meter_id")
    quiet = known.join(monthly.select(F.col("meter_id").alias("id")), "id", "left_anti").select("meter_id", F.lit("silent").alias("problem"))
    return quiet.unionByName(m.join(known, "meter_id", "left_anti").select("meter_id", F.lit("no_crosswalk").alias("problem")))


def evaluate_formulas(terms: DataFrame, values: DataFrame, crosswalk: DataFrame | None = None, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(building, month, value, unresolved) of every formula in every month.

    terms (building, position, sign, meter_id, faktor): a term is a meter with a value, else the
    formula of that name, up to `max_depth` levels. A formula with a term that is neither (or too
    deep) is null and names the first such term in order. values (meter_id, month, value). Formulas are
    worked out level by level, one row per formula, month and formula that it uses, not per path of terms.

    With a crosswalk (key, id) a term's meter is the id of its name, else of its canonical name, and
    a formula is also found by its canonical name (of several the last in order of names); without
    one, names are ids.
    """
    v = values.groupBy(F.col("meter_id").alias("id"), "month").agg(F.sum("value").alias("value"))
    step = F.when(F.col("sign") == "+", F.col("faktor")).otherwise(-F.col("faktor"))
    used, formulas = terms.select("meter_id").distinct(), terms.select(F.col("building").alias("formula")).distinct()
    exact = used.join(formulas, F.col("meter_id") == F.col("formula"), "left")
    if crosswalk is None:
        names = exact.withColumn("id", F.col("meter_id"))
    else:
        canon = canonical_meter_id(F.col("meter_id"), "dashes")
        by_canon = formulas.groupBy(canonical_meter_id(F.col("formula"), "dashes").alias("canon")).agg(F.max("formula").alias("same"))
        ids = crosswalk.groupBy("key").agg(F.max("id").alias("id"))
        named = exact.withColumn("canon", canon).join(by_canon, "canon", "left").join(ids.withColumnRenamed("key", "meter_id"), "meter_id", "left")
        named = named.join(ids.select(F.col("key").alias("canon"), F.col("id").alias("other")), "canon", "left")
        names = named.select("meter_id", F.coalesce("same", "formula").alias("formula"), F.coalesce("id", "other").alias("id"))
    # order: +terms before -terms, then position; of nested terms the path of positions
    order = F.format_string("%d%06d", (F.col("sign") != "+").cast("int"), F.col("position"))
    rows = _every_month(terms, values).select("building", "month", "meter_id", step.alias("k"), F.array(order).alias("path"))
    rows = rows.join(names, "meter_id", "left").join(v, ["id", "month"], "left")
    # terms that are the same formula have the same value and problem: they are one row, with the sum of
    # their factors and the first of their places
    inner, term = F.when(F.col("value").isNull(), F.col("formula")).alias("inner"), F.struct("path", "meter_id")
    sums = rows.groupBy("building", "month", inner).agg(
        F.sum(F.col("k") * F.col("value")).alias("total"), F.sum("k").alias("k"), F.min(term).alias("first"), F.min(F.when(F.col("value").isNull(), term)).alias("bad")
    )
    sums = staged(sums, "terms")
    own = sums.where("inner is null").select("building", "month", "total", "bad")
    # from the deepest level, at which no term counts, outwards
    out = sums.groupBy("building", "month").agg(F.lit(None).cast("double").alias("total"), F.min("first").alias("bad"))
    for _ in range(max_depth):
        below = out.select(F.col("building").alias("inner"), "month", F.col("total").alias("t"), F.col("bad").alias("b"))
        bad = F.when(F.col("b").isNotNull(), F.struct(F.concat("first.path", "b.path").alias("path"), F.col("b.meter_id").alias("meter_id")))
        nested = sums.join(below, ["inner", "month"]).select("building", "month", (F.col("k") * F.col("t")).alias("total"), bad.alias("bad"))
        out = own.unionByName(nested).groupBy("building", "month").agg(F.sum("total").alias("total"), F.min("bad").alias("bad"))
    return out.select("building", "month", F.when(F.col("bad").isNull(), F.col("total")).alias("value"), F.col("bad.meter_id").alias("unresolved"))


def spot_check(computed: DataFrame, reported: DataFrame) -> DataFrame:
    """(building, month, reported, computed, delta, delta_pct, flagged): flagged where the difference
    is over 5 and over 10 % (of reported totals above 0.1). Inputs (building, month, value)."""
    both = computed.withColumnRenamed("value", "computed").join(reported.select("building", "month", F.col("value").alias("reported")), ["building", "month"], "left")
    both = both.withColumn("delta", F.col("computed") - F.col("reported")).withColumn("delta_pct", F.when(F.abs("reported") > 0.1, F.col("delta") / F.col("reported") * 100))
    flagged = F.coalesce((F.abs("delta") > 5) & (F.col("delta_pct").isNull() | (F.abs("delta_pct") > 10)), F.lit(False))
    return both.select("building", "month", "reported", "computed", "delta", "delta_pct", flagged.alias("flagged"))


def spot_totals(checked: DataFrame) -> DataFrame:
    """(month, reported, computed, delta) over rows with both figures."""
    ok = checked.where("delta is not null").groupBy("month").agg(F.sum("reported").alias("reported"), F.sum("computed").alias("computed"))
    return ok.withColumn("delta", F.col("computed") - F.col("reported"))


def formula_check(terms: DataFrame, values: DataFrame, reported: DataFrame, unit_factor: float = 1.0, tolerance: float = 0.001) -> DataFrame:
    """(building, media, month, reported, computed, ok): signed, factored sums against reported ones,
    ok where they differ by less than `tolerance`; reported zeros are left out. A term takes the value
    of its own medium if there is one, else the value of the first other medium, else 0. terms
    (building, media, position, sign, meter_id, faktor), values (meter_id, media, month, value),
    reported (building, media, month, value)."""
    v = values.select("meter_id", "month", F.col("media").alias("vm"), "value")
    best = F.min_by("value", F.struct((F.col("vm") != F.col("media")).cast("int"), "vm"))
    # equal terms stand at different positions and count each
    term = ["building", "media", "month", "position", "sign", "meter_id", "faktor"]
    picked = _every_month(terms, values).join(v, ["meter_id", "month"], "left").groupBy(*term).agg(best.alias("value"))
    sign = F.when(F.col("sign") == "+", 1.0).otherwise(-1.0)
    total = picked.groupBy("building", "media", "month").agg((F.sum(sign * F.col("faktor") * F.coalesce("value", F.lit(0.0))) * unit_factor).alias("computed"))
    both = reported.where("value <> 0").withColumnRenamed("value", "reported").join(total, ["building", "media", "month"])
    return both.select("building", "media", "month", "reported", "computed", (F.abs(F.col("computed") - F.col("reported")) < tolerance).alias("ok"))


def classify_diffs(reported: DataFrame, computed: DataFrame, metered: DataFrame, overrides: DataFrame) -> DataFrame:
    """(building_id, month, reported, computed, diff, reason, explanation).

    Inputs (building_id, month, value); metered (building_id) has a meter; overrides (building_id,
    month or null, reason, explanation). In order: noise is a match; a reported total without meter
    or computed value is attributed to the campus; overrides of the month, then of the building;
    else drift.
    """
    name = lambda df, c: df.select("building_id", "month", F.col("value").alias(c))
    both = name(reported, "reported").join(name(computed, "computed"), ["building_id", "month"], "full_outer").fillna(0.0, ["reported", "computed"])
    diff = F.col("computed") - F.col("reported")
    pick = lambda df, p: df.select(*(c for c in ("building_id", "month") if p == "m_" or c == "building_id"), F.col("reason").alias(f"{p}reason"), F.col("explanation").alias(f"{p}text"))
    both = both.join(metered.select("building_id").distinct().withColumn("metered", F.lit(True)), "building_id", "left")
    both = both.join(pick(overrides.where("month is not null"), "m_"), ["building_id", "month"], "left").join(pick(overrides.where("month is null"), "b_"), "building_id", "left")
    r, c = F.col("reported"), F.col("computed")
    case = lambda match, campus, month, building, drift: (
        F.when((r == 0) & (c == 0), match).when((r > 0) & (F.abs(diff / r * 100) < 0.25), match).when((r == 0) & (F.abs(diff) < 10), match)
        .when(F.col("metered").isNull() & (r > 0) & (c == 0), campus).when(F.col("m_reason").isNotNull(), month).when(F.col("b_reason").isNotNull(), building).otherwise(drift)
    )
    reason = case(F.lit("match"), F.lit("campus_attributed"), F.col("m_reason"), F.col("b_reason"), F.lit("ontology_drift"))
    text = case(F.lit(""), F.lit("no meter of the building; measured at campus level"), F.col("m_text"), F.col("b_text"), F.lit("difference without a known cause"))
    return both.select("building_id", "month", "reported", "computed", diff.alias("diff"), reason.alias("reason"), text.alias("explanation"))


def reason_counts(rows: DataFrame, by: Column | None = None) -> DataFrame:
    """(workstream, reason, n), most first."""
    key = (by if by is not None else F.lit("all")).alias("workstream")
    return rows.groupBy(key, "reason").agg(F.count("*").alias("n")).orderBy("workstream", F.desc("n"), "reason")
