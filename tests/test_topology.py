"""Merging of edges, overrides, graph walks and rules, against sequential forms."""

import random

import pytest

from meterflow.operators import accounting, topology, validate

EDGE = "parent_meter_id string, child_meter_id string, relation_type string, flow_coefficient double, valid_from date, valid_to date"
REF = "timeseries_id string, sensor_id string, aggregate string, kind string, preferred boolean, valid_from date, valid_to date, database_id string, path string, external_id string, device_id string, sources array<string>, aggregation string"


def merge(edges):
    kept, children = {}, set()
    for f, t, rank in sorted(edges, key=lambda x: x[2]):
        kept[rank] = t not in children and (t, f) not in {(a, b) for (a, b, r) in edges if kept.get(r)}
        if kept[rank]:
            children.add(t)
    return kept


def test_merge_cases_and_random_lists(spark):
    cases = [[("A", "B"), ("A", "B")], [("A", "B"), ("B", "A")], [("A", "C"), ("B", "C")], [("A", "B"), ("B", "A"), ("C", "A")]]
    want = [[True, False], [True, False], [True, False], [True, False, True]]
    rng = random.Random(1)
    cases += [[tuple(rng.sample("ABCDEFG", 2)) for _ in range(rng.randint(1, 30))] for _ in range(8)]
    for i, c in enumerate(cases):
        edges = [(f, t, r) for r, (f, t) in enumerate(c)]
        got = {r.rank: r.accepted for r in topology.merge_candidates(spark.createDataFrame(edges, "from_meter string, to_meter string, rank long")).collect()}
        assert got == merge(edges)
        if i < len(want):
            assert [got[k] for k in sorted(got)] == want[i]


def override(edges, ops):
    final, log = {(f, t): (k, d) for f, t, k, d in edges}, {}
    for a, f, t, k, _, date, who, pos in ops:
        tag = f"override_{date}_{who}"
        if a == "add":
            log[pos] = "skipped (edge already present)" if (f, t) in final else "applied"
            final.setdefault((f, t), (k if k is not None else 1.0, tag))
        elif a == "remove":
            log[pos] = f"applied (removed {final.pop((f, t))[1]})" if (f, t) in final else "error (edge not present to remove)"
        elif (f, t) in final:
            k0, d0 = final.pop((f, t))
            final[(t, f)] = (k0, f"{tag} [was {d0}]")
            log[pos] = "applied (flipped edge)"
        else:
            log[pos] = "skipped (edge already in forced direction)" if (t, f) in final else "error (no edge between these meters)"
    return final, log


def test_overrides_equal_sequence(spark):
    rng = random.Random(2)
    edges = list({(f, t): (f, t, 0.5, "src") for f, t in (rng.sample("ABCDEF", 2) for _ in range(14))}.values())
    ops = [(rng.choice(["add", "remove", "force_direction"]), *rng.sample("ABCDEF", 2), rng.choice([None, 0.25]), "why", "2024-01-01", "me", p) for p in range(60)]
    schema = "action string, from_meter string, to_meter string, coefficient double, reason string, date string, author string, position long"
    out, audit = topology.apply_overrides(spark.createDataFrame(edges, "from_meter string, to_meter string, coefficient double, derived_from string"), spark.createDataFrame(ops, schema))
    final, log = override(edges, ops)
    assert {(r.from_meter, r.to_meter): (r.coefficient, r.derived_from) for r in out.collect()} == final
    assert {r.position: r.result for r in audit.collect()} == log
    with pytest.raises(ValueError):
        topology.apply_overrides(out, spark.createDataFrame([("add",)], "action string"))


def test_names(spark):
    from pyspark.sql import functions as F

    ids = ["B1.VP1_VM61_E", "B1-VP1-VMM61", "B22N.VÅ9_VMM7", "x", "B600-KB2", "B334.X_E", "B1.T10-1_VM3", "B7-V2-VM21_E", None]
    want = {
        "parsed": ["B1.VP1_VMM61", "B1-VP1-VMM61", "B22N.VÅ9_VMM7", "x", "B600-KB2", "B334.X_E", "B1.T10-1_VM3", "B7-V2-VM21_E", None],
        "any": ["B1.VP1_VMM61", "B1-VP1-VMM61", "B22N.VÅ9_VMM7", "x", "B600-KB2", "B334.X", "B1.T10-1_VM3", "B7-V2-VM21", None],
        "dashes": ["B1.VP1_VMM61", "B1.VP1_VMM61", "B22N.VÅ9_VMM7", "x", "B600.KB2", "B334.X", "B1.T10-1_VM3", "B7.V2_VMM21", None],
    }
    df = spark.createDataFrame(list(enumerate(ids)), "i int, meter_id string")
    for scope, names in want.items():
        got = {r.i: r.c for r in df.select("i", topology.canonical_meter_id(F.col("meter_id"), scope).alias("c")).collect()}
        assert [got[i] for i in range(len(ids))] == names, scope


def test_match_cascade(spark):
    known = [("B1.KV1_VM21", "B1", "q"), ("B2.VP1_VMM61_E", "B2", "q"), ("B3.VP1_VMM5", "B3", "q"), ("B339.X9_VM4", "B339", "q"), ("B5.Q_VM1", "B5", "z"), ("B6.V2-MQ43", "B6", "q"), ("B8.A_VM3-S", "B8", "q"), ("b9 kv1 vm22", "B9", "q")]
    wanted = [("B1.KV1_VM21", "exact"), ("B2.VP1_VMM61", "suffix"), ("B3.VP1_VM5", "transformed"), ("B307.X9_VM4", "tail"), ("B5.Q_VM1", "other_quantity"), ("B6-52-V2-MQ43", None), ("B6-V2-MQ43", "normalised"), ("B8.A_VM3", "suffix"), ("B9-KV1-VM22", "normalised"), ("B1Z.KV1_VM21", "tail_in_building"), ("gone", None)]
    b = lambda i: "B1" if i.startswith("B1") else i.split(".")[0].split("-")[0]
    got = {r.id: r.rule for r in topology.match_ids(
        spark.createDataFrame([(i, b(i), "q") for i, _ in wanted], "id string, building string, quantity string"),
        spark.createDataFrame(known, "meter_id string, building string, quantity string"),
    ).collect()}
    assert {i: got.get(i) for i, _ in wanted} == dict(wanted)


def test_building_labels(spark):
    from pyspark.sql import functions as F

    from meterflow.sources.reports import building_id_of

    want = {
        " 307 ": "B307", "621 (I&L)": None, "612 (T)": "B612", "B612 (T)": "B612", "Summa Ställverk": None, "Trädgård 3": None, "Intagsmätare ånga B600": "B600", "Intagsmätare": "BIntagsmätare",
        "Parkering": "BPARKING", "B307 Norra": "B307 Norra", "612-A": "B612-A", "B307.T10-1": None, "Bageri": "BBageri", "12 (": None, "": None,
    }
    df = spark.createDataFrame([(k,) for k in want], "label string")
    assert {r.label: r.b for r in df.select("label", building_id_of(F.col("label")).alias("b")).collect()} == want


def test_formula_terms_count_each(spark):
    t = spark.createDataFrame([("B1", "el", p, "+", "m", 1.0) for p in (0, 1)] + [("B2", "el", 0, "+", "big", 1.0)], "building string, media string, position int, sign string, meter_id string, faktor double")
    v = spark.createDataFrame([("m", "el", "2024-01", 5.0), ("big", "heat", "2024-01", 1_000_000.0)], "meter_id string, media string, month string, value double")
    rep = spark.createDataFrame([("B1", "el", "2024-01", 10.0), ("B2", "el", "2024-01", 1_000_900.0)], "building string, media string, month string, value double")
    assert {r.building: r.ok for r in accounting.formula_check(t, v, rep).collect()} == {"B1": True, "B2": False}


def rules(df):
    return sorted(r.rule for r in df.collect())


def test_every_rule_fires_once(spark):
    import datetime as dt

    d = lambda n: dt.date(2024, 1, n)
    e = lambda *rows: spark.createDataFrame(rows, EDGE)
    sub, feed = "hasSubMeter", "feeds"
    assert rules(validate.no_cycles(e(("A", "B", sub, 1.0, None, None), ("B", "C", sub, 1.0, None, None), ("C", "A", sub, 1.0, None, None)))) == ["no_cycles"]
    assert rules(validate.no_cycles(e(("A", "B", sub, 1.0, None, d(5)), ("B", "A", sub, 1.0, d(5), None)))) == []
    assert rules(validate.no_cycles(e(("A", "A", sub, 1.0, None, None)))) == ["no_cycles"]
    assert rules(validate.feeds_requires_coefficient(e(("A", "B", feed, None, None, None), ("A", "B", sub, None, None, None)))) == ["feeds_requires_flow_coefficient"]
    assert rules(validate.feeds_coefficient_positive(e(("A", "B", feed, 0.0, None, None), ("A", "C", feed, 1.0, None, None)))) == ["feeds_flow_coefficient_positive"]
    assert rules(validate.feeds_sum_to_one(e(("A", "B", feed, 0.7, None, None), ("A", "C", feed, 0.3, None, None), ("D", "C", feed, 0.9, None, None)))) == ["feeds_flow_coefficients_sum_to_one"]
    assert rules(validate.sub_coefficient_range(e(("A", "B", sub, 1.5, None, None), ("A", "C", sub, 1.0, None, None)))) == ["hassubmeter_flow_coefficient_out_of_range"]
    assert rules(validate.validity_non_overlapping(e(("A", "B", sub, 1.0, None, d(5)), ("A", "B", sub, 1.0, d(4), None), ("A", "B", feed, 1.0, d(5), None)))) == ["validity_non_overlapping"]
    r = lambda *rows: spark.createDataFrame([(i, s, "daily", k, p, vf, vt, db, path, x, None, src, agg) for i, s, k, p, vf, vt, db, path, x, src, agg in rows], REF)
    good = ("t1", "s1", "raw", True, None, None, "D", "p", "x", [], None)
    one = {
        validate.ref_kind: ("t2", "s2", "odd", True, None, None, "D", "p", "x", [], None), validate.raw_missing_address: ("t2", "s2", "raw", True, None, None, "D", "", "x", [], None),
        validate.raw_has_derived_fields: ("t2", "s2", "raw", True, None, None, "D", "p", "x", ["t1"], None), validate.derived_missing_declaration: ("t2", "s2", "derived", True, None, None, None, None, None, ["t1"], None),
        validate.derived_has_address: ("t2", "s2", "derived", True, None, None, "D", None, None, ["t1"], "sum"), validate.aggregation_vocabulary: ("t2", "s2", "derived", True, None, None, None, None, None, ["t1"], "mean"),
        validate.ref_sources: ("t2", "s2", "derived", True, None, None, None, None, None, ["t2"], "sum"), validate.one_preferred_ref: ("t2", "s1", "raw", True, None, None, "D", "q", "x", [], None),
        validate.ref_validity_non_overlapping: ("t2", "s1", "raw", False, None, None, "D", "p", "y", [], None),
    }
    for rule, row in one.items():
        assert len(rules(rule(r(good, row)))) == 1 and rules(rule(r(good))) == []
    m = spark.createDataFrame([("A", None, "el"), ("B", "b9", "heat"), ("Z", None, "el")], "meter_id string, building_id string, media_type_id string")
    tables = {"meters": m, "buildings": spark.createDataFrame([("b1", "c1")], "building_id string, campus_id string"), "campuses": spark.createDataFrame([("c1",)], "campus_id string")}
    assert rules(validate.referential_integrity(tables)) == ["referential_integrity"]
    edge = e(("A", "B", sub, 1.0, None, None))
    assert rules(validate.media_consistency(edge, m)) == ["media_consistency"] and rules(validate.orphan_meter(m, edge)) == ["orphan_meter"]
    clean = {"meter_relations": e(("A", "Z", sub, 1.0, None, None)), "timeseries_refs": r(good), "meters": m.where("meter_id <> 'B'"), "buildings": tables["buildings"], "campuses": tables["campuses"]}
    assert rules(validate.validate(clean)) == []


def test_formulas_nest_and_name_what_is_missing(spark):
    t = [("F", 0, "+", "m1", 2.0), ("F", 1, "-", "G", 1.0), ("G", 0, "+", "m2", 1.0), ("H", 0, "+", "m1", 1.0), ("H", 1, "+", "nowhere", 1.0), ("L", 0, "+", "L", 1.0)]
    terms = spark.createDataFrame(t, "building string, position int, sign string, meter_id string, faktor double")
    v = spark.createDataFrame([("m1", "2024-01", 10.0), ("m2", "2024-01", 3.0)], "meter_id string, month string, value double")
    got = {r.building: (r.value, r.unresolved) for r in accounting.evaluate_formulas(terms, v).collect()}
    assert got == {"F": (17.0, None), "G": (3.0, None), "H": (None, "nowhere"), "L": (None, "L")}


def test_cycles_of_any_length(spark):
    ring = [(f"M{i:02}", f"M{(i + 1) % 52:02}", "hasSubMeter", 1.0, None, None) for i in range(52)]
    got = validate.no_cycles(spark.createDataFrame(ring, EDGE)).collect()
    assert [r.subject for r in got] == ["->".join(f"M{i:02}" for i in range(52))]


def test_cycles_in_a_dense_part(spark):
    """Every meter feeds every other: one shortest cycle per smallest meter, without listing all paths."""
    names = [f"M{i:02}" for i in range(14)]
    edges = [(a, b, "feeds", 0.1, None, None) for a in names for b in names if a != b]
    got = {r.subject for r in validate.no_cycles(spark.createDataFrame(edges, EDGE)).collect()}
    assert got == {f"{a}->{names[i + 1]}" for i, a in enumerate(names[:-1])}


def test_formulas_that_use_each_other_often(spark):
    """A hundred terms each, four levels deep: a hundred million paths and more, of which none is a row."""
    at = lambda name, inner: [(name, i, "+" if i % 4 else "-", f"{inner}{i}" if inner == "m" else inner, 0.5) for i in range(100)]
    t = at("F0", "m") + at("F1", "F0") + at("F2", "F1") + at("F3", "F2") + at("F4", "F3")
    # under other names, with two problems below each other: the first by the path of positions is named
    t += [("G", 0, "+", "m1", 1.0), ("G", 2, "+", "gone2", 1.0), ("H", 5, "+", "G", 1.0), ("H", 4, "-", "gone", 1.0), ("H", 6, "+", "G", 1.0)]
    terms = spark.createDataFrame(t, "building string, position int, sign string, meter_id string, faktor double")
    v = spark.createDataFrame([(f"m{i}", m, 1.0) for i in range(100) for m in ("2024-01", "2024-02")], "meter_id string, month string, value double")
    got = {(r.building, r.month): (r.value, r.unresolved) for r in accounting.evaluate_formulas(terms, v).collect()}
    want = {"F0": (25.0, None), "F1": (25.0**2, None), "F2": (25.0**3, None), "F3": (25.0**4, None), "F4": (None, "m1"), "G": (None, "gone2"), "H": (None, "gone2")}
    assert got == {(b, m): want[b] for b in want for m in ("2024-01", "2024-02")}
