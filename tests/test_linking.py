"""Expressions, keep-first, matching, factors, parameters and reports on small tables."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from flowloom.functions import exprs as x
from flowloom.operators import cf, keep, link, match, params, report


def one(spark, expr, **columns):
    df = spark.range(1).select(*[F.lit(v).alias(k) if not isinstance(v, list) else F.array(*[F.lit(e) for e in v]).cast("array<string>").alias(k) for k, v in columns.items()] or [F.lit(1).alias("z")])
    return df.select(expr.alias("v")).first().v


@pytest.mark.parametrize(("cats", "want"), [(["Emissions", "Emissions to water"], "water"), (["natural resource", "in air"], "resource"), (["Raw"], "resource"), ([], "unspecified"), (["x"], "unspecified")])
def test_bucket(spark, cats, want):
    assert one(spark, x.bucket_of(F.col("c")), c=cats) == want


@pytest.mark.parametrize(("name", "want"), [("Wheat {FR}", "FR"), ("Wheat {CA-QC} U", "CA"), ("Mix GLO U", None), ("Mix, US", "US"), ("x {DE} y {BR}", "BR"), ("plain", None), ("", None)])
def test_location(spark, name, want):
    assert one(spark, x.location_in(F.col("n")), n=name) == want


@pytest.mark.parametrize(("name", "base", "region"), [("Water, river, BR", "Water, river", "BR"), ("Water, RoW", "Water", "RoW"), ("Water, CA-QC", "Water", "CA-QC"), ("Water, Big", "Water, Big", ""), ("Water", "Water", "")])
def test_suffix(spark, name, base, region):
    r = one(spark, x.regional_suffix(F.col("n"), ["BR", "CA"]), n=name)
    assert (r.base, r.region) == (base, region)


def test_small_expressions(spark):
    assert one(spark, x.normal_cas(F.col("c")), c="0007732-18-5 ") == "7732-18-5"
    assert one(spark, x.normal_product_code(F.col("c")), c=" 00123 ") == "123"
    assert one(spark, x.normal_product_code(F.col("c")), c="9341_1") == "9341_1"
    assert one(spark, x.product_code_in(F.col("c")), c="Egg [ciqual CODE: 12_3] x") == "12_3"
    assert one(spark, x.short_name(F.col("c")), c="Ethane, tetrafluoro-, Halon-2401") == "halon 2401"
    assert one(spark, x.short_name(F.col("c")), c="Coal, hard") == ""
    assert one(spark, x.normal_method(F.col("c")), c="EF-Human_toxicity, cancer - organics") == "human toxicity cancer"
    assert one(spark, x.without_unspecified(F.col("c")), c=["air", "(unspecified)", " "]) == ["air"]
    assert one(spark, x.joined_parts(F.col("c")), c=["air", "", "urban", "unspecified"]) == "air / urban"
    assert one(spark, x.without_location(F.col("c"), F.lit("FR")), c="Milk, FR") == "Milk"
    assert one(spark, x.literal_list(F.col("c")), c="('air', 'urban')") == ["air", "urban"]
    assert one(spark, x.first_json(F.col("c")), c='so {"a": 1} and') == '{"a": 1}'
    assert one(spark, x.words(F.col("c")), c="A-b, a 1") == ["a", "b", "1"]
    assert one(spark, x.country_of(F.col("c")), c=" US-TX ") == "US"
    assert one(spark, x.bucket_of_context(F.col("c")), c="http://x/envi-grou-1/") == "soil"
    p = one(spark, x.name_parts(F.col("c")), c="Milk {FR}| dairy | U")
    assert (p.display, p.location, p.activity, p.rest) == ("Milk", "FR", "dairy", "U")
    g = one(spark, x.name_and_geography(F.col("c")), c="milk/FR/I U")
    assert (g.name, g.location) == ("milk", "FR")
    assert one(spark, x.flow_id(F.col("c"), F.lit("b")), c="a") == int.from_bytes(__import__("hashlib").sha256(b"a\0b").digest()[:8]) & (2**63 - 1)
    assert one(spark, x.synthetic_id(F.lit(2**62), F.lit(5)), c="") == (2**62 * 1_000_003 + 5) % (2**61 - 1)


def test_rescaled(spark):
    lit = F.lit
    r = one(spark, x.rescaled(lit(2.0), lit(math.log(2)), lit(0.1), lit(1.0), lit(3.0), lit(2), lit(-2.0)), c="")
    assert (r.amount, r.loc, r.minimum, r.maximum) == (-4.0, pytest.approx(math.log(4)), -6.0, -2.0)
    z = one(spark, x.rescaled(lit(2.0), lit(2.0), lit(0.1), lit(1.0), lit(3.0), lit(3), lit(0.0)), c="")
    assert (z.amount, z.loc, z.scale, z.minimum) == (0.0, 0.0, None, None)


def test_sub_rank(spark):
    rank = lambda w, t: one(spark, x.sub_rank(F.lit(w), F.col("t")), t=t)
    assert rank("river", ["water", "River"]) == 0
    assert rank("river", ["water", "surface water"]) == 1
    assert rank("river", ["water", "ocean"]) == 2
    assert rank("river", ["water", "pond"]) == 3
    assert rank("", ["water"]) == 0
    assert rank("", ["water", "ocean"]) == 3


def test_keep(spark, rows):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (None, "c", 3), (None, "d", 2)], "k int, v string, o int")
    assert rows(keep.keep_first(df, ["k"], ["o"])) == [(None, "d", 2), (1, "a", 1)]
    assert rows(keep.dominant(spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "z"), (2, "y")], "g int, v string"), ["g"], ["v"])) == [(1, "b", 2), (2, "y", 1)]
    new = spark.createDataFrame([(1, "n"), (None, "n"), (3, "n")], "k int, v string")
    assert rows(keep.insert_if_absent(df.select("k", "v"), new, ["k"])) == rows(df.select("k", "v").unionByName(new.where("k = 3")))
    f = spark.createDataFrame([(1, None), (2, 5), (3, None), (90, None), (91, 7), (92, None)], "o int, v int")
    assert [r[1] for r in sorted(keep.forward_fill(f, F.col("v"), "o", "w").select("o", "w").collect())] == [None, 5, 5, 5, 7, 7]
    assert keep.forward_fill(f.limit(0), F.col("v"), "o", "w").count() == 0


def test_forward_fill_query_gives_every_event(spark, rows, tmp_path):
    from flowloom.plans import linking

    ids = [i for i in range(50, 400) if i % 7]
    spark.createDataFrame([(i,) for i in ids], "event_id long").write.parquet(str(tmp_path / "events.parquet"))
    got = rows(linking.forward_fill(spark, str(tmp_path)), "event_id", "header")
    assert sorted(got) == [(i, max((h for h in ids if h % 97 == 0 and h <= i), default=None)) for i in ids]


def test_cascade_and_chain(spark, rows):
    left = spark.createDataFrame([(1, "a", "x"), (2, "a", "z"), (3, "b", None), (4, None, None)], "i int, n string, u string")
    right = spark.createDataFrame([("a", "x", "c1"), ("a", "y", "c2"), ("b", "q", "c3"), ("b", "q", "c3")], "n string, u string, code string")
    keys = [[(F.col(k), F.col(k)) for k in ks] for ks in (("n", "u"), ("n",))]
    assert rows(match.cascade(left, right, keys, ["code"]), "i", "code", "match_pass") == [(1, "c1", 1), (2, None, None), (3, "c3", 2), (4, None, None)]
    shops = spark.createDataFrame([("p", "EU", "s1"), ("p", "FR", "s2"), ("p", "FR", "s3")], "k string, at string, s string")
    ask = spark.createDataFrame([(1, "p", ["FR", "EU"]), (2, "p", ["US"])], "i int, k string, chain array<string>")
    assert rows(match.first_in_chain(ask, shops, ["k"], "chain", "at", ["s"]), "i", "chain_rank", "s") == [(1, 1, "s1"), (2, None, None)]


def test_tiers_halt_gap_and_units(spark, rows):
    cat = spark.createDataFrame([("d", "c1", "Zinc", ["air"], "kg"), ("d", "c2", "Zinc", ["air", "urban"], "kg"), ("d", "c3", "Zinc", ["air", "urban"], "m3")], "db string, code string, name string, categories array<string>, unit string")
    ddl = "source_name string, source_top_bucket string, source_cas string, target_db string, target_code string, target_name string, target_unit string, unit_conversion double, priority_tier int, provenance string, is_unmatchable boolean"
    row = lambda name, code, tier, halt=False, bucket="air", unit=1.0: (name, bucket, None, "d", code, None, None, unit, tier, "p", halt)
    reg = [row("zinc", "C1", 2), row("zinc", "c2", 2), row("stop", "c1", 3), row("stop", None, 1, True), row("gap", "c1", 5), row("cubic", "c3", 1), row("other", "c1", 1, bucket="water"), row("reviewed", "c1", 11)]
    e = spark.createDataFrame([(1, "Zinc", ["air", "Urban"], "kg", None, False), (2, "stop", ["air"], "kg", None, False), (3, "gap", ["air"], "kg", None, True), (4, "gap", ["air"], "kg", None, False), (5, "cubic", ["air"], "kg", None, False), (6, "other", ["air"], "kg", None, False), (7, "reviewed", ["air"], "kg", None, False), (8, None, None, None, None, None)], "exc_id int, name string, categories array<string>, unit string, cas string, linked boolean")
    conv = spark.createDataFrame([], "source_unit string, target_unit string, multiplier double, seq int")
    got = rows(match.tiered_match(e, spark.createDataFrame(reg, ddl), cat, conv, ["d"]), "exc_id", "t_code")
    assert got == [(1, "c2"), (4, "c1"), (6, "c1"), (7, "c1")]
    assert (7, "c1") not in rows(match.tiered_match(e, spark.createDataFrame(reg, ddl), cat, conv, ["d"], reviewed=False), "exc_id", "t_code")
    cubic = conv.unionByName(spark.createDataFrame([("kg", "m3", 0.5, 1), ("kg", "m3", 9.0, 2)], conv.schema))
    assert (5, 0.5) in rows(match.tiered_match(e, spark.createDataFrame(reg, ddl), cat, cubic, ["d"]), "exc_id", "multiplier")


def test_candidates_equal_brute_force(spark, rows):
    import random

    rng = random.Random(2)
    word = ["acid", "oxide", "ion", "zinc", "lead", "tin"]
    make = lambda: " ".join(rng.choice(word) for _ in range(rng.randrange(1, 4)))
    pool = [("d", f"c{i:02d}", make(), rng.choice(["air", "soil"])) for i in range(60)]
    ask = [(i, make(), rng.choice(["air", "soil"])) for i in range(30)] + [(99, "", "air")]
    want = set()
    for i, n, b in ask:
        t = set(n.split())
        best = sorted((-len(t & set(p[2].split())), len(p[2]), p[0], p[1]) for p in pool if p[3] == b and t & set(p[2].split()))[:3]
        want |= {(i, c, -o, r + 1) for r, (o, _, _, c) in enumerate(best)}
    got = match.token_candidates(spark.createDataFrame(ask, "q_id int, name string, bucket string"), spark.createDataFrame(pool, "db string, code string, name string, bucket string"), 3)
    assert set(rows(got, "q_id", "code", "overlap", "rank")) == want


def test_inventory_corrections(spark, rows):
    ddl = "activity_id int, type string, amount double, functional boolean, comment string, allocation_factor double"
    e = spark.createDataFrame([(1, "production", 0.0, True, None, 1.0), (1, "technosphere", 2.0, True, None, 1.0), (2, "production", 5.0, False, "Waste stub", 0.3), (2, "production", 1.0, True, None, 0.7)], ddl)
    assert rows(link.promote_functional(e), "activity_id", "type", "amount") == [(1, "production", 2.0), (2, "production", 1.0), (2, "production", 5.0)]
    assert rows(link.fix_dummies(e, "stub").where("activity_id = 2"), "amount", "allocation_factor", "functional") == [(1.0, 0.0, True), (1.0, 1.0, True)]
    assert rows(link.demote_unfunctional(e).where("activity_id = 2"), "type") == [("production",), ("technosphere",)]
    u = spark.createDataFrame([("biosphere", 0.0, False, ["air"]), ("biosphere", 0.0, True, ["air"]), ("technosphere", 1.0, False, ["Final waste flows"]), ("biosphere", None, False, None)], "type string, amount double, linked boolean, categories array<string>")
    assert link.drop_empty_unlinked(u).count() == 1
    el = spark.createDataFrame([("Electricity, low", "megajoule", 3.6), ("Heat", "megajoule", 3.6)], "name string, unit string, amount double")
    assert rows(link.electricity_to_kwh(el, ["electricity"]), "name", "unit", "amount") == [("Electricity, low", "kilowatt hour", 1.0), ("Heat", "megajoule", 3.6)]
    a = spark.createDataFrame([(1, None, None, None), (2, "own", "kg", 2.0)], "activity_id int, name string, unit string, production_amount double")
    f = spark.createDataFrame([(1, "milk", "l", 3.0, True), (2, "x", "y", 9.0, True), (2, "z", "y", 9.0, False)], "activity_id int, name string, unit string, amount double, functional boolean")
    assert rows(link.metadata_from_output(a, f)) == [(1, "milk", "l", 3.0), (2, "own", "kg", 2.0)]


def test_factor_lookups(spark, rows):
    t = spark.createDataFrame([("m", "Zinc", "Air", "(unspecified)", "1-1", 1.0, 1), ("m", "Zinc ion", "Air", "urban", "1-1", 2.0, 2), ("m", "Ethane, Halon 1", "Air", "urban", None, 3.0, 3), ("m", "Zinc", "Air", "(unspecified)", "1-1", 4.0, 4)], "method string, name string, compartment string, sub_compartment string, cas string, cf double, seq long")
    f = spark.createDataFrame([(1, "m", "zinc", "Air", "urban", None, None), (2, "m", "spelter", "Air", "urban", ["x", "ZINC"], None), (3, "m", "other", "Air", "urban", None, "1-1"), (4, "m", "Halon-1", "Air", "urban", None, None), (5, "m", "nothing", "Air", "urban", None, None), (6, "m", "zinc", "Water", "river", None, None)], "flow_key int, method string, name string, comp string, sub string, synonyms array<string>, cas string")
    got = rows(cf.flow_join(f, t), "flow_key", "sp_cf", "sp_match_provenance")
    assert got == [(1, 4.0, "exact_name"), (2, 4.0, "synonym"), (3, 2.0, "cas"), (4, 3.0, "short_name"), (5, None, "unmatched"), (6, None, "unmatched")]
    assert (6, 4.0) in rows(cf.flow_join(f, t, bridged={"m": "Air"}), "flow_key", "sp_cf")
    ctx = one(spark, cf.table_context(F.col("c"), {("Emissions", "Emissions to air"): ("Air", "indoor")}), c=["Emissions", "Emissions to air"])
    assert (ctx.comp, ctx.sub) == ("Air", "indoor")


def test_comparison(spark, rows):
    j = spark.createDataFrame([(1.0, 1.0005, ["air"], "Air", None), (1e-40, 2e-40, ["air"], "Air", "x"), (1e-12, 0.0, None, None, None), (None, 1.0, ["air"], None, None), (float("nan"), 1.0, ["air"], None, None)], "sp_cf double, ef_cf double, categories array<string>, sp_compartment string, sp_sub_compartment string")
    assert sorted(r.status for r in cf.comparison(j).collect()) == ["agree", "agree", "differ", "registry_only", "registry_only"]


def test_near_zero_and_summary(spark, rows):
    p = spark.createDataFrame([("m", 0.5, 10.0), ("m", 101.0, 100.0), ("m", 1000.0, 1000.0), ("m", 0.5, 0.9), ("m", 1.0, 0.0), ("m", None, 100.0)], "method string, computed double, reference double")
    d = report.differences(p)
    assert rows(d.where("floored"), "computed", "diff_pct") == [(0.5, 0.0)]
    s = report.summary(d).first()
    assert (s.n_compared, s.within_1pct, s.outliers_gt5pct, s.n_near_zero_floored) == (4, 2, 2, 1)


def test_formulas(spark, rows):
    assert params.evaluate("a * (1 - b) ^ 2 + max(1, 2)", {"a": 4.0, "b": 0.5}) == 3.0
    for bad in ("a +", "__import__('os')", "a.b", "x", "1/0", "2**9999", "[1]"):
        with pytest.raises(params.FormulaError):
            params.evaluate(bad, {"a": 1.0})
    assert params.environment({"a": 1.0}, [("c", "b + 1"), ("b", "a + 1")])["c"] == 3.0
    with pytest.raises(params.FormulaError):
        params.environment({}, [("a", "b"), ("b", "a")])


def test_overrides(spark, rows):
    p = spark.createDataFrame([("P", "ratio", "Ratio", "input", 0.67, None, None), ("P", "f1", "F1", "input", 1.02, None, None), ("P", "f2", "F2", "input", 1.76, None, None), ("P", "input_", "Input", "calculated", None, "ratio * f1 * f2", None), ("C", "ratio", "Ratio", "input", 0.67, None, "P")], "process_code string, name string, original_name string, kind string, amount double, formula string, mf_parent_code string")
    e = spark.createDataFrame([("P", 0, "input_", 1.202784), ("P", 1, "input_ - ratio", 0.532784), ("P", 2, "ratio - 0.67", 0.0)], "process_code string, exchange_index long, formula string, amount double")
    o = lambda *r: spark.createDataFrame(list(r), "parameter_name string, scope string, value double, seq int")
    plan = params.override_plan(p, o(("Ratio", "P", 0.5, 1), ("ratio", "*", 0.9, 2)))
    assert rows(plan) == [("C", "ratio", 0.5), ("P", "ratio", 0.5)]
    got = {r.exchange_index: r for r in params.reevaluate(p, e, plan).collect()}
    assert got[0].new_amount == pytest.approx(0.5 * 1.02 * 1.76) and got[1].new_amount == pytest.approx(0.5 * 1.02 * 1.76 - 0.5)
    ratio = {r.exchange_index: r for r in params.reevaluate(p, e, plan, ratio=True).collect()}
    assert ratio[0].new_amount == pytest.approx(0.5 * 1.02 * 1.76) and ratio[2].warning == "baseline is 0"
    same = params.reevaluate(p, e, params.override_plan(p, o(("ratio", "P", 0.67, 1))))
    assert all(r.new_amount == pytest.approx(r.old_amount) for r in same.collect())
    assert rows(params.unknown_overrides(p, o(("nope", "*", 1.0, 1), ("input", "*", 1.0, 2), ("f1", "C", 1.0, 3), ("f1", "P", 1.0, 4)))) == [("f1", "C", "not defined by this process"), ("input", "*", "calculated parameter"), ("nope", "*", "unknown parameter")]
    assert rows(params.influenced(p, plan)) == [("C", "ratio"), ("P", "input_"), ("P", "ratio")]
    assert params.close_names(spark.createDataFrame([("ratoi",)], "wanted string"), p.select("name")).first().suggestion == "ratio"


def test_catalogue_operators(spark, rows):
    from flowloom.operators import catalog

    cat = spark.createDataFrame([("c1", "barley seed production, for sowing", "GLO", "Barley seed"), ("c2", "market for barley seed", "GLO", "Barley seed"), ("c3", "milk production", "RER", "milk"), ("c4", "milk production", "RER", "cream")], "code string, name string, location string, product string")
    n = spark.createDataFrame([(1, "Barley seed {GLO}| production"), (2, "Milk {FR}| production | U"), (3, "Milk {FR}| market for"), (4, "no form"), (5, None)], "id int, name string")
    assert rows(catalog.resolve_names(n, cat)) == [(1, "c1"), (2, "c3"), (3, None), (4, None), (5, None)]
    a = spark.createDataFrame([("a", "milk production, cold", "milk", "FR"), ("own", "milk production", "milk", "FR")], "code string, name string, product string, location string")
    b = spark.createDataFrame([("milk production", "Milk", "FR", "own"), ("", "milk", "FR", "x")], "label string, product string, location string, code string")
    assert rows(catalog.stand_ins(a, b)) == [("a", "own")]
    o = spark.createDataFrame([("o1", "Milk {FR}| making"), ("o2", "Rye {FR}| milling"), ("o3", "x")], "code string, name string")
    s = spark.createDataFrame([("s1", "Milk {CN}| making", 1), ("s2", "Milk {GLO}| making", 2)], "code string, name string, seq int")
    g = spark.createDataFrame([("b1", "milling rye", "GLO", 1), ("b2", "rye milling", "RER", 2)], "code string, name string, location string, seq int")
    relinked = catalog.relink_orphans(o, s, g)
    assert rows(relinked, "code", "target_code", "source") == [("o1", "s2", "inventory"), ("o2", "b1", "background"), ("o3", None, None)]
    e = spark.createDataFrame([(1, "o1"), (2, "o3"), (3, "z"), (4, None)], "i int, target_code string")
    assert rows(catalog.rewrite_targets(e, relinked)) == [(1, "s2"), (2, None), (3, "z"), (4, None)]
    assert rows(catalog.systematic_sample(spark.range(100), "id", 4)) == [(0,), (25,), (50,), (75,)]
    assert catalog.systematic_sample(spark.range(3), "id", 4).count() == 3


def test_statuses_and_audit(spark, rows):
    cat = spark.createDataFrame([("d", "c1", "Zinc", ["air"], "kg")], "db string, code string, name string, categories array<string>, unit string")
    ddl = "source_name string, source_top_bucket string, source_cas string, target_db string, target_code string, target_name string, target_unit string, unit_conversion double, priority_tier int, provenance string, is_unmatchable boolean"
    row = lambda name, code, halt=False: (name, "air", None, "" if name == "lost" else "d", code, None, None, 1.0, 1, "p", halt)
    reg = spark.createDataFrame([row("zinc", "c1"), row("stop", None, True), row("lost", "zz")], ddl)
    e = spark.createDataFrame([(i, n, ["air"], u, None, False) for i, (n, u) in enumerate([("zinc", "kg"), ("zinc", "m3"), ("stop", "kg"), ("lost", "kg"), ("new", "kg"), ("zinc", None)])], "exc_id int, name string, categories array<string>, unit string, cas string, linked boolean")
    conv = spark.createDataFrame([], "source_unit string, target_unit string, multiplier double, seq int")
    got = rows(match.match_status(e, reg, cat, conv, ["d"]))
    assert got == [(0, "matched"), (1, "unit_mismatch_only"), (2, "recognised_unmatchable"), (3, "target_unresolved_only"), (4, "no_registry"), (5, "unit_mismatch_only")]
    prior = spark.createDataFrame([(0, "D", "C9")], "exc_id int, prior_db string, prior_code string")
    m = match.tiered_match(e, reg, cat, conv, ["d"])
    assert rows(match.match_audit(prior, m), "kind", "prior_code", "new_code") == [("override", "c9", "c1")]
    same = spark.createDataFrame([(0, None, "c1")], "exc_id int, prior_db string, prior_code string")
    assert rows(match.match_audit(same, m)) == []
    assert rows(match.match_audit(same.withColumn("prior_code", F.lit(None).cast("string")), m), "kind") == [("new_link",)]


def test_products_are_mapped_without_broadcasting_pieces(spark, rows, tmp_path):
    entries = [(1, "product", "Milk [Ciqual code: 0007]"), (2, "process", "Milk, cold [Ciqual code: 8]"), (3, "product", "Milk, warm [Ciqual code: 8]"), (4, "product", "Beer can [Ciqual code: 9]"), (5, "product", "Beer keg [Ciqual code: 9]"), (6, "process", "Salt"), (7, "product", "Salt"), (8, "product", "Salted butter"), (9, "product", "SALTED BUTTER"), (10, None, None)]
    spark.createDataFrame([*entries, *((100 + i, "process", f"{i} " + "long name " * 40) for i in range(50))], "key long, type string, name string").write.parquet(str(tmp_path / "e"))
    refs = [("a", "7", None, "", "x"), ("b", " 08", None, None, "x"), ("c", "9", None, "keg", "Salt"), ("d", "9", "7", "Beer", "x"), ("e", "9", None, None, "Salt"), ("f", None, None, "", "alted"), ("g", None, None, "", "no such"), ("h", "404", None, "keg", None), ("i", None, None, "", ""), ("j", None, None, "", "lT")]
    got = report.map_products(spark.createDataFrame(refs, "ref_id string, code_a string, code_b string, storage string, name string"), spark.read.parquet(str(tmp_path / "e")))
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "formatted")
    assert not [x for x in plan.split(") BroadcastExchange\n")[1:] if "e_name" in x.split("\n", 1)[0]]  # a small file, but some hundred pieces a name
    assert rows(got) == [("a", 1, "code"), ("b", 3, "code"), ("c", 5, "code"), ("d", 1, "code"), ("e", 7, "name"), ("f", 8, "contained"), ("g", None, None), ("h", None, None), ("i", None, None), ("j", 6, "contained")]
