"""Commands of the engine, the technosphere matcher and the exports on small and awkward tables."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from flowloom.engine import Engine, Settings
from flowloom.functions import exprs
from flowloom.operators import export, normalise, params, registry, techno
from flowloom.sources import files

EXC = "exc_id long, name string, unit string, location string, product string, amount double"
ACT = "code string, name string, unit string, location string, product string"
CONV = "source_unit string, target_unit string, multiplier double, seq int"
FIX = "name string, new_name string, new_location string, new_product string, seq int"


@pytest.fixture(scope="module")
def engine(spark):
    return Engine(spark, Settings(databases=("bio",), region_databases=("bio",)))


def test_technosphere_passes(spark, engine):
    cat = [("a", "Milk", "kg", "FR", "milk"), ("b", "rye", "kg", "FR", "rye"), ("c", "rye", "kg", "DE", "rye"), ("c2", "rye", "kg", "DE", "rye"), ("d", "power", "kilowatt hour", "FR", "electricity"), ("e", "Oats making", "kg", "GLO", "oats")]
    exc = [
        (1, " milk ", "kg", "FR", "MILK", 1.0), (2, "rye", "ton", "FR", "rye", 2.0), (3, "RYE", "kg", "DE", "rye", 1.0), (4, "old rye", "kg", "FR", "rye", 1.0), (5, "milk", "kg", "FR", "stale", 1.0),
        (6, "somewhere", "kg", "FR", "x", 1.0), (7, "oats {FR}| oats making | U", "kg", None, None, 1.0), (8, "oats {FR}| oats making | U", "l", None, None, 1.0), (9, None, None, None, None, None),
    ]
    args = [spark.createDataFrame(cat, ACT), spark.createDataFrame([("Ton", "kg", 1000.0, 1)], CONV), spark.createDataFrame([("OLD RYE", "rye", None, None, 1)], FIX), spark.createDataFrame([("somewhere", "b")], "name string, code string")]
    got = {r.exc_id: (r.code, r.match_pass, r.amount) for r in engine.link_technosphere(spark.createDataFrame(exc, EXC).withColumn("code", F.lit("clash")), *args).collect()}
    assert got == {1: ("a", 1, 1.0), 2: ("b", 2, 2000.0), 3: (None, None, 1.0), 4: ("b", 3, 1.0), 5: ("a", 4, 1.0), 6: ("b", 5, 1.0), 7: ("e", 6, 1.0), 8: (None, None, 1.0), 9: (None, None, None)}
    assert engine.link_technosphere(spark.createDataFrame([], EXC), *args).count() == 0


def test_region_sweep(spark, rows):
    data = [(1, "bio", "c", "Water", "Water, FR"), (2, "bio", "c@DE", "Water", "Water, FR"), (3, "old", "c", "Water", "Water, FR"), (4, "bio", "c", "Zinc", "Zinc, FR"), (5, "bio", None, "Water", "Water, FR"), (6, "bio", "c", "water, lake", None), (7, "bio", "c", "Water, BR-PA", None), (8, None, None, None, None)]
    df = spark.createDataFrame(data, "id int, t_db string, t_code string, name string, source_name string")
    assert rows(techno.region_sweep(df, ["bio"]), "id", "t_code") == [(1, "c@FR"), (2, "c@DE"), (3, "c"), (4, "c"), (5, None), (6, "c"), (7, "c@BR-PA"), (8, None)]
    assert "FR" in techno.country_codes(spark) and len(techno.country_codes(spark)) > 200


def test_rules_without_a_factor_raise(spark):
    r = spark.createDataFrame([("Zinc", "kg", "Zinc", "g", "c", float("nan"))], "source_name string, source_unit string, target_name string, target_unit string, target_code string, conversion_factor double")
    with pytest.raises(normalise.UnexpectedRule):
        normalise.check_rules(normalise.patched_rules(r))


def test_slugs_are_undone():
    for m in (["a", "EF v3.1", "x_y/z", "é~*"], ["a__b", "c"]):
        assert registry.method_of_slug(registry.method_slug(m)) == tuple(m)
    assert registry.method_of_slug("") == ()


def test_unnamed_rows_fail_on_export(spark):
    pairs = spark.createDataFrame([(1, 2)], "col_id long, product_id long")
    labels = spark.createDataFrame([(1, "", "kg", "FR", "p", "db", "c")], "activity_id long, name string, unit string, location string, reference_product string, database string, code string")
    with pytest.raises(Exception, match="activities"):
        export.activity_labels(pairs, labels).collect()


def test_commands_from_frame_to_export(spark, engine, rows, tmp_path):
    data = [(201, 101, 1.0, "production", False), (201, 102, 0.5, "technosphere", False), (201, 301, 2.0, "biosphere", True), (202, 102, 1.0, "production", False), (202, 301, 5.0, "biosphere", True)]
    f = spark.createDataFrame(data, "output_id long, input_id long, amount double, edge_type string, is_biosphere boolean")
    factors = spark.createDataFrame([("m", 301, 2.0)], "method string, flow_id long, cf double")
    made = spark.createDataFrame([(101, 201), (102, 202)], "product_id long, activity_id long")
    s = engine.system(f, factors, made)
    want = spark.createDataFrame([(1, 101, 1.0), (2, 102, 1.0), (3, 999, 1.0)], "demand_id long, product_id long, amount double")
    scores = engine.scores(s, want)
    assert rows(scores) == [(1, "m", 9.0), (2, "m", 10.0)]
    assert rows(engine.skipped(s, want)) == [(3, "unknown product")]
    parts = engine.decompose(s, want)
    assert rows(parts["flows"].where("demand_id = 1"), "contribution", "share") == [(9.0, 1.0)]
    assert rows(parts["activities"].where("demand_id = 1"), "col_id", "contribution") == [(201, 4.0), (202, 5.0)]
    ref = spark.createDataFrame([("r1", "m", 9.0), ("r2", "m", 8.0)], "ref_id string, method string, reference double")
    _, summary = engine.backtest(scores, ref, spark.createDataFrame([("r1", 1), ("r2", 2)], "ref_id string, key long"))
    assert summary.first().within_1pct == 1 and summary.first().outliers_gt5pct == 1
    labels = spark.createDataFrame([(101, "milk", "c", "db", "process", "kg")], "product_id long, name string, code string, database string, type string, unit string")
    manifest = engine.export_package(s, str(tmp_path / "p"), labels, [["EF", "m"]], {"note": 1})
    assert manifest["counts"] == {"technosphere": 3, "biosphere": 2, "factors": 1, "products": 2, "methods": 1}
    assert json.loads((tmp_path / "p" / "methods.json").read_text())["methods"][0]["slug"] == "EF__m"
    assert engine.skeleton(s, spark.createDataFrame([(202,)], "col_id long")).a.where("col_id = 202").count() == 0


def test_overrides_that_reach_nothing_name_what_is_near(spark, engine):
    p = spark.createDataFrame([("p1", "ratio", None, "input", None, 2.0, None), ("p1", "net", None, "calculated", None, None, "ratio * 2")], "process_code string, name string, original_name string, kind string, mf_parent_code string, amount double, formula string")
    e = spark.createDataFrame([("p1", 0, "net + 1", 5.0), ("p2", 0, "1", 1.0)], "process_code string, exchange_index long, formula string, amount double")
    o = lambda name: spark.createDataFrame([(name, "*", 3.0, 1)], "parameter_name string, scope string, value double, seq int")
    assert [tuple(r) for r in engine.with_overrides(p, e, o("Ratio"), ratio=False).collect()] == [("p1", 0, 5.0, 7.0, None)]
    with pytest.raises(params.UnknownParameter, match="ratio"):
        engine.with_overrides(p, e, o("xatio"))  # another first letter


def test_blocks_stand_beside_datasets(spark, rows):
    made = "0" * 32
    b = spark.createDataFrame([(0, "P1"), (1, None), (2, '""')], "position long, identifier string")
    d = spark.createDataFrame([(0, "P1"), (1, made), (2, made[:-1] + "f")], "position long, code string")
    codes = params.by_position(b, d)
    assert rows(codes) == [(0, "P1"), (1, made), (2, made[:-1] + "f")]
    for wrong in ([(0, "P2"), (1, made), (2, made)], [(0, "P1"), (1, "P9"), (2, made)], [(0, "P1"), (1, made)]):
        with pytest.raises(ValueError, match="side by side"):
            params.by_position(b, spark.createDataFrame(wrong, "position long, code string"))
    rows_ = spark.createDataFrame([(0, "input", "R", None, 2.0, None)], "position long, kind string, name string, original_name string, amount double, formula string")
    got = params.extracted(rows_, codes, spark.createDataFrame([("child", "P1")], "code string, parent_code string"))
    assert rows(got, "process_code", "original_name", "mf_parent_code") == [("P1", "R", None), ("child", "R", "P1")]


def test_balanced_objects(spark):
    texts = ['a {"x": {"y": 1}} b {"z": 2}', '{"s": "}{", "t": "\\"}"} rest', "none", "{ open", "", None, "} {}"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", exprs.first_json(F.col("t")).alias("o"))
    assert [r.o for r in df.orderBy("i").collect()] == ['{"x": {"y": 1}}', '{"s": "}{", "t": "\\"}"}', None, None, None, None, "{}"]


def test_snapshots_and_variants(spark, tmp_path):
    import lzma

    files.write_snapshot({"t": spark.range(3)}, str(tmp_path / "s"), "v1")
    assert files.load_snapshot(spark, str(tmp_path / "s"), "v1")["t"].count() == 3
    for stamp, layout in (("v2", 1), ("v1", 2)):
        with pytest.raises(files.SnapshotError):
            files.load_snapshot(spark, str(tmp_path / "s"), stamp, layout)
    with pytest.raises(files.SnapshotError):
        files.load_snapshot(spark, str(tmp_path / "none"), "v1")
    (tmp_path / "x").mkdir()
    with pytest.raises(FileNotFoundError):
        files.chosen_variant(str(tmp_path / "x"), "full.csv", "part.csv", str(tmp_path / "c"))
    with lzma.open(tmp_path / "x" / "part.csv.xz", "wb") as f:
        f.write(b"a;b")
    path, variant = files.chosen_variant(str(tmp_path / "x"), "full.csv", "part.csv", str(tmp_path / "c"))
    assert variant == "stripped" and open(path).read() == "a;b"
    assert files.reset(spark, [path, str(tmp_path / "nothing")]) == [path]
