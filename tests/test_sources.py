"""Readers, block exports, registry, sinks, stores and the stream, on files written here."""

from __future__ import annotations

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from flowloom.schema import schema
from flowloom.sources import blocks, readers, registry, sinks

RULES = {
    "name": "pack", "version": "1",
    "update": [{"source": {"name": "Zinc", "unit": "kg", "context": ["air"]}, "target": {"name": "Zinc II", "identifier": "c1", "unit": "kg"}, "conversion_factor": 0}, {"source": {"name": " "}, "target": {"identifier": "c2"}}],
    "replace": [{"source": {"name": "Lead", "context": ["Emissions to soil"]}, "target": {"name": "Lead II"}, "conversion_factor": 2.0, "comment": "x"}],
    "delete": [{"source": {"name": "old", "identifier": "d1"}}],
}
BLOCKS = """{export 9}


Process

Category type
material

Process identifier
P1

Type
Unit process

Process name
milk at farm

Products
Milk {FR} U;kg;1,5;60;x
Cream;kg;0,5;40;x

Materials/fuels
Feed;kg;2*ratio;Undefined

Emissions to air
Methane;(unspecified);kg;0,25;Undefined

Input parameters
Ratio;0,67;Undefined

Calculated parameters
Net;ratio*2

End

Process

Process identifier
P2

Products
Copied from elsewhere, steel;kg;1;100;x

End
"""


def test_rules_and_registry(spark, rows, tmp_path):
    path = tmp_path / "rules.json.gz"
    with gzip.open(path, "wt") as f:
        json.dump(RULES, f)
    r = readers.read_rules(spark, str(path))
    assert rows(r, "verb", "seq", "factor") == [("replace", 0, 2.0), ("update", 0, 1.0), ("update", 1, 1.0)]
    m = registry.from_rules(r, tier="flow_mapper", provenance="pack")
    assert rows(m, "source_name", "source_top_bucket", "target_code", "unit_conversion", "priority_tier") == [("Lead", "soil", None, 2.0, 4), ("Zinc", "air", "c1", 1.0, 4)]
    assert m.schema.simpleString() == schema("mapping").simpleString()
    both = registry.build([m, m.withColumn("source_name", F.upper("source_name")), registry.from_rules(r, tier="water_volume", provenance="other")])
    assert both.count() == 4 and both.where("provenance = 'pack'").count() == 2
    d = registry.deletions(readers.read_rules(spark, str(path), ("delete",)), r.limit(0))
    assert rows(d, "name", "code", "kind") == [("old", "d1", "process")]


def test_flow_list_sheet_and_curated(spark, rows, tmp_path):
    flows = {"flows": [{"identifier": "u1", "source": "EF", "prefLabel": "Zinc", "altLabel": ["zinc", "Zn <2+>", "Spelter", " "], "context_iri": "x/envi-air-1"}, {"identifier": "u2", "source": "EF", "altLabel": None, "prefLabel": "Gone"}, {"identifier": "u3", "source": "other", "prefLabel": "No"}]}
    (tmp_path / "flows.json").write_text(json.dumps(flows))
    known = spark.createDataFrame([("u1",)], "code string")
    f = readers.read_flow_list(spark, str(tmp_path / "flows.json"), "EF", known)
    assert rows(f, "code", "label", "bucket", "row") == [("u1", "Spelter", "air", "0.2"), ("u1", "Zinc", "air", "0.0")]
    assert rows(registry.from_flow_list(f, target_db="ef", provenance="list"), "source_name", "priority_tier") == [("Spelter", 5), ("Zinc", 5)]
    (tmp_path / "sheet.csv").write_text("row;name;unit;categories;cas;target\n0;Zinc;kg;('air', 'urban');nan;Zinc II\n1; ;kg;;;x\n2;Mud;kg;;;\n")
    s = readers.read_placeholder_sheet(spark, str(tmp_path / "sheet.csv"))
    assert rows(s, "name", "bucket", "cas") == [("Mud", "unspecified", None), ("Zinc", "air", None)]
    assert rows(registry.from_sheet(s, tier="curated_targeted", provenance="sheet", target_db="d"), "source_name") == [("Zinc",)]
    assert registry.from_sheet(s, tier="unmatchable", provenance="sheet", target_db="d", unmatchable=True).where("is_unmatchable").count() == 2
    c = spark.createDataFrame([("a", "kg", ["air"], "d", "c1", None, "harmonised", False), ("b", "kg", ["air"], "d", "c2", None, None, None), ("n", None, None, None, None, None, None, True)], "name string, unit string, categories array<string>, target_db string, target_code string, target_name string, tier string, is_unmatchable boolean")
    good, bad = registry.curated(c)
    assert rows(good, "source_name", "priority_tier") == [("a", 5), ("b", 1)] and rows(bad, "source_name") == [("n",)]
    r = spark.createDataFrame([("a", "d", "c", "t", "accept"), ("b", "d", "c", "t", "reject")], "name string, target_db string, target_code string, target_name string, decision string")
    assert rows(registry.reviewed(r, provenance="r"), "source_name", "priority_tier") == [("a", 11)]


def test_units_registry(spark, rows):
    u = lambda *r: spark.createDataFrame(list(r), "source_unit string, target_unit string, multiplier double, provenance string")
    assert rows(registry.unit_conversions([u(("a", "b", 2.0, "x")), u(("a", "b", 3.0, "y"), ("b", "c", 4.0, "y"))]), "source_unit", "multiplier") == [("a", 2.0), ("b", 4.0)]
    al = registry.unit_aliases([spark.createDataFrame([("Kilo", "kg", "s"), ("kg", "kg", "s")], "alias string, canonical string, provenance string")])
    df = spark.createDataFrame([("kilo ",), ("kg",), ("square_metre",), (None,)], "u string")
    assert rows(registry.canonical_unit(df, "u", al, "c"), "c") == [(None,), ("kg",), ("kg",), ("square metre",)]
    t = spark.createDataFrame([("c", "Zinc", "kg", ["air"], None, 2), ("c", "Other", "kg", ["soil"], None, 1)], "code string, name string, unit string, categories array<string>, cas string, seq int")
    assert rows(registry.target_index(t), "name", "name_lower", "bucket") == [("Other", "other", "soil")]


def test_blocks(spark, rows, tmp_path):
    (tmp_path / "export.csv").write_text(BLOCKS)
    b = blocks.read_blocks(spark, str(tmp_path / "export.csv"))
    assert rows(blocks.processes(b), "identifier", "name", "type") == [("P1", "milk at farm", "Unit process"), ("P2", None, None)]
    assert rows(blocks.products(b), "identifier", "seq", "name", "amount", "allocation") == [("P1", 0, "Milk {FR} U", 1.5, 60.0), ("P1", 1, "Cream", 0.5, 40.0), ("P2", 0, "Copied from elsewhere, steel", 1.0, 100.0)]
    assert rows(blocks.exchanges(b), "type", "name", "sub_compartment", "unit", "amount", "formula") == [("biosphere", "Methane", "(unspecified)", "kg", 0.25, None), ("technosphere", "Feed", None, "kg", None, "2*ratio")]
    assert rows(blocks.parameters(b), "process_code", "kind", "name", "amount", "formula") == [("P1", "calculated", "net", None, "ratio*2"), ("P1", "input", "ratio", 0.67, None)]
    kept, gone = blocks.split_marked(b, ["copied from"])
    assert kept.count() == 1 and rows(gone, "identifier", "marker") == [("P2", "copied from")]


def test_sheets_and_overrides(spark, rows, tmp_path):
    (tmp_path / "factors.csv").write_text("0;Impact category;Early;x\n150;Impact category;Climate;kg\n151;Air;;Methane;74-82-8;28,0;kg;kg\n152;Air;urban;Methane;74-82-8;28.0;kg;kg\n153;;;;;;;\n154;Impact category;Ozone;kg\n155;Air;;Halon;;2.5;kg;kg\n")
    f = readers.read_factor_sheet(spark, str(tmp_path / "factors.csv"))
    assert rows(f, "method", "compartment", "sub_compartment", "cf") == [("Climate", "Air", "urban", 28.0), ("Ozone", "Air", "", 2.5)]
    (tmp_path / "ref.csv").write_text("0;h;h;h\n3;a;1.5;x\n4;a (pack);2;3\n5; ;7;8\n")
    s = readers.read_reference_scores(spark, str(tmp_path / "ref.csv"), {"name": 0}, {"m1": 1, "m2": 2}, without="(pack)")
    assert rows(s, "name", "m1", "m2") == [(None, 7.0, 8.0), ("a", 1.5, None)]
    p = tmp_path / "over.csv"
    p.write_text("parameter_name;scope;value;set_at;comment\nratio;*;0.5;;\n")
    old = readers.read_overrides(spark, str(p))
    assert rows(old, "parameter_name", "value") == [("ratio", 0.5)]
    new = spark.createDataFrame([("RATIO", "*", 0.7, None, None), ("x", "P", 1.0, None, None)], schema("override"))
    sinks.save_overrides(str(tmp_path / "out"), old, new)
    assert rows(readers.read_overrides(spark, str(tmp_path / "out")), "parameter_name", "value") == [("RATIO", 0.7), ("x", 1.0)]
    for bad in ("ratio;*;abc;;\n", "ratio;*;NaN;;\n"):
        p.write_text("parameter_name;scope;value;set_at;comment\n" + bad)
        with pytest.raises(Exception, match="(?i)malformed|finite|FAILFAST|FAILED_READ"):
            readers.read_overrides(spark, str(p)).collect()


def test_versions_duplicates_and_missing(spark, rows, tmp_path):
    p = tmp_path / "loc.json"
    entry = {"database": "d", "code": "c", "location": "FR"}
    p.write_text(json.dumps({"version": 1, "overrides": [entry]}))
    assert rows(readers.read_located(spark, str(p))) == [("d", "c", "FR")]
    p.write_text(json.dumps({"version": 2, "overrides": [entry]}))
    with pytest.raises(readers.VersionError):
        readers.read_located(spark, str(p))
    p.write_text(json.dumps({"version": 1, "overrides": [entry, entry]}))
    with pytest.raises(readers.DuplicateKeyError):
        readers.read_located(spark, str(p))
    assert readers.read_or_empty(spark, str(tmp_path / "none"), "mapping").schema == schema("mapping")
    f = tmp_path / "x"
    f.write_bytes(b"abc")
    assert readers.checksum_ok(str(f), "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad") and not readers.checksum_ok(str(f), "0") and not readers.checksum_ok(str(tmp_path / "y"), "0")


def test_method_factors_are_partitioned(spark, rows, tmp_path):
    f = spark.createDataFrame([("m1", "d", "c", 1.0), ("m2", "d", "c", 2.0)], schema("method_cf"))
    sinks.write_method_factors(f, str(tmp_path / "cf"), f.withColumn("location", F.lit("FR")))
    got = readers.read_method_factors(spark, str(tmp_path / "cf")).where("method_slug = 'm2'")
    assert rows(got, "method_slug", "cf") == [("m2", 2.0)]
    assert "PartitionFilters: [isnotnull(method_slug" in got._jdf.queryExecution().toString()
    assert readers.read_method_factors(spark, str(tmp_path / "cf"), regional=True).count() == 2
    (tmp_path / "cf" / "index.json").write_text('{"version": 9}')
    with pytest.raises(readers.VersionError):
        readers.read_method_factors(spark, str(tmp_path / "cf"))


def test_package_store(spark, rows, tmp_path):
    store = sinks.PackageStore(spark, str(tmp_path / "store"), most=2)
    a = spark.range(10).withColumn("v", F.col("id") * 2.5)
    key = store.write({"a": a})
    assert store.write({"a": a.repartition(5).orderBy(F.desc("id"))}) == key and store.names() == [key]
    assert rows(store.read(key)["a"]) == rows(a)
    keys = [key]
    for i in (1, 2):
        time.sleep(1.1)
        keys.append(store.write({"a": a.where(f"id > {i}")}))
    assert store.names() == [keys[2], keys[1]]
    with pytest.raises(FileNotFoundError):
        store.read(key)
    assert sinks.content_hash(a) != sinks.content_hash(a, constants=(1,))
    assert sinks.content_hash(a) != sinks.content_hash(a.union(a.limit(1)))


def test_exports(spark, rows, tmp_path):
    df = spark.createDataFrame([("a", 1 / 3, None), ("b", None, "x")], "k string, v double, t string")
    sinks.write_csv(df, str(tmp_path / "csv"), digits=6)
    text = "".join(p.read_text() for p in (tmp_path / "csv").glob("*.csv"))
    assert "a,0.333333," in text and "b,,x" in text
    sinks.write_table(df, str(tmp_path / "t"), ["k"])
    assert sinks.append_absent(str(tmp_path / "t"), spark.createDataFrame([("b", 2.0, None), ("c", 3.0, None)], df.schema), ["k"]) == 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    c = spark.createDataFrame([(1, "m", 5, 2.0, 0.5), (1, "m", 6, -3.0, 0.5)], "demand_id int, method string, row_id int, contribution double, share double")
    sinks.write_product_json(c, str(tmp_path / "j"))
    doc = json.loads(next((tmp_path / "j").glob("part-*")).read_text().splitlines()[0])
    assert doc["total_abs_contribution"] == 5.0 and [f["row_id"] for f in doc["flows"]] == [6, 5]
    sinks.write_report(str(tmp_path / "r.json"), {"a": 1})
    assert json.loads((tmp_path / "r.json").read_text()) == {"a": 1}
    m = spark.createDataFrame([(1, 1, 1.0), (2, 1, 1.0)], "row_id int, col_id int, value double")
    assert sinks.matrix_report(m) == {"rows": 2, "cols": 1, "entries": 2, "deficit": 1, "square": False}


def test_cache_follows_its_source(spark, tmp_path):
    src, cache = tmp_path / "s.csv", str(tmp_path / "c")
    src.write_text("1\n")
    made = []

    def build():
        made.append(1)
        return spark.read.schema("a int").csv(str(src))

    assert readers.cached(spark, str(src), cache, build).count() == 1 and len(made) == 1
    readers.cached(spark, str(src), cache, build)
    assert len(made) == 1
    src.write_text("1\n2\n")
    os.utime(src, (time.time() + 10, time.time() + 10))
    assert readers.cached(spark, str(src), cache, build).count() == 2 and len(made) == 2


def test_background_edges(spark, rows):
    e = spark.createDataFrame([("d", "c", "d", "x", 1.0, "technosphere"), ("z", "c", "d", "x", 1.0, "technosphere")], "output_database string, output_code string, input_database string, input_code string, amount double, type string")
    a = spark.createDataFrame([("d", "c"), ("z", "q")], "database string, code string")
    assert readers.exchanges_of_database(e, a, "d").count() == 1


def test_stream_is_windowed_and_counted_once(spark, rows, tmp_path):
    from flowloom.streaming.rescore import EVENTS, drain, windowed

    df = spark.createDataFrame([(i, __import__("datetime").datetime(2024, 1, 1 + i % 3), 1, "x", 1.0, "{}") for i in range(9)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    df.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    assert rows(drain(stream()), "event_type", "n", "total") == [("x", 3, 3.0)] * 3
    q = windowed(stream()).writeStream.outputMode("complete").format("memory").queryName("w").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select sum(n) from w").first()[0] == 9


def test_contract():
    import __spark_entry__ as e

    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q) and len(q) > 60
    assert all(callable(f) for f in q.values())
