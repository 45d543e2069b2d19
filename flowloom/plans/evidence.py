"""Queries that write files and read them back, and queries of small operators over whole tables."""

from __future__ import annotations

import os
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import exprs as x
from flowloom.operators import catalog, link
from flowloom.operators import frame as fr
from flowloom.plans.scoring import Query, r6
from flowloom.plans.scoring import query as _query
from flowloom.schema import assert_schema
from flowloom.session import shared_folder
from flowloom.sources import files, readers, registry, sinks
from flowloom.sources.tables import table

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    return _query(oracle, QUERIES, ORACLE)


def _folder(spark: SparkSession) -> str:
    """A new folder inside the shared one, for files that a query writes and reads back."""
    path = f"{shared_folder(spark)}/flowloom-{uuid.uuid4().hex}".removeprefix("file://").removeprefix("file:")
    os.makedirs(path, exist_ok=True)
    return path


# files


@query("select n_nationkey::varchar as key, n_name as name, n_regionkey::varchar as region, n_nationkey + 2 as row from nation")
def sheet_read(spark: SparkSession, root: str) -> DataFrame:
    """The nations (25 rows at any scale) as a spreadsheet, read through its cache."""
    f = _folder(spark)
    rows = table(spark, root, "nation").select("n_nationkey", "n_name", "n_regionkey").orderBy("n_nationkey").collect()
    cell = lambda c, v: f'<c r="{c}" t="inlineStr"><is><t>{v}</t></is></c>' if isinstance(v, str) else f'<c r="{c}"><v>{v}</v></c>'
    body = "".join(f'<row r="{r.n_nationkey + 3}">{cell(f"A{r.n_nationkey + 3}", r.n_nationkey)}{cell(f"C{r.n_nationkey + 3}", r.n_name)}{cell(f"D{r.n_nationkey + 3}", r.n_regionkey)}</row>' for r in rows)
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(f"{f}/n.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Other" sheetId="1" r:id="r2"/><sheet name="Nations" sheetId="2" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="worksheets/sheet2.xml"/></Relationships>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c></row>{body}</sheetData></worksheet>')
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>key</t></si></sst>')
    t = readers.cached(spark, f"{f}/n.xlsx", f"{f}/cache", lambda: files.read_sheet(spark, f"{f}/n.xlsx", "Nations"))
    return files.sheet_table(t, ["key", "blank", "name", "region"]).select("key", "name", "region", F.col("row").cast("int").alias("row"))


def _packages(spark: SparkSession, root: str, folder: str) -> str:
    """A rule package for each region, its nations as rules (25 in all at any scale)."""
    n = table(spark, root, "nation")
    entry = F.struct(
        F.struct(F.col("n_name").alias("name"), F.lit("kg").alias("unit"), F.array(F.lit("air"), F.lit("urban")).alias("context"), F.lit(None).cast("string").alias("identifier")).alias("source"),
        F.struct(F.lower("n_name").alias("name"), F.lit("g").alias("unit"), F.array(F.lit("Air")).alias("context"), F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("identifier")).alias("target"),
        F.when(F.col("n_nationkey") % 3 == 0, 0.0).otherwise(F.col("n_nationkey") * 2.0).alias("conversion_factor"), F.lit("x").alias("comment"),
    )
    doc = n.orderBy("n_nationkey").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.when(F.col("n_nationkey") % 2 == 0, entry))).alias("update"), F.sort_array(F.collect_list(F.when(F.col("n_nationkey") % 2 == 1, entry))).alias("replace"))
    text = doc.select(F.to_json(F.struct(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("name"), F.lit("1").alias("version"), "update", "replace")).alias("value"), "n_regionkey")
    for r in text.collect():  # five documents
        with open(f"{folder}/r{r.n_regionkey}.json", "w", encoding="utf-8") as out:
            out.write(r.value)
    return folder


_ENTRIES = "e as (select n_nationkey as k, lower(n_name) as t, n_name as n, case when n_nationkey % 2 = 0 then 'update' else 'replace' end as verb, case when n_nationkey % 3 = 0 then 1.0 else n_nationkey * 2.0 end as factor from nation)"


@query(f"with {_ENTRIES} select verb, n as source_name, t as target_name, 'c' || k as identifier, factor::double as factor from e")
def rules_read(spark: SparkSession, root: str) -> DataFrame:
    r = readers.read_rules(spark, _packages(spark, root, _folder(spark)) + "/*.json")
    return r.select("verb", F.col("source.name").alias("source_name"), F.col("target.name").alias("target_name"), F.col("target.identifier").alias("identifier"), "factor")


@query(f"with {_ENTRIES}, m as (select n as source_name, 'c' || k as target_code, factor::double as unit_conversion, t as target_name from e) select source_name, 'air' as source_top_bucket, target_code, unit_conversion, tier::int as priority_tier, tier = 13 as is_unmatchable from m cross join (values (2), (3), (4), (6), (13)) v(tier) union all select n, 'unspecified', 'c' || k, 1.0, 11, false from e where k % 2 = 0")
def registry_sources(spark: SparkSession, root: str) -> DataFrame:
    """The rule packages as five sources, and accepted suggestions as a sixth."""
    rules = readers.read_rules(spark, _packages(spark, root, _folder(spark)) + "/*.json")
    parts = [registry.from_rules(rules, tier=t, provenance=t, target_db="d", unmatchable=t == "unmatchable") for t in ("package_specific", "package_general", "flow_mapper", "water_volume", "unmatchable")]
    k = F.col("n_nationkey")
    said = table(spark, root, "nation").select(F.col("n_name").alias("name"), F.lit("d").alias("target_db"), F.concat(F.lit("c"), k.cast("string")).alias("target_code"), F.lit("t").alias("target_name"), F.when(k % 2 == 0, "accept").otherwise("reject").alias("decision"))
    out = registry.reviewed(said, provenance="review")
    for p in parts:
        out = out.unionByName(p)
    return out.select("source_name", "source_top_bucket", "target_code", "unit_conversion", "priority_tier", "is_unmatchable")


@query("select n_name as source_name, lower(n_name) as target_name, 'air|urban' as source_context, 'Air' as target_context from nation where n_name <> lower(n_name)")
def labels_and_contexts(spark: SparkSession, root: str) -> DataFrame:
    """Rename pairs and context pairs of the packages."""
    f = _packages(spark, root, _folder(spark))
    labels = files.edge_labels(readers.read_rules(spark, f + "/*.json"), "p")
    pairs = files.context_pairs(files.RulePackages(spark, f).load("*"), "p").distinct()
    return labels.join(F.broadcast(pairs), "provenance").select("source_name", "target_name", F.array_join("source_context", "|").alias("source_context"), F.array_join("target_context", "|").alias("target_context"))


@query("select 'r' || r_regionkey as name, '1' as version, true as known, 'name,unit,context' as labels from region")
def package_metadata(spark: SparkSession, root: str) -> DataFrame:
    p = files.RulePackages(spark, _packages(spark, root, _folder(spark)))
    names = [f"r{i}" for i in range(5)]
    rows = [(m["name"], m["version"], p.has(n) and not p.has(n + "x"), ",".join(p.labels(n))) for n in names for m in [p.metadata(n)]]
    return spark.createDataFrame(rows, "name string, version string, known boolean, labels string")


@query("with m as (select 'm' || s_nationkey as method_slug, 'c' || s_suppkey as code, s_acctbal as cf from supplier) select method_slug, code, cf, null::varchar as location from m where method_slug in ('m1', 'm2', 'm3') union all select method_slug, code, cf * 2, 'FR' from m where method_slug in ('m1', 'm2', 'm3')")
def factor_store(spark: SparkSession, root: str) -> DataFrame:
    """Factors written by method and read back; the filter on methods prunes partitions."""
    f = _folder(spark)
    m = table(spark, root, "supplier").select(F.concat(F.lit("m"), F.col("s_nationkey").cast("string")).alias("method_slug"), F.lit("d").alias("db"), F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("code"), F.col("s_acctbal").alias("cf"))
    sinks.write_method_factors(m, f, m.withColumn("location", F.lit("FR")).withColumn("cf", F.col("cf") * 2))
    wanted = F.col("method_slug").isin("m1", "m2", "m3")
    a = readers.read_method_factors(spark, f).where(wanted).withColumn("location", F.lit(None).cast("string"))
    return a.select("method_slug", "code", "cf", "location").unionByName(readers.read_method_factors(spark, f, regional=True).where(wanted).select("method_slug", "code", "cf", "location"))


@query("select 'm' || s_nationkey as method_raw, count(*) * 2 as n, round(sum(s_acctbal) * 3, 4) as total from supplier where s_nationkey in (1, 2) group by 1")
def method_folders(spark: SparkSession, root: str) -> DataFrame:
    """Whole folders of methods, global and regional rows alike; a missing one is skipped."""
    f = _folder(spark)
    m = table(spark, root, "supplier").select(F.concat(F.lit("m"), F.col("s_nationkey").cast("string")).alias("method_slug"), F.lit("d").alias("db"), F.col("s_suppkey").cast("string").alias("code"), F.col("s_acctbal").alias("cf"))
    sinks.write_method_factors(m, f, m.withColumn("location", F.lit("FR")).withColumn("cf", F.col("cf") * 2))
    return files.method_folder(spark, f, ["m1", "m2", "m99"]).groupBy("method_raw").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("cf"), 4).alias("total"))


@query("select p_partkey::bigint as row_id, p_size::double as value from part")
def package_store(spark: SparkSession, root: str) -> DataFrame:
    """A package written by its content, found through the run report that names it."""
    f = _folder(spark)
    a = table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("row_id"), F.col("p_size").cast("double").alias("value"))
    store = sinks.PackageStore(spark, f"{f}/packages")
    key = store.write({"a": a})
    assert store.write({"a": a.orderBy(F.desc("row_id"))}) == key
    sinks.write_report(f"{f}/report.json", {"content_hash": key})
    return spark.read.parquet(files.located_package(f"{f}/report.json", f"{f}/packages") + "/a")


@query("select case when c_custkey % 2 = 0 then 'p' else 'P' end || c_custkey as parameter_name, '*' as scope, (case when c_custkey % 2 = 0 then 2.0 else 1.0 end)::double as value from customer")
def overrides_store(spark: SparkSession, root: str) -> DataFrame:
    """Overrides saved, replaced for even numbers whatever the letter case, and read back."""
    f = _folder(spark)
    k = F.col("c_custkey")
    c = table(spark, root, "customer")
    row = lambda p, v: [F.concat(F.lit(p), k.cast("string")).alias("parameter_name"), F.lit("*").alias("scope"), F.lit(v).alias("value")]
    sinks.save_overrides(f"{f}/o", c.select(*row("P", 1.0)), c.where(k % 2 == 0).select(*row("p", 2.0)))
    return readers.read_overrides(spark, f"{f}/o").select("parameter_name", "scope", "value")


@query("select 'n' || o_orderkey as name, o_totalprice as price, case when o_orderkey % 3 <> 0 then o_custkey::double end as customer from orders where o_orderkey % 10 <> 0")
def reference_scores(spark: SparkSession, root: str) -> DataFrame:
    """A score file by position: three header rows, text that is no number, re-packed twins left out."""
    f = _folder(spark)
    k = F.col("o_orderkey")
    o = table(spark, root, "orders").select((k + 3).alias("row"), F.concat(F.lit("n"), k.cast("string"), F.when(k % 10 == 0, " (pack)").otherwise("")).alias("name"), F.lit("x").alias("u"), F.col("o_totalprice").cast("string").alias("a"), F.when(k % 3 == 0, "-").otherwise(F.col("o_custkey").cast("string")).alias("b"))
    o.write.options(sep=";").csv(f"{f}/s")
    return readers.read_reference_scores(spark, f"{f}/s", {"name": 0}, {"price": 2, "customer": 3}, without="(pack)").select("name", "price", "customer")


@query("select 'm' || n_nationkey as method, 'Air' as compartment, 's' || s_suppkey as name, s_acctbal as cf from supplier join nation on s_nationkey = n_nationkey where s_suppkey % 7 <> 0")
def factor_sheet(spark: SparkSession, root: str) -> DataFrame:
    """A sheet whose header rows name the method of the rows below them."""
    f = _folder(spark)
    s = table(spark, root, "supplier")
    n, k = F.col("s_nationkey").cast("long"), F.col("s_suppkey").cast("long")
    heads = table(spark, root, "nation").select((F.col("n_nationkey").cast("long") * 10_000_000 + 200).alias("row"), F.lit("Impact category").alias("a"), F.concat(F.lit("m"), F.col("n_nationkey").cast("string")).alias("b"), F.lit("kg").alias("c"), *[F.lit(None).cast("string").alias(x) for x in "defg"])
    rows = s.select((n * 10_000_000 + 201 + k).alias("row"), F.lit("Air").alias("a"), F.lit("").alias("b"), F.concat(F.lit("s"), k.cast("string")).alias("c"), F.lit("").alias("d"), F.when(k % 7 != 0, F.col("s_acctbal").cast("string")).otherwise("-").alias("e"), F.lit("kg").alias("f"), F.lit("u").alias("g"))
    heads.unionByName(rows).write.options(sep=";").csv(f"{f}/s")
    return readers.read_factor_sheet(spark, f"{f}/s").select("method", "compartment", "name", "cf")


@query("with s as (select s_suppkey as k, case when s_suppkey % 4 = 0 then null else '50-00-0' end as cas from supplier) select 'flow ' || k as source_name, tier::int as priority_tier, 'air' as source_top_bucket, cas as source_cas, case when tier <> 13 then 'T' || k end as target_name, tier = 13 as is_unmatchable from s cross join (values (1), (7), (13)) v(tier) where k % 5 <> 0")
def placeholder_sheets(spark: SparkSession, root: str) -> DataFrame:
    """A curated sheet, categories as written tuples, as three sources."""
    f = _folder(spark)
    k = F.col("s_suppkey").cast("string")
    name = F.when(F.col("s_suppkey") % 5 != 0, F.concat(F.lit("flow "), k))
    table(spark, root, "supplier").select(F.col("s_suppkey").alias("row"), name.alias("name"), F.lit("kg").alias("unit"), F.lit("('air', 'urban')").alias("categories"), F.when(F.col("s_suppkey") % 4 == 0, "nan").otherwise("50-00-0").alias("cas"), F.concat(F.lit("T"), k).alias("target")).write.options(sep=";", header=True).csv(f"{f}/s")
    sheet = readers.read_placeholder_sheet(spark, f"{f}/s")
    out = registry.from_sheet(sheet.withColumn("target", F.lit(None).cast("string")), tier="unmatchable", provenance="u", target_db="", unmatchable=True)
    for tier in ("curated_targeted", "native_sheet"):
        out = out.unionByName(registry.from_sheet(sheet, tier=tier, provenance=tier, target_db="d"))
    return out.select("source_name", "priority_tier", "source_top_bucket", "source_cas", "target_name", "is_unmatchable")


@query("select 'f' || r_regionkey as code, unnest([r_name, lower(r_name) || ' two']) as label, r_name as name, case when r_regionkey % 2 = 0 then 'air' else 'resource' end as bucket from region where r_regionkey < 4")
def flow_list_read(spark: SparkSession, root: str) -> DataFrame:
    """A consensus list: every label of a flow, those with markup left out, only known codes of one source."""
    f = _folder(spark)
    k = F.col("r_regionkey")
    flow = F.struct(F.concat(F.lit("f"), k.cast("string")).alias("identifier"), F.lit("S").alias("source"), F.col("r_name").alias("prefLabel"), F.array(F.concat(F.lower("r_name"), F.lit(" two")), F.lit("<b>x"), F.upper("r_name")).alias("altLabel"), F.when(k % 2 == 0, "http://x/envi-air-urban/").otherwise("http://x/reso-ground").alias("context_iri"))
    other = F.struct(F.lit("z").alias("identifier"), F.lit("T").alias("source"), F.lit("z").alias("prefLabel"), F.array(F.lit("y")).alias("altLabel"), F.lit("x").alias("context_iri"))
    doc = table(spark, root, "region").agg(F.concat(F.sort_array(F.collect_list(flow)), F.array(other)).alias("flows"))  # five regions
    doc.coalesce(1).write.json(f"{f}/l")
    known = table(spark, root, "region").where("r_regionkey < 4").select(F.concat(F.lit("f"), F.col("r_regionkey").cast("string")).alias("code"))
    return readers.read_flow_list(spark, f"{f}/l", "S", known).select("code", "label", "name", "bucket")


@query("select 'd' as database, 'c' || n_nationkey as code, n_name as location from nation")
def located_overrides(spark: SparkSession, root: str) -> DataFrame:
    f = _folder(spark)
    o = F.struct(F.lit("d").alias("database"), F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("code"), F.col("n_name").alias("location"), F.lit("why").alias("rationale"))
    table(spark, root, "nation").agg(F.lit(1).alias("version"), F.collect_list(o).alias("overrides")).coalesce(1).write.json(f"{f}/o")  # 25 nations
    return readers.read_located(spark, f"{f}/o")


@query("select p_partkey::bigint as k, 1 as round from part where p_partkey % 2 = 0 union all select p_partkey, 2 from part where p_partkey % 3 = 0 and p_partkey % 2 <> 0")
def appended_absent(spark: SparkSession, root: str) -> DataFrame:
    """Rows appended to a table that lacks their key."""
    f = _folder(spark)
    p = table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("k"))
    sinks.append_absent(f"{f}/t", p.where("k % 2 = 0").withColumn("round", F.lit(1)), ["k"])
    sinks.append_absent(f"{f}/t", p.where("k % 3 = 0").withColumn("round", F.lit(2)), ["k"])
    return spark.read.parquet(f"{f}/t")


@query("select o_orderkey::varchar as code, o_orderpriority as name, case when o_orderkey % 4 <> 0 then o_totalprice end as a, case when o_orderkey % 5 <> 0 then o_custkey::double end as b from orders")
def backtest_csv(spark: SparkSession, root: str) -> DataFrame:
    """A wide comma file, null as blank, read back by the report reader."""
    f = _folder(spark)
    k = F.col("o_orderkey")
    sinks.write_csv(table(spark, root, "orders").select(k.cast("string").alias("code"), F.col("o_orderpriority").alias("name"), F.when(k % 4 != 0, F.col("o_totalprice")).alias("a"), F.when(k % 5 != 0, F.col("o_custkey").cast("double")).alias("b")), f"{f}/b", digits=15)
    return files.read_backtest(spark, f"{f}/b", ["a", "b"])


@query("select l_orderkey as demand_id, l_returnflag as method, l_linenumber::bigint as row_id, l_quantity as contribution, round(sum(abs(l_quantity)) over (partition by l_orderkey, l_returnflag), 6) as total from lineitem")
def product_json(spark: SparkSession, root: str) -> DataFrame:
    """One document for each product and method with all its contributions, read back."""
    f = _folder(spark)
    li = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("demand_id"), F.col("l_returnflag").alias("method"), F.col("l_linenumber").cast("long").alias("row_id"), F.col("l_quantity").alias("contribution"), F.lit(0.5).alias("share"))
    sinks.write_product_json(li, f"{f}/p")
    return files.read_product_json(spark, f"{f}/p").select("demand_id", "method", "row_id", "contribution", *r6("total"))


@query("select record_id, name from flow_records")
def linked_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """Exchanges kept as a snapshot of their source and taken from it again."""
    f = _folder(spark)
    files.write_snapshot({"exchanges": table(spark, root, "flow_records").select("record_id", "name")}, f, "stamp")
    return files.load_snapshot(spark, f, "stamp")["exchanges"]


@query("select db, code, cf from (select 'd' as db, 'c' || n_nationkey as code, n_nationkey * 2.0::double as cf from nation)")
def curated_factors(spark: SparkSession, root: str) -> DataFrame:
    f = _folder(spark)
    k = F.col("n_nationkey")
    row = F.struct(F.lit("d").alias("database"), F.concat(F.lit("c"), k.cast("string")).alias("code"), (k * 2.0).alias("amount"))
    table(spark, root, "nation").agg(F.lit(1).alias("version"), F.collect_list(row).alias("factors")).coalesce(1).write.json(f"{f}/c")
    return files.curated_factors(spark, f"{f}/c")


@query("select distinct sp_name as method_raw, sp_cf as cf from cf_flow_join where sp_name is not null and sp_cf is not null and not isnan(sp_cf)")
def factor_columns(spark: SparkSession, root: str) -> DataFrame:
    """Two columns of a factor table; no other is read."""
    return files.two_columns(table(spark, root, "cf_flow_join"), "sp_name", "sp_cf").where("method_raw is not null and cf is not null and not isnan(cf)").distinct()


@query("select c_custkey, case when c_custkey % 4 = 0 then 'kilogram' when c_custkey % 4 = 1 then 'kilogram' when c_custkey % 4 = 2 then 'ton kilometer' else 'litre' end as unit from customer")
def canonical_units(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("c_custkey")
    unit = F.when(k % 4 == 0, "KG ").when(k % 4 == 1, "kilogram").when(k % 4 == 2, "ton_kilometer").otherwise("l")
    a = spark.createDataFrame([("kg", "kilogram", "a"), ("Kg", "gram", "b"), ("l", "litre", "a"), ("kilogram", "kg2", "b")], "alias string, canonical string, provenance string")
    aliases = registry.unit_aliases([a.where("provenance = 'a'"), a.where("alias = 'zz'")])
    return registry.canonical_unit(table(spark, root, "customer").select("c_custkey", unit.alias("written")), "written", aliases, "unit").select("c_custkey", "unit")


@query("select p_name as name, p_brand as code, kind from part cross join (values ('process'), ('product')) v(kind) group by 1, 2, 3")
def deletion_table(spark: SparkSession, root: str) -> DataFrame:
    r = table(spark, root, "part").select(F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("identifier")).alias("source"))
    return registry.deletions(r, r).select("name", "code", "kind")


@query("with f as (select code, name, cas, row_number() over (partition by code order by db, name, cas) as rn from biosphere_catalog) select code, lower(trim(name, ' ')) as name_lower, cas from f where rn = 1")
def target_index(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "biosphere_catalog").withColumn("seq", F.struct("db", "name", "cas"))
    return registry.target_index(c.select("code", "name", "unit", "categories", "cas", "seq")).select("code", "name_lower", "cas")


# small operators


def _exchanges(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem")
    kind = F.when(F.col("l_linenumber") <= 2, "production").when(F.col("l_returnflag") == "R", "biosphere").otherwise("technosphere")
    comment = F.when((F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 3 == 0), "a dummy stub")
    return li.select(F.col("l_orderkey").alias("activity_id"), F.col("l_linenumber").alias("seq"), F.col("l_partkey").alias("item"), kind.alias("type"), F.when(F.col("l_quantity") > 5, F.col("l_quantity")).otherwise(0.0).alias("amount"), (F.col("l_linestatus") == "F").alias("functional"), (F.col("l_suppkey") % 4 == 0).alias("linked"), comment.alias("comment"), F.lit(0.5).alias("allocation_factor"), F.when(F.col("l_partkey") % 3 == 0, F.array(F.lit("Final waste flows"))).otherwise(F.array(F.lit("air"))).alias("categories"))


_EXC = "e as (select l_orderkey as a, l_linenumber as seq, l_partkey as item, case when l_linenumber <= 2 then 'production' when l_returnflag = 'R' then 'biosphere' else 'technosphere' end as type, case when l_quantity > 5 then l_quantity else 0.0 end as amount, l_linestatus = 'F' as functional, l_suppkey % 4 = 0 as linked, l_linenumber = 1 and l_orderkey % 3 = 0 as stub, l_partkey % 3 = 0 as waste from lineitem)"


@query(f"with {_EXC}, g as (select a, bool_or(stub) as s from e group by 1) select a as activity_id, seq, item, case when stub then 1.0 else amount end as amount, stub or functional as functional, case when stub then 1.0 when s and type = 'production' then 0.0 else 0.5 end as allocation_factor from e join g using (a)")
def fixed_dummies(spark: SparkSession, root: str) -> DataFrame:
    return link.fix_dummies(_exchanges(spark, root), "dummy stub").select("activity_id", "seq", "item", "amount", "functional", "allocation_factor")


@query(f"with {_EXC} select a as activity_id, seq, item from e where not (type = 'biosphere' and not linked and amount = 0) and not (not linked and waste)")
def idle_dropped(spark: SparkSession, root: str) -> DataFrame:
    return link.drop_empty_unlinked(_exchanges(spark, root)).select("activity_id", "seq", "item")


@query(f"with {_EXC}, one as (select a, min(item) as item, min(amount) as amount from e where functional group by 1 having count(*) = 1) select o_orderkey as activity_id, case when o_orderkey % 2 = 0 then 'own' else 'i' || item end as name, amount as production_amount from orders left join one on a = o_orderkey")
def output_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Activities with one functional row take its name and amount where they lack their own."""
    e = _exchanges(spark, root).withColumn("name", F.concat(F.lit("i"), F.col("item").cast("string"))).withColumn("unit", F.lit("kg"))
    a = table(spark, root, "orders").select(F.col("o_orderkey").alias("activity_id"), F.when(F.col("o_orderkey") % 2 == 0, "own").alias("name"), F.lit(None).cast("string").alias("unit"), F.lit(None).cast("double").alias("production_amount"))
    return link.metadata_from_output(a, e).select("activity_id", "name", "production_amount")


@query("with b as (select lower(p_name) as label, 'b' || p_partkey as code, p_brand as product, p_partkey from part where p_partkey % 2 = 0) select 'a' || a.p_partkey as code, min(b.code) as stand_in from part a join b on a.p_brand = b.product and starts_with(lower(a.p_name || ' more'), b.label) where a.p_partkey % 2 = 1 group by a.p_partkey having count(distinct b.code) = 1")
def stand_ins(spark: SparkSession, root: str) -> DataFrame:
    p, k = table(spark, root, "part"), F.col("p_partkey")
    a = p.where(k % 2 == 1).select(F.concat(F.lit("a"), k.cast("string")).alias("code"), F.concat("p_name", F.lit(" more")).alias("name"), F.col("p_brand").alias("product"), F.lit("FR").alias("location"))
    b = p.where(k % 2 == 0).select(F.col("p_name").alias("label"), F.col("p_brand").alias("product"), F.lit("FR").alias("location"), F.concat(F.lit("b"), k.cast("string")).alias("code"))
    return catalog.stand_ins(a, b)


@query("select l_orderkey, l_linenumber, case when l_partkey % 3 = 0 then case when l_partkey % 2 = 0 then 'n' || l_partkey end else l_partkey::varchar end as target_code from lineitem")
def rewritten_targets(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("target_code"))
    k = F.col("p_partkey")
    r = table(spark, root, "part").where(k % 3 == 0).select(k.cast("string").alias("code"), F.when(k % 2 == 0, F.concat(F.lit("n"), k.cast("string"))).alias("target_code"))
    return catalog.rewrite_targets(e, r)


@query("select p_partkey, case p_partkey % 5 when 0 then 'FR' when 1 then 'CN' else null end as country, case when p_partkey % 2 = 0 then p_name else p_name || ', FR' end as bare, case when p_partkey % 3 = 0 then 'a|b' else 'a|b c' end as cats, '{\"k\": {\"v\": \"}' || p_partkey || '\"}}' as object from part")
def scalar_texts(spark: SparkSession, root: str) -> DataFrame:
    """Countries of locations, names without their own location, split categories, the first balanced object of an answer."""
    k = F.col("p_partkey")
    p = table(spark, root, "part")
    loc = F.when(k % 5 == 0, " FR").when(k % 5 == 1, "CN-SH").when(k % 5 == 2, "GLO").when(k % 5 == 3, "X")
    name, own = F.concat("p_name", F.lit(", FR")), F.when(k % 2 == 0, "FR").otherwise("DE")
    cats = F.when(k % 3 == 0, "a::b").otherwise("a/ b c|")
    answer = F.concat(F.lit('so } {"k": {"v": "}'), k.cast("string"), F.lit('"}} and {"x": 1}'))
    return p.select("p_partkey", x.country_of(loc).alias("country"), x.without_location(name, own).alias("bare"), F.array_join(x.split_categories(cats), "|").alias("cats"), x.first_json(answer).alias("object"))


@query("select o_orderkey, round((o_totalprice - o_custkey) * 100 / nullif(abs(o_custkey), 0), 6) as pct, md5(lower(o_orderpriority || o_orderstatus)) as hash, case o_orderkey % 4 when 0 then 'air' when 1 then 'water' when 2 then 'soil' else 'unspecified' end as bucket from orders")
def hashes_and_gaps(spark: SparkSession, root: str) -> DataFrame:
    k = F.col("o_orderkey")
    iri = F.when(k % 4 == 0, "http://x/ENVI-AIR-low/").when(k % 4 == 1, "a/envi-wate").when(k % 4 == 2, "a/envi-grou-x").otherwise("a/b")
    o = table(spark, root, "orders")
    return o.select("o_orderkey", x.relative_difference(F.col("o_totalprice"), F.col("o_custkey")).alias("pct"), x.activity_hash(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("hash"), x.bucket_of_context(iri).alias("bucket")).select("o_orderkey", *r6("pct"), "hash", "bucket")


@query("select l_orderkey as output_id, l_partkey as input_id, l_quantity as amount from lineitem")
def checked_frame(spark: SparkSession, root: str) -> DataFrame:
    """A frame that passes the checks of its schema, its numbers and its allocation factors."""
    f = table(spark, root, "lineitem").select(F.col("l_orderkey").cast("long").alias("output_id"), F.col("l_partkey").cast("long").alias("input_id"), F.col("l_quantity").alias("amount"), F.lit("production").alias("edge_type"), F.lit(False).alias("is_biosphere"), F.lit(1.0).alias("allocation_factor"))
    assert_schema(f, "exchange_long")
    fr.check_allocation(f)
    return f.join(fr.not_numbers(f, 5).select("output_id"), "output_id", "left_anti").select("output_id", "input_id", "amount")
