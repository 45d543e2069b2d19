"""Queries of the sources and scalar functions: block exports, registries, names, compartments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions import exprs as x
from flowloom.operators import link
from flowloom.plans.linking import _GROUPS
from flowloom.plans.scoring import Query, rnd
from flowloom.plans.scoring import query as _query
from flowloom.sources import blocks, registry
from flowloom.sources.tables import table

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(oracle: str | None = None):
    return _query(oracle, QUERIES, ORACLE)


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    """Each order written as a block of an inventory export."""
    key = F.col("o_orderkey").cast("string")
    mark = F.when(F.col("o_orderkey") % 9 == 0, F.lit("Copied from elsewhere; ")).otherwise("")
    text = F.concat(
        F.lit("Process\n\nProcess identifier\nP"), key, F.lit("\n\nType\n"), F.col("o_orderstatus"), F.lit("\n\nProcess name\n"), mark, F.col("o_orderpriority"),
        F.lit("\n\nProducts\nMilk "), key, F.lit(";kg;1,5;60;x\nCream;kg;0,"), (F.col("o_orderkey") % 10).cast("string"), F.lit(";40;x\n\nEmissions to air\nMethane;;kg;2*ratio;x\n\nInput parameters\nRatio;0,"), (F.col("o_custkey") % 10).cast("string"), F.lit(";x\n"),
    )
    return table(spark, root, "orders").select(text.alias("block"))


@query("select 'P' || o_orderkey as identifier, o_orderstatus as type, case when o_orderkey % 9 = 0 then 'Copied from elsewhere; ' else '' end || o_orderpriority as name from orders")
def block_processes(spark: SparkSession, root: str) -> DataFrame:
    return blocks.processes(_blocks(spark, root)).select("identifier", "type", "name")


@query("select 'P' || o_orderkey as identifier, 0 as seq, 'Milk ' || o_orderkey as name, 1.5::double as amount, 60.0::double as allocation from orders union all select 'P' || o_orderkey, 1, 'Cream', (o_orderkey % 10) / 10.0::double, 40.0::double from orders")
def block_products(spark: SparkSession, root: str) -> DataFrame:
    return blocks.products(_blocks(spark, root)).select("identifier", "seq", "name", "amount", "allocation")


@query("select 'P' || o_orderkey as process_code, 'ratio' as name, (o_custkey % 10) / 10.0 as amount, '2*ratio' as formula from orders")
def block_parameters(spark: SparkSession, root: str) -> DataFrame:
    b = _blocks(spark, root)
    p = blocks.parameters(b).select("process_code", "name", "amount")
    e = blocks.exchanges(b).where("formula is not null").select(F.col("identifier").alias("process_code"), "formula")
    return p.join(e, "process_code").select("process_code", "name", "amount", "formula")


@query("select 'P' || o_orderkey as identifier, o_orderstatus as type, 'copied from' as marker from orders where o_orderkey % 9 = 0")
def strip_blocks(spark: SparkSession, root: str) -> DataFrame:
    """What is taken out of the export; the digest of each block stays with its identifier."""
    _, gone = blocks.split_marked(_blocks(spark, root), ["copied from"])
    return gone.select("identifier", "type", "marker")


@query(
    "with s as (select distinct source_kind, source_name, source_top_bucket, source_cas, target_db, target_code, target_name, unit_conversion, priority_tier, provenance_row, provenance, case when mapping_id % 3 = 0 then 1 else 0 end as src from mapping),"
    " r as (select *, row_number() over (partition by source_kind, lower(trim(source_name, ' ')), source_top_bucket, source_cas, target_db, target_code, target_name, unit_conversion, priority_tier order by src, provenance_row nulls first, source_name, provenance) as rn from s) select source_kind, source_name, source_top_bucket, source_cas, target_db, target_code, target_name, unit_conversion, priority_tier, provenance_row from r where rn = 1"
)
def registry_build(spark: SparkSession, root: str) -> DataFrame:
    from flowloom.schema import conformed

    m = table(spark, root, "mapping")
    parts = [conformed(m.where(f"mapping_id % 3 {op} 0"), "mapping") for op in ("<>", "=")]
    return registry.build(parts).select("source_kind", "source_name", "source_top_bucket", "source_cas", "target_db", "target_code", "target_name", "unit_conversion", "priority_tier", "provenance_row")


@query("select source_unit, target_unit, arg_min(multiplier, (provenance, multiplier)) as multiplier from unit_conversion group by 1, 2")
def unit_table_build(spark: SparkSession, root: str) -> DataFrame:
    return registry.unit_conversions([table(spark, root, "unit_conversion")]).select("source_unit", "target_unit", "multiplier")


@query("select p_partkey, p_name as display, 'X' || (p_partkey % 9) as location, p_type as activity, case when p_size % 2 = 0 then 'U' end as rest, lower(p_name) as name, case when p_partkey % 2 = 0 then 'FR' end as geo from part")
def name_shapes(spark: SparkSession, root: str) -> DataFrame:
    p = table(spark, root, "part")
    written = F.concat("p_name", F.lit(" {X"), (F.col("p_partkey") % 9).cast("string"), F.lit("}| "), "p_type", F.when(F.col("p_size") % 2 == 0, F.lit(" | U")).otherwise(F.lit("")))
    placed = F.concat(F.lower("p_name"), F.when(F.col("p_partkey") % 2 == 0, F.lit("/FR/I U")).otherwise(F.lit("")))
    q = p.select("p_partkey", x.name_parts(written).alias("n"), x.name_and_geography(placed).alias("g"))
    return q.select("p_partkey", "n.display", "n.location", "n.activity", "n.rest", F.col("g.name").alias("name"), F.col("g.location").alias("geo"))


_SUBS = ["ocean", "River", "surface water", "low. pop.", "pond", "", "agricultural"]


def _pick(n: str, shift: int) -> str:
    return "case " + " ".join(f"when {n} % 7 = {i} then '{_SUBS[(i + shift) % 7]}'" for i in range(7)) + " end"


@query(
    f"with s as (select event_id, lower({_pick('event_id', 0)}) as w, lower({_pick('(event_id // 7)', 2)}) as h from events) select event_id, case when w = '' then 3 when h = w then 0 when {_GROUPS.format(c='h')} = '' or {_GROUPS.format(c='w')} = '' then 3 when {_GROUPS.format(c='h')} = {_GROUPS.format(c='w')} then 1 else 2 end as rank from s"
)
def sub_compartment_ranks(spark: SparkSession, root: str) -> DataFrame:
    e = table(spark, root, "events").select("event_id")
    pick = lambda n, shift: F.array(*[F.lit(s) for s in _SUBS])[((n % 7) + shift) % 7]
    want, have = pick(F.col("event_id"), 0), pick(F.floor(F.col("event_id") / 7), 2)
    return e.select("event_id", x.sub_rank(want, F.array(F.lit("water"), have)).alias("rank"))


@query(
    "select record_id, array_to_string(list_filter(list_transform(categories, lambda c: trim(c, ' ')), lambda c: c <> ''), ' / ') as place, list_sort(list_distinct(regexp_extract_all(lower(coalesce(name, '')), '[a-z0-9]+'))) as words from flow_records where not list_contains(list_transform(categories, lambda c: lower(trim(c, ' '))), 'unspecified') and not list_contains(list_transform(categories, lambda c: lower(trim(c, ' '))), '(unspecified)') and not list_contains(list_transform(categories, lambda c: trim(c, ' ')), '')"
)
def label_texts(spark: SparkSession, root: str) -> DataFrame:
    bad = F.exists("categories", lambda c: F.lower(F.trim(c)).isin("unspecified", "(unspecified)", ""))
    f = table(spark, root, "flow_records").where(~bad)
    return f.select("record_id", x.joined_parts(F.col("categories")).alias("place"), F.array_sort(x.words(F.col("name"))).alias("words"))


@query("select l_orderkey, l_linenumber, case when l_linenumber % 3 = 0 then 'kilowatt hour' else 'megajoule' end as unit, round(case when l_linenumber % 3 = 0 then l_quantity / 3.6 else l_quantity end, 6) as amount from lineitem")
def electricity_units(spark: SparkSession, root: str) -> DataFrame:
    li = table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") % 3 == 0, "Electricity, low voltage").otherwise("Heat").alias("name"), F.lit("megajoule").alias("unit"), F.col("l_quantity").alias("amount"))
    return link.electricity_to_kwh(li, ["electricity"]).select("l_orderkey", "l_linenumber", "unit", rnd(F.col("amount")).alias("amount"))
