"""The mapping registry: heterogeneous sources in, one table of prioritised mappings and its siblings out."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.exprs import bucket_of
from flowloom.functions.text import blank_to_null
from flowloom.operators.keep import keep_first
from flowloom.operators.match import TIERS
from flowloom.schema import conformed

#: What makes two mappings the same.
MAPPING_KEY = ["source_kind", "_name", "source_top_bucket", "source_cas", "target_db", "target_code", "target_name", "unit_conversion", "priority_tier"]


def mappings(rows: DataFrame, *, kind: str, tier: str, provenance: str, target_db: Column | None = None, unmatchable: bool = False, **columns: Column) -> DataFrame:
    """Rows of one source as mapping rows: columns gives the expressions of what the source has.

    Rows without a source name, and (unless unmatchable) without a target code or name, are left out.
    """
    context = columns.get("source_context", F.array().cast("array<string>"))
    have = {
        "source_kind": F.lit(kind), "source_top_bucket": bucket_of(context), "target_db": target_db if target_db is not None else F.lit(""), "unit_conversion": F.lit(1.0),
        "priority_tier": F.lit(TIERS[tier]), "provenance": F.lit(provenance), "is_unmatchable": F.lit(unmatchable), "source_context": context,
    } | columns
    out = rows.select(*[c.alias(n) for n, c in have.items()])
    keep = blank_to_null("source_name").isNotNull()
    if not unmatchable:
        names = [blank_to_null(c) for c in ("target_code", "target_name") if c in have]
        keep = keep & F.coalesce(*names).isNotNull() if names else F.lit(False)
    return conformed(out.where(keep), "mapping")


def from_rules(rules: DataFrame, *, tier: str, provenance: str, target_db: str = "", kind: str = "flow", unmatchable: bool = False) -> DataFrame:
    """A rule package (readers.read_rules) as mappings."""
    return mappings(
        rules, kind=kind, tier=tier, provenance=provenance, target_db=F.lit(target_db), unmatchable=unmatchable,
        source_name=F.col("source.name"), source_unit=F.col("source.unit"), source_context=F.coalesce("source.context", F.array().cast("array<string>")),
        target_code=F.col("target.identifier"), target_name=F.col("target.name"), target_unit=F.col("target.unit"), unit_conversion=F.col("factor"), provenance_row=F.col("seq").cast("string"), notes=F.col("comment"),
    )


def from_flow_list(flows: DataFrame, *, target_db: str, provenance: str) -> DataFrame:
    """A consensus flow list (readers.read_flow_list) as gap-filling mappings."""
    return mappings(flows, kind="flow", tier="harmonised", provenance=provenance, target_db=F.lit(target_db), source_name=F.col("label"), source_top_bucket=F.col("bucket"), target_code=F.col("code"), target_name=F.col("name"), provenance_row=F.col("row"))


def from_sheet(rows: DataFrame, *, tier: str, provenance: str, target_db: str, unmatchable: bool = False) -> DataFrame:
    """A curated sheet (readers.read_placeholder_sheet) as mappings by name."""
    return mappings(rows, kind="flow", tier=tier, provenance=provenance, target_db=F.lit(target_db), unmatchable=unmatchable, source_name=F.col("name"), source_unit=F.col("unit"), source_context=F.col("categories"), source_cas=F.col("cas"), target_name=F.col("target"), provenance_row=F.col("row").cast("string"))


def reviewed(rows: DataFrame, *, provenance: str) -> DataFrame:
    """Accepted suggestions: name, target_db, target_code, target_name, decision."""
    return mappings(rows.where("decision = 'accept'"), kind="flow", tier="reviewed_suggestion", provenance=provenance, target_db=F.col("target_db"), source_name=F.col("name"), source_top_bucket=F.lit("unspecified"), target_code=F.col("target_code"), target_name=F.col("target_name"))


def curated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Curated rows with a tier name (default: the first) as mappings and as unmatchable flows."""
    tiers = F.create_map(*[F.lit(x) for kv in TIERS.items() for x in kv])
    base = {"source_name": F.col("name"), "source_unit": F.col("unit"), "source_context": F.col("categories"), "target_code": F.col("target_code"), "target_name": F.col("target_name"), "priority_tier": F.coalesce(F.element_at(tiers, F.col("tier")), F.lit(1))}
    flag = F.coalesce("is_unmatchable", F.lit(False))
    good = mappings(rows.where(~flag), kind="flow", tier="curated_targeted", provenance="curated", target_db=F.col("target_db"), **base)
    return good, mappings(rows.where(flag), kind="flow", tier="unmatchable", provenance="curated", unmatchable=True, source_name=F.col("name"), source_context=F.col("categories"))


def build(sources: Iterable[DataFrame]) -> DataFrame:
    """One registry of several sources in order: equal mappings once, the first source's row counts."""
    every = None
    for i, s in enumerate(sources):
        one = s.withColumn("_src", F.lit(i))
        every = one if every is None else every.unionByName(one)
    marked = every.withColumn("_name", F.lower(F.trim("source_name")))
    return keep_first(marked, MAPPING_KEY, ["_src", "provenance_row"]).drop("_src", "_name")


def unit_conversions(sources: Iterable[DataFrame]) -> DataFrame:
    """source_unit, target_unit, multiplier, provenance: the first source that knows a pair counts."""
    every = None
    for i, s in enumerate(sources):
        one = conformed(s, "unit_conversion").withColumn("_src", F.lit(i))
        every = one if every is None else every.unionByName(one)
    return keep_first(every, ["source_unit", "target_unit"], ["_src", "provenance"]).drop("_src")


def unit_aliases(sources: Iterable[DataFrame]) -> DataFrame:
    """alias, alias_lower, canonical, provenance: the first source that knows an alias counts; aliases of themselves are left out."""
    every = None
    for i, s in enumerate(sources):
        one = conformed(s.withColumn("alias_lower", F.lower(F.trim("alias"))), "unit_alias").withColumn("_src", F.lit(i))
        every = one if every is None else every.unionByName(one)
    return keep_first(every.where("alias <> canonical"), ["alias_lower", "canonical"], ["_src", "provenance"]).drop("_src")


def canonical_unit(df: DataFrame, column: str, aliases: DataFrame, into: str) -> DataFrame:
    """`into`: the unit itself if it is canonical, else what it is an alias of, else as written with spaces for underscores."""
    canon = aliases.select(F.col("canonical").alias("_c")).distinct().withColumn("_is", F.lit(True))
    first = keep_first(aliases.select(F.col("alias_lower").alias("_al"), "canonical", "provenance"), ["_al"], ["provenance", "canonical"]).select("_al", F.col("canonical").alias("_to"))
    out = df.withColumn("_c", F.trim(column)).withColumn("_al", F.lower(F.trim(column))).join(canon, "_c", "left").join(first, "_al", "left")
    return out.withColumn(into, F.when(F.col("_is"), F.col("_c")).otherwise(F.coalesce("_to", F.replace("_c", F.lit("_"), F.lit(" "))))).drop("_c", "_al", "_is", "_to")


def deletions(process_rules: DataFrame, product_rules: DataFrame) -> DataFrame:
    """name, code, kind, provenance of the entries that two rule packages delete."""
    one = lambda r, kind: r.select(F.col("source.name").alias("name"), F.col("source.identifier").alias("code"), F.lit(kind).alias("kind"), F.lit("rules").alias("provenance"))
    return one(process_rules, "process").unionByName(one(product_rules, "product")).where("name is not null or code is not null").distinct()


def target_index(factors: DataFrame) -> DataFrame:
    """Distinct flows of a factor table (code, name, unit, categories, cas, seq), the first row counts."""
    f = keep_first(factors, ["code"], ["seq"])
    return conformed(f.withColumn("name_lower", F.lower(F.trim("name"))).withColumn("bucket", bucket_of(F.col("categories"))), "target_index")
