"""Labels of exchanges brought to one style: compartments, names, codes, factors of rule tables.

Exchanges: type, name, categories, location and more. Every step takes and gives a DataFrame, so that chains of
steps are composed with DataFrame.transform.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.exprs import without_unspecified
from flowloom.operators.keep import keep_first, unique_lookup

#: Top compartments of the written style, and what the catalogue calls them.
TOP = {
    "Economic issues": "economic",
    "Emissions to air": "air",
    "Emissions to soil": "soil",
    "Emissions to water": "water",
    "Non material emissions": "non-material",
    "Non mat.": "non-material",
    "Resources": "natural resource",
    "Social issues": "social",
    "Economic": "economic",
    "Air": "air",
    "Soil": "soil",
    "Water": "water",
    "Raw": "natural resource",
    "Waste": "waste",
}
#: The same for sub-compartments.
SUB = {
    "groundwater": "ground-",
    "groundwater, long-term": "ground-, long-term",
    "high. pop.": "urban air close to ground",
    "low. pop.": "non-urban air or from high stacks",
    "low. pop., long-term": "low population density, long-term",
    "stratosphere + troposphere": "lower stratosphere + upper troposphere",
    "river": "surface water",
    "river, long-term": "surface water",
    "lake": "surface water",
}
#: Factors of rules that record a heat content instead of its reciprocal, by source name, source unit
#: and target unit.
INVERTED = {
    ("Energy, from uranium", "MJ", "kg"): 1.0 / 560_000.0,
    ("Energy, from coal, brown", "MJ", "kg"): 1.0 / 9.9,
    ("Energy, from peat", "MJ", "kg"): 1.0 / 9.9,
    ("Energy, from gas, natural", "MJ", "Sm3"): 1.0 / 40.3,
    ("Energy, from gas, natural", "MJ", "cubic meter"): 1.0 / 40.3,
    ("Energy, from hydro power", "MJ", "MJ"): 1.0,
}
#: Rules without a factor, by source name and unit, their factor, and where they are redirected.
MISSING = {("Water", "kg"): 0.001, ("Manganese-55", "Bq"): 0.001}
REDIRECTED = ("Manganese-55", "Bq", "Manganese-54", "kBq", "729eac4f-0339-4d0f-8956-a71ebe20a527")


class UnexpectedRule(ValueError):
    """A rule without a factor that no patch is known for."""


def _mapped(value: Column, table: dict[str, str]) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), value), value)


def _of_biosphere() -> Column:
    return F.col("type") == "biosphere"


def compartments(exchanges: DataFrame) -> DataFrame:
    """Biosphere rows: top and sub-compartment in the catalogue's style; further elements are dropped. Empty lists stay."""
    c = F.col("categories")
    new = F.when(F.size(c) > 1, F.array(_mapped(F.get(c, F.lit(0)), TOP), _mapped(F.get(c, F.lit(1)), SUB))).otherwise(F.array(_mapped(F.get(c, F.lit(0)), TOP)))
    return exchanges.withColumn("categories", F.when(_of_biosphere() & (F.size(c) > 0), new).otherwise(c))


def names_by_compartment(exchanges: DataFrame, names: DataFrame) -> DataFrame:
    """Biosphere rows renamed by (first category, name). names: category, name, new_name, seq (the last one counts)."""
    last = keep_first(names.select(F.col("category").alias("_c"), F.col("name").alias("_n"), F.col("new_name").alias("_new"), "seq"), ["_c", "_n"], [-F.col("seq")]).drop("seq")
    out = exchanges.withColumn("_c", F.when(_of_biosphere(), F.get("categories", F.lit(0)))).withColumn("_n", F.col("name")).join(last, ["_c", "_n"], "left")
    return out.withColumn("name", F.coalesce("_new", "name")).select(*exchanges.columns)


def migrated(exchanges: DataFrame, rules: DataFrame, field: str) -> DataFrame:
    """A field of exchanges replaced where a rule names exactly its value (and type, if the rule has one).

    rules: old, new (of the field's type), seq; the first rule counts.
    """
    first = keep_first(rules.select(F.col("old").alias("_o"), F.col("new").alias("_w"), "seq"), ["_o"], ["seq"]).drop("seq")
    out = exchanges.withColumn("_o", F.col(field)).join(first, "_o", "left")
    return out.withColumn(field, F.coalesce("_w", field)).select(*exchanges.columns)


def without_flow_location(exchanges: DataFrame) -> DataFrame:
    """Biosphere rows have no location."""
    return exchanges.withColumn("location", F.when(~F.coalesce(_of_biosphere(), F.lit(False)), F.col("location")))


def without_unspecified_subs(exchanges: DataFrame) -> DataFrame:
    return exchanges.withColumn("categories", F.when(_of_biosphere(), without_unspecified(F.col("categories"))).otherwise(F.col("categories")))


def chained(df: DataFrame, steps: list[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    return reduce(lambda d, f: d.transform(f), steps, df)


def biosphere_labels(exchanges: DataFrame, names: DataFrame, category_rules: DataFrame, name_rules: DataFrame) -> DataFrame:
    """The whole chain: compartments, names by compartment, two migrations, no flow location, no unspecified subs."""
    return chained(
        exchanges,
        [
            compartments,
            lambda d: names_by_compartment(d, names),
            lambda d: migrated(d, category_rules, "categories"),
            lambda d: migrated(d, name_rules, "name"),
            without_flow_location,
            without_unspecified_subs,
        ],
    )


def standard_labels(exchanges: DataFrame) -> DataFrame:
    """Unlinked rows take categories from `context` and code from `identifier` where they have none."""
    open_ = F.col("target_code").isNull()
    out = exchanges.withColumn("categories", F.when(open_, F.coalesce("categories", "context")).otherwise(F.col("categories")))
    return out.withColumn("code", F.when(open_, F.coalesce("code", "identifier")).otherwise(F.col("code")))


def remembered_names(exchanges: DataFrame) -> DataFrame:
    """source_name: the name before any renaming, set once and kept from then on."""
    known = F.col("source_name") if "source_name" in exchanges.columns else F.lit(None).cast("string")
    return exchanges.withColumn("source_name", F.when(_of_biosphere(), F.coalesce(known, F.col("name"))).otherwise(known))


def linked_only(exchanges: DataFrame, drop: bool = False) -> DataFrame:
    """Rows with a target; all rows unless dropping is asked for."""
    return exchanges.where("target_code is not null") if drop else exchanges


def link_by_hash(exchanges: DataFrame, targets: DataFrame, fields: list[str], types: list[str] | None = None) -> DataFrame:
    """exchanges with target_code of the only target whose fields are the same, letter case aside; linked rows stay.

    types: only exchanges of these types. Fields are compared one after the other without a separator, as their hash is.
    """
    h = F.md5(F.lower(F.concat(*[F.coalesce(F.col(f).cast("string"), F.lit("")) for f in fields])))
    one = unique_lookup(targets.select(h.alias("_h"), F.col("code").alias("_t")), ["_h"], ["_t"])
    wanted = F.col("target_code").isNull() & (F.col("type").isin(types) if types else F.lit(True))
    out = exchanges.withColumn("_h", F.when(wanted, h)).join(one, "_h", "left")
    return out.withColumn("target_code", F.coalesce("target_code", "_t")).select(*exchanges.columns)


def patched_rules(rules: DataFrame) -> DataFrame:
    """Rules with sound factors, and `patch` ('inverted', 'missing' or null) to tell what was changed.

    rules: source_name, source_unit, target_name, target_unit, target_code, conversion_factor. Heat contents become
    their reciprocal, missing (NaN) factors their known value, one isotope is redirected. A missing factor without a
    known value is marked 'unexpected': check_rules raises for it.
    """
    f, missing = F.col("conversion_factor"), F.isnan("conversion_factor")
    inverted, known = F.lit(None).cast("double"), F.lit(None).cast("double")
    for (name, unit, target), value in INVERTED.items():
        inverted = F.when((F.col("source_name") == name) & (F.col("source_unit") == unit) & (F.col("target_unit") == target), value).otherwise(inverted)
    for (name, unit), value in MISSING.items():
        known = F.when(missing & (F.col("source_name") == name) & (F.col("source_unit") == unit), value).otherwise(known)
    name, unit, to, to_unit, code = REDIRECTED
    moved = F.coalesce(missing & (F.col("source_name") == name) & (F.col("source_unit") == unit), F.lit(False))
    out = rules.withColumn("_moved", moved).withColumn("patch", F.when(known.isNotNull(), "missing").when(inverted.isNotNull(), "inverted").when(missing, "unexpected")).withColumn("conversion_factor", F.coalesce(inverted, known, f))
    for column, value in (("target_name", to), ("target_unit", to_unit), ("target_code", code)):
        out = out.withColumn(column, F.when(F.col("_moved"), value).otherwise(F.col(column)))
    return out.drop("_moved")


def check_rules(patched: DataFrame) -> DataFrame:
    bad = patched.where("patch = 'unexpected'").select("source_name", "source_unit").limit(5).collect()
    if bad:
        raise UnexpectedRule(f"no factor: {[tuple(b) for b in bad]}")
    return patched
