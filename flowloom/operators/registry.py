"""Catalogues and the registry of impact factors, built from snapshots, factor tables and curated rules."""

from __future__ import annotations

from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.exprs import bucket_of, method_root, normal_method
from flowloom.operators import cf as factors
from flowloom.operators.keep import insert_if_absent, keep_first

CATALOG = ["db", "code", "name", "categories", "unit", "cas", "synonyms"]
#: Resource flows of the factor table and the catalogue names (top compartment natural resource) that
#: take their factor.
WATER_TARGETS = {
    "lake water": "water, lake",
    "river water": "water, river",
    "ground water": "water, well, in ground",
    "water": "water, unspecified natural origin",
    "water to cooling": "water, cooling, unspecified natural origin",
    "water to turbine": "water, turbine use, unspecified natural origin",
}
#: Factor to the registry's unit by method and unit of the flow; 1 for all others.
UNIT_SCALES = {("water use", "kg"): 1000.0, ("water use", "m3"): 1.0}
#: Long compartment paths of the catalogue and the compartment and sub-compartment of the factor table.
LONG_CONTEXTS = {
    ("Emissions", "Emissions to air", "Emissions to urban air close to ground"): ("Air", "high. pop."),
    ("Emissions", "Emissions to air", "Emissions to non-urban air close to ground"): ("Air", "low. pop."),
    ("Emissions", "Emissions to air", "Emissions to non-urban air or from high stacks"): ("Air", "low. pop."),
    ("Emissions", "Emissions to air", "Emissions to urban air low stack"): ("Air", "high. pop."),
    ("Emissions", "Emissions to air", "Emissions to urban air high stack"): ("Air", "high. pop."),
    ("Emissions", "Emissions to air", "Emissions to urban air very high stack"): ("Air", "high. pop."),
    ("Emissions", "Emissions to air", "Emissions to non-urban air low stack"): ("Air", "low. pop."),
    ("Emissions", "Emissions to air", "Emissions to non-urban air high stack"): ("Air", "low. pop."),
    ("Emissions", "Emissions to air", "Emissions to non-urban air very high stack"): ("Air", "low. pop."),
    ("Emissions", "Emissions to air", "Emissions to lower stratosphere and upper troposphere"): ("Air", "stratosphere + troposphere"),
    ("Emissions", "Emissions to air", "Emissions to air, indoor"): ("Air", "indoor"),
    ("Emissions", "Emissions to air", "Emissions to air, unspecified"): ("Air", "(unspecified)"),
    ("Emissions", "Emissions to air", "Emissions to air, unspecified (long-term)"): ("Air", "low. pop., long-term"),
    ("Emissions", "Emissions to water", "Emissions to fresh water"): ("Water", "river"),
    ("Emissions", "Emissions to water", "Emissions to sea water"): ("Water", "ocean"),
    ("Emissions", "Emissions to water", "Emissions to water, unspecified"): ("Water", "(unspecified)"),
    ("Emissions", "Emissions to water", "Emissions to water, unspecified (long-term)"): ("Water", "groundwater, long-term"),
    ("Emissions", "Emissions to soil", "Emissions to agricultural soil"): ("Soil", "agricultural"),
    ("Emissions", "Emissions to soil", "Emissions to non-agricultural soil"): ("Soil", "industrial"),
    ("Emissions", "Emissions to soil", "Emissions to soil, unspecified"): ("Soil", "(unspecified)"),
    ("Resources", "Resources from ground", "Non-renewable element resources from ground"): ("Raw", "(unspecified)"),
    ("Resources", "Resources from ground", "Non-renewable energy resources from ground"): ("Raw", "(unspecified)"),
    ("Resources", "Resources from water", "Renewable material resources from water"): ("Raw", "in water"),
    ("Resources", "Resources from air", "Renewable material resources from air"): ("Raw", "(unspecified)"),
    ("Land use", "Land transformation"): ("Raw", "(unspecified)"),
    ("Land use", "Land occupation"): ("Raw", "(unspecified)"),
}


def flow_catalog(sources: list[DataFrame | None]) -> DataFrame:
    """db, code, name, categories, unit, cas, synonyms of all sources, blanks for what is missing; absent sources are skipped.

    A code stands once in a database: the first source counts, then the first name.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    words = lambda c: F.coalesce(F.filter(c, lambda x: x.isNotNull()), F.array().cast("array<string>")).alias(c)
    every = None
    for i, s in enumerate(x for x in sources if x is not None):
        one = s.select("db", text("code"), text("name"), words("categories"), text("unit"), F.nullif("cas", F.lit("")).alias("cas"), words("synonyms"), F.lit(i).alias("_i"))
        every = one if every is None else every.unionByName(one)
    if every is None:
        raise ValueError("no source")
    return keep_first(every, ["db", "code"], ["_i", "name"]).select(*CATALOG)


def with_bucket(catalog: DataFrame, databases: list[str] | None = None) -> DataFrame:
    """The catalogue of some databases (a filter that reaches the scan) with the compartment of each flow."""
    rows = catalog.where(F.col("db").isin(list(databases))) if databases else catalog
    return rows.withColumn("bucket", bucket_of(F.col("categories")))


def activity_catalog(activities: DataFrame, db: str) -> DataFrame:
    """db, code, name, unit, location, product of a snapshot whose product key is spelled in one of two ways."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    both = [F.nullif(F.col(f"`{c}`"), F.lit("")) for c in ("reference_product", "reference product") if c in activities.columns]
    product = F.coalesce(*both, F.lit("")) if both else F.lit("")
    return activities.select(F.lit(db).alias("db"), *[text(c).alias(c) for c in ("code", "name", "unit", "location")], product.alias("product"))


def needed_flows(flows: DataFrame, used: list[DataFrame]) -> DataFrame:
    """flows whose code one of the used tables (code) names."""
    codes = None
    for u in used:
        one = u.select("code").where("code is not null")
        codes = one if codes is None else codes.unionByName(one)
    return flows.join(codes.distinct(), "code", "left_semi")


def contexts(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """rows (categories) with comp and sub of the factor table.

    rules: source_context, target_context, seq. A rule whose source is a compartment of the table gives, turned round,
    the sub-compartment of its target; the first one counts. Long paths come from the fixed table before that.
    """
    comps = [*factors.TABLE_COMPARTMENTS.values()]
    usable = rules.where((F.size("source_context") > 0) & (F.size("target_context") > 0) & F.get("source_context", F.lit(0)).isin(comps))
    sub = F.coalesce(F.nullif(F.get("source_context", F.lit(1)), F.lit("")), F.lit(factors.UNSPECIFIED))
    back = keep_first(usable.select(F.transform("target_context", F.lower).alias("_k"), sub.alias("_sub"), "seq"), ["_k"], ["seq"]).drop("seq")
    long = F.lit(False)
    for path in LONG_CONTEXTS:
        long = long | F.coalesce(F.col("categories") == F.array(*[F.lit(p) for p in path]), F.lit(False))
    out = rows.withColumn("_k", F.transform("categories", F.lower)).join(back, "_k", "left").withColumn("_c", factors.table_context(F.col("categories"), LONG_CONTEXTS))
    return out.select(*rows.columns, F.col("_c.comp").alias("comp"), F.when(long, F.col("_c.sub")).otherwise(F.coalesce("_sub", "_c.sub")).alias("sub"))


def unit_scale(method: Column, unit: Column) -> Column:
    out = F.lit(1.0)
    for (m, u), scale in UNIT_SCALES.items():
        out = F.when((F.lower(method) == m) & (unit == u), scale).otherwise(out)
    return out


def method_aliases(methods: DataFrame, aliases: DataFrame) -> DataFrame:
    """methods (method) with the registry's name and indicator; null where no alias is known. aliases: method, key, indicator."""
    a = keep_first(aliases.select(F.col("method").alias("_m"), "key", "indicator"), ["_m"], ["key", "indicator"])
    return methods.withColumn("_m", method_root(F.col("method"))).join(a, "_m", "left").drop("_m")


def comparable_methods(methods: DataFrame, wanted: list[str]) -> DataFrame:
    """Methods of which one of the wanted texts is a part, letter case aside; all if none is wanted."""
    hit = F.lit(not wanted)
    for w in wanted:
        hit = hit | F.contains(F.lower("method"), F.lit(w.lower()))
    return methods.where(hit).withColumn("normal", normal_method(F.col("method")))


def method_slug(parts: list[str]) -> str:
    """Parts percent-encoded, underscores too, joined by two underscores: one name for each tuple."""
    return "__".join(quote(p, safe="").replace("_", "%5F") for p in parts)


def method_of_slug(slug: str) -> tuple[str, ...]:
    return tuple(unquote(p) for p in slug.split("__")) if slug else ()


def slug_column(parts: Column) -> Column:
    """The same for a column of lists, in the JVM (form encoding, mended where it differs from percent encoding)."""

    def one(p: Column) -> Column:
        e = F.url_encode(p)
        for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("_", "%5F")):
            e = F.replace(e, F.lit(a), F.lit(b))
        return e

    return F.array_join(F.transform(parts, one), "__")


def water_rows(table: DataFrame, catalog: DataFrame, databases: list[str]) -> DataFrame:
    """db, code, cf of catalogue flows that take the global factor of a resource flow under another name.

    table: method-filtered factor rows (name, location, cf, seq). The row without a location counts, else the mean.
    """
    names = table.sparkSession.createDataFrame(list(WATER_TARGETS.items()), "flow string, _n string")
    g = factors.global_factors(table.select(F.lit("w").alias("method"), F.lower(F.trim("name")).alias("flow"), "location", "cf", "name", "seq")).select("flow", "cf")
    top = F.lower(F.trim(F.get("categories", F.lit(0))))
    flows = catalog.where(F.col("db").isin(list(databases)) & (top == "natural resource")).select("db", "code", F.lower(F.trim("name")).alias("_n"))
    return keep_first(flows.join(F.broadcast(names), "_n").join(g, "flow").select("db", "code", "cf"), ["db", "code"], ["cf"])


def factors_by_name(table: DataFrame, catalog: DataFrame, existing: DataFrame, databases: list[str]) -> DataFrame:
    """db, code, cf of catalogue flows (name and top compartment) that a factor table has and `existing` (db, code) lacks.

    table: name, compartment, cf, seq; zeros don't count, the first factor of a name and compartment does. For analysis.
    """
    top = F.lower(F.trim("compartment"))
    alias = F.when(top == "raw", "natural resource").otherwise(top)
    t = keep_first(table.where("cf is not null and cf <> 0").select(F.lower(F.trim("name")).alias("_n"), alias.alias("_t"), "cf", "seq"), ["_n", "_t"], ["seq"]).drop("seq")
    flows = catalog.where(F.col("db").isin(list(databases))).select("db", "code", F.lower(F.trim("name")).alias("_n"), F.lower(F.trim(F.get("categories", F.lit(0)))).alias("_t"))
    return flows.join(t, ["_n", "_t"]).select("db", "code", "cf").join(existing.select("db", "code").distinct(), ["db", "code"], "left_anti")


def regional_flow_rows(catalog: DataFrame, regional: DataFrame, base: DataFrame) -> DataFrame:
    """db, code, cf of regional rows '<code>@<region>' of resource flows whose base flow has a factor (base: db, code).

    regional: region, cf. Emissions get none.
    """
    at = F.split("code", "@")
    rows = catalog.where(F.contains("code", F.lit("@")) & (bucket_of(F.col("categories")) == "resource")).select("db", "code", at[0].alias("_base"), at[1].alias("region"))
    return rows.join(base.select("db", F.col("code").alias("_base")).distinct(), ["db", "_base"], "left_semi").join(regional.groupBy("region").agg(F.min("cf").alias("cf")), "region").select("db", "code", "cf")


def method_registry(own: DataFrame, inherited: DataFrame, additions: list[DataFrame], catalog: DataFrame, table: DataFrame, synonyms: DataFrame, excluded: DataFrame, checked_dbs: list[str], exempt: list[str] = ()) -> DataFrame:
    """method, db, code, cf of every method: own factors, inherited ones where it has none, additions, then what the table knows.

    own, inherited, additions: method, db, code, cf; an earlier row is never replaced. Flows get name, top compartment and
    registry number from the catalogue for the filter (operators.cf.filter_cascade); table, synonyms and excluded as there.
    """
    rows = own.select("method", "db", "code", "cf")
    for more in (inherited, *additions):
        rows = insert_if_absent(rows, more.select("method", "db", "code", "cf").distinct(), ["method", "db", "code"])
    labels = keep_first(catalog.select("db", "code", "name", F.get("categories", F.lit(0)).alias("top"), "cas"), ["db", "code"], ["name"])
    named = rows.join(labels, ["db", "code"], "left")
    return factors.filter_cascade(named, table, synonyms, excluded, checked_dbs, exempt).select("method", "db", "code", "cf")


def registry_index(registry: DataFrame, regional: DataFrame) -> DataFrame:
    """method, n_cfs, n_regional: how many factors each method has."""
    a = registry.groupBy("method").agg(F.count(F.lit(1)).alias("n_cfs"))
    b = regional.groupBy("method").agg(F.count(F.lit(1)).alias("n_regional"))
    return a.join(b, "method", "left").withColumn("n_regional", F.coalesce("n_regional", F.lit(0).cast("long")))


def open_residual(residual: DataFrame, unmatchable: DataFrame, reviewed: DataFrame) -> DataFrame:
    """residual rows (name) that are neither known to be unmatchable nor reviewed already (name, letter case aside)."""
    n = F.lower(F.trim("name"))
    done = unmatchable.select(n.alias("_n")).unionByName(reviewed.select(n.alias("_n"))).distinct()
    return residual.withColumn("_n", n).join(done, "_n", "left_anti").drop("_n")


def of_version(methods: DataFrame, version: str) -> DataFrame:
    """Methods (parts: four texts) of one version."""
    return methods.where((F.size("parts") == 4) & (F.get("parts", F.lit(1)) == version))
