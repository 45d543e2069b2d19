"""Technosphere linking in passes, region suffixes of water flows, and matches applied to exchanges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.functions.exprs import regional_suffix
from flowloom.functions.text import blank_to_null
from flowloom.operators.catalog import resolve_names
from flowloom.operators.keep import keep_first, unique_lookup
from flowloom.operators.link import apply_rules, electricity_to_kwh
from flowloom.session import checkpointed

#: Fixed value: what stands between the code of a flow and its region, and the word that names of such flows begin with.
SEPARATOR, WATER = "@", "water"


def country_codes(spark) -> list[str]:
    """All two-letter country codes, as the JVM's ISO 3166 table has them."""
    return sorted(spark._jvm.java.util.Locale.getISOCountries())


def unit_rescaled(exchanges: DataFrame, conversions: DataFrame) -> DataFrame:
    """Amounts in the first unit that each unit converts to (by seq), letter case aside; other units stay.

    exchanges: unit, amount. conversions: source_unit, target_unit, multiplier, seq. `converted` tells which changed.
    """
    key = F.lower(F.trim("unit"))
    usable = conversions.where("multiplier is not null and source_unit is not null and trim(source_unit) <> ''")
    first = keep_first(usable.select(F.lower(F.trim("source_unit")).alias("_u"), F.col("target_unit").alias("_t"), F.col("multiplier").alias("_m"), "seq"), ["_u"], ["seq"]).drop("seq")
    out = exchanges.withColumn("_u", key).join(first, "_u", "left").drop("_u")
    hit = F.col("_m").isNotNull()
    out = out.withColumn("amount", F.when(hit, F.col("amount") * F.col("_m")).otherwise(F.col("amount"))).withColumn("unit", F.when(hit, F.col("_t")).otherwise(F.col("unit")))
    return out.withColumn("converted", hit).drop("_m", "_t")


def _keys(full: bool) -> dict[str, Column]:
    name = {"k_name": F.lower(F.trim(F.coalesce("name", F.lit("")))), "k_unit": F.coalesce("unit", F.lit("")), "k_location": F.coalesce("location", F.lit(""))}
    return name | ({"k_product": F.lower(F.trim(F.coalesce("product", F.lit(""))))} if full else {})


def _linked_once(rows: DataFrame, catalog: DataFrame, full: bool) -> DataFrame:
    """rows with code of the only activity of the same name, unit, location (and product, if full); null if none or several."""
    keys = _keys(full)
    one = unique_lookup(catalog.select(*[c.alias(n) for n, c in keys.items()], F.col("code").alias("_code")), list(keys), ["_code"])
    return rows.select("*", *[c.alias(n) for n, c in keys.items()]).join(one, list(keys), "left").drop(*keys)


def techno_match(exchanges: DataFrame, catalog: DataFrame, conversions: DataFrame, fixes: DataFrame, redirects: DataFrame, power: list[str]) -> DataFrame:
    """exc_id, code, match_pass, amount, unit of every exchange; code and match_pass are null where nothing fits.

    exchanges: exc_id, name, unit, location, product, amount. catalog: code, name, unit, location, product. In order,
    each pass with the rows still open: (electricity in kilowatt hours first) 1 name, unit, location and product;
    2 the same after unit conversion; 3 the same after fixes (name, new_name, new_location, new_product, seq; null leaves
    the field); 4 without the product; 5 a name that a redirect (name, code) names; 6 names of the form
    'display {LOC}| activity | ...' whose activity has the same unit. Only a single hit counts. Each pass joins the open
    rows only.
    """
    columns = ["exc_id", "name", "unit", "location", "product", "amount"]
    rest = electricity_to_kwh(exchanges.select(*columns), power)
    found = None

    def settle(hit: DataFrame, number: int) -> None:
        nonlocal found, rest
        hit = checkpointed(hit)
        one = hit.where("_code is not null").select("exc_id", F.col("_code").alias("code"), F.lit(number).alias("match_pass"), "amount", "unit")
        found = one if found is None else found.unionByName(one)
        rest = hit.where("_code is null").select(*columns)

    settle(_linked_once(rest, catalog, True), 1)
    rest = unit_rescaled(rest, conversions).drop("converted")
    settle(_linked_once(rest, catalog, True), 2)
    rest = apply_rules(rest, fixes, ["name"], {"name": "new_name", "location": "new_location", "product": "new_product"})
    settle(_linked_once(rest, catalog, True), 3)
    settle(_linked_once(rest, catalog, False), 4)
    named = unique_lookup(redirects.select("name", F.col("code").alias("_code")), ["name"], ["_code"])
    settle(rest.join(named, "name", "left"), 5)
    names = rest.select("name").where("name is not null").distinct().withColumn("id", F.xxhash64("name"))
    meant = resolve_names(names, catalog).where("code is not null").join(names, "id").select("name", F.col("code").alias("_code"))
    meant = meant.join(catalog.groupBy(F.col("code").alias("_code")).agg(F.min(F.lower(F.trim("unit"))).alias("_unit")), "_code")
    hit = rest.join(meant, "name", "left").withColumn("_code", F.when(F.lower(F.trim("unit")).eqNullSafe(F.col("_unit")), F.col("_code"))).drop("_unit")
    settle(hit, 6)
    none = rest.select("exc_id", F.lit(None).cast("string").alias("code"), F.lit(None).cast("int").alias("match_pass"), "amount", "unit")
    return found.unionByName(none)


def region_sweep(exchanges: DataFrame, databases: list[str], countries: list[str] | None = None) -> DataFrame:
    """exchanges with t_code '<code>@<region>' where a water flow's name carried a region, and `swept` to tell which.

    exchanges: t_db, t_code, name, and source_name or written_name where they are kept. The first of source_name,
    written_name and name that says something is read; only targets in `databases` whose own name begins with water
    and that have no region yet are rewritten.
    """
    known = countries or country_codes(exchanges.sparkSession)
    said = [blank_to_null(c) for c in ("source_name", "written_name", "name") if c in exchanges.columns]
    region = regional_suffix(F.coalesce(*said), known)["region"]
    hit = F.col("t_code").isNotNull() & ~F.col("t_code").contains(SEPARATOR) & F.col("t_db").isin(list(databases)) & F.lower(F.trim("name")).startswith(WATER) & (region != "")
    out = exchanges.withColumn("swept", F.coalesce(hit, F.lit(False)))
    return out.withColumn("t_code", F.when(F.col("swept"), F.concat("t_code", F.lit(SEPARATOR), region)).otherwise(F.col("t_code")))


def apply_matches(exchanges: DataFrame, matched: DataFrame, target_units: DataFrame, databases: list[str], countries: list[str] | None = None) -> DataFrame:
    """exchanges (exc_id, name, unit, amount and more) with t_db, t_code, amount and unit of their match.

    matched: exc_id, t_db, t_code, multiplier. A multiplier other than 1 rescales the amount and puts the target's
    unit (target_units: t_db, t_code, t_unit) in its place. Water targets in `databases` get the region of the name.
    Exchanges without a match stay as they are, with null targets.
    """
    units = target_units.groupBy("t_db", "t_code").agg(F.min("t_unit").alias("t_unit"))
    out = exchanges.join(matched.select("exc_id", "t_db", "t_code", "multiplier").join(units, ["t_db", "t_code"], "left"), "exc_id", "left")
    scaled = F.coalesce(F.col("multiplier") != 1, F.lit(False))
    out = out.withColumn("amount", F.when(scaled, F.col("amount") * F.col("multiplier")).otherwise(F.col("amount"))).withColumn("unit", F.when(scaled, F.coalesce("t_unit", "unit")).otherwise(F.col("unit")))
    return region_sweep(out.drop("multiplier", "t_unit"), databases, countries)
