"""Corrections of an inventory before it is matched: deletions, waste, renames, rules.

Exchanges: activity_id, seq, name, type, amount, functional, linked and more; activities: activity_id, name, code, kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.operators.keep import keep_first


def promote_functional(exchanges: DataFrame) -> DataFrame:
    """Where no production row is functional and non-zero, functional technosphere rows become production and empty production rows go."""
    made = (F.col("type") == "production") & F.col("functional") & (F.col("amount") != 0)
    able = (F.col("type") == "technosphere") & F.col("functional")
    w = Window.partitionBy("activity_id")
    x = exchanges.withColumn("_p", ~F.coalesce(F.bool_or(made).over(w), F.lit(False)) & F.coalesce(F.bool_or(able).over(w), F.lit(False)))
    x = x.where(~(F.col("_p") & (F.col("type") == "production") & (F.col("amount") == 0)))
    return x.withColumn("type", F.when(F.col("_p") & able, "production").otherwise(F.col("type"))).drop("_p")


def fix_dummies(exchanges: DataFrame, marker: str) -> DataFrame:
    """A production row whose comment has the marker gets amount 1 and allocation 1; its siblings' allocation is 0."""
    stub = (F.col("type") == "production") & F.coalesce(F.col("comment").contains(marker), F.lit(False))
    any_ = F.coalesce(F.bool_or(stub).over(Window.partitionBy("activity_id")), F.lit(False))
    x = exchanges.withColumn("_any", any_).withColumn("_stub", stub)
    sibling = F.col("_any") & ~F.col("_stub") & (F.col("type") == "production")
    x = x.withColumn("amount", F.when(F.col("_stub"), 1.0).otherwise(F.col("amount"))).withColumn("functional", F.col("_stub") | F.col("functional"))
    return x.withColumn("allocation_factor", F.when(F.col("_stub"), 1.0).when(sibling, 0.0).otherwise(F.col("allocation_factor"))).drop("_any", "_stub")


def demote_unfunctional(exchanges: DataFrame) -> DataFrame:
    """Production rows that are not functional become technosphere, sign kept."""
    return exchanges.withColumn("type", F.when((F.col("type") == "production") & (F.col("functional") == F.lit(False)), "technosphere").otherwise(F.col("type")))


def with_output(activities: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Activities that have a production or functional technosphere row; products always stay."""
    able = exchanges.where((F.col("type") == "production") | ((F.col("type") == "technosphere") & F.col("functional"))).select("activity_id").distinct().withColumn("_a", F.lit(True))
    return activities.join(able, "activity_id", "left").where("kind = 'product' or _a").drop("_a")


def delete_listed(activities: DataFrame, exchanges: DataFrame, deletions: DataFrame) -> DataFrame:
    """Activities that no deletion names: by code, or by name where the deletion has no code.

    An activity with emissions but no technosphere input (a system process) stays, and so does a product (kind
    'product') that such a process makes, by the name or target_code of its production rows (where exchanges have them).
    """
    codes = deletions.where("code is not null").select(F.col("code")).distinct()
    names = deletions.where("code is null and name is not null").select(F.lower(F.trim("name")).alias("_n")).distinct()
    system = exchanges.groupBy("activity_id").agg(((F.count_if(F.col("type") == "technosphere") == 0) & (F.count_if(F.col("type") == "biosphere") > 0)).alias("_s")).where("_s")
    is_product = F.col("kind") == "product" if "kind" in activities.columns else F.lit(False)
    a = activities.withColumn("_n", F.lower(F.trim("name"))).withColumn("_product", F.coalesce(is_product, F.lit(False)))
    hit = a.join(codes, "code", "left_semi").unionByName(a.join(names, "_n", "left_semi").select(*["code", *[c for c in a.columns if c != "code"]])).distinct()
    kept = hit.where("not _product").join(system, "activity_id", "left_semi").select("activity_id")
    gone = hit.select("activity_id", "_n", "code", "_product").join(kept, "activity_id", "left_anti")
    made = exchanges.where(F.col("type").isin("production", "generic production")).join(kept.distinct(), "activity_id", "left_semi")
    for column, key in (("name", "_n"), ("target_code", "code")):
        if column in exchanges.columns:
            said = F.lower(F.trim(column)) if column == "name" else F.col(column)
            paired = made.select(said.alias(key)).where(F.col(key).isNotNull() & (F.col(key) != "")).distinct().withColumn("_paired", F.lit(True))
            gone = gone.join(paired, key, "left").where(~(F.col("_product") & F.coalesce("_paired", F.lit(False)))).drop("_paired")
    return activities.join(gone.select("activity_id"), "activity_id", "left_anti")


def drop_empty_unlinked(exchanges: DataFrame) -> DataFrame:
    """Without unlinked biosphere rows of no amount, and unlinked rows of the final waste compartment."""
    idle = (F.col("type") == "biosphere") & ~F.col("linked") & (F.coalesce(F.col("amount"), F.lit(0.0)) == 0)
    waste = ~F.col("linked") & F.coalesce(F.col("categories") == F.array(F.lit("Final waste flows")), F.lit(False))
    return exchanges.where(~idle & ~waste)


def apply_rules(rows: DataFrame, rules: DataFrame, on: list[str], patch: dict[str, str], multiplier: str | None = None, amount: str = "amount", seq: str = "seq") -> DataFrame:
    """Rows patched by the first rule whose fields are equal, letter case aside.

    patch: column of rows -> column of rules (null leaves the value). multiplier: rule column that rescales the
    amount (null or 0 is 1).
    """
    key = [F.lower(F.trim(c)) for c in on]
    used = rules.select(*[k.alias(f"_r{i}") for i, k in enumerate(key)], *[F.col(v).alias(f"_p{i}") for i, v in enumerate(patch.values())], *([F.col(multiplier).alias("_m")] if multiplier else []), F.col(seq).alias("_seq"))
    first = keep_first(used, [f"_r{i}" for i in range(len(on))], ["_seq"]).drop("_seq").withColumn("_hit", F.lit(True))
    out = rows.select("*", *[k.alias(f"_r{i}") for i, k in enumerate(key)]).join(first, [f"_r{i}" for i in range(len(on))], "left")
    changed: dict[str, Column] = {c: F.coalesce(F.col(f"_p{i}"), F.col(c)) for i, c in enumerate(patch)}
    if multiplier:
        changed[amount] = F.col(amount) * F.coalesce(F.when(F.col("_m") != 0, F.col("_m")), F.lit(1.0))
    return out.select(*[changed.get(c, F.col(c)).alias(c) for c in rows.columns])


def electricity_to_kwh(exchanges: DataFrame, prefixes: list[str]) -> DataFrame:
    """Megajoule of electricity as kilowatt hours."""
    is_power = F.lit(False)
    for p in prefixes:
        is_power = is_power | F.lower("name").startswith(p.lower())
    hit = is_power & (F.lower("unit") == "megajoule")
    return exchanges.withColumn("amount", F.when(hit, F.col("amount") / 3.6).otherwise(F.col("amount"))).withColumn("unit", F.when(hit, "kilowatt hour").otherwise(F.col("unit")))


def metadata_from_output(activities: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Activities with exactly one functional row take its name, unit and amount where they lack their own."""
    one = exchanges.where("functional").groupBy("activity_id").agg(F.count(F.lit(1)).alias("_n"), F.min("name").alias("_name"), F.min("unit").alias("_unit"), F.min("amount").alias("_amount")).where("_n = 1")
    out = activities.join(one, "activity_id", "left")
    return out.withColumn("name", F.coalesce("name", "_name")).withColumn("unit", F.coalesce("unit", "_unit")).withColumn("production_amount", F.coalesce("production_amount", "_amount")).drop("_n", "_name", "_unit", "_amount")


def add_regional_rows(catalog: DataFrame, used: DataFrame) -> DataFrame:
    """catalog with the rows '<code>@<region>' that used (db, code, region) asks for; unknown codes are skipped."""
    asked = used.where("region is not null and region <> ''").select("db", "code", "region").distinct()
    new = asked.join(catalog, ["db", "code"]).withColumn("code", F.concat("code", F.lit("@"), "region")).drop("region")
    new = new.join(catalog.select("db", "code"), ["db", "code"], "left_anti")
    return catalog.unionByName(new.select(*catalog.columns))


def locations_of(parsed: DataFrame, background: DataFrame, overrides: DataFrame) -> DataFrame:
    """col_id, location: an override, else the background's, else the parsed one."""
    p = parsed.select("col_id", F.col("location").alias("_p")).where("_p is not null").groupBy("col_id").agg(F.min("_p").alias("_p"))
    b = background.select("col_id", F.col("location").alias("_b")).where("_b is not null").groupBy("col_id").agg(F.min("_b").alias("_b"))
    o = overrides.select("col_id", F.col("location").alias("_o")).where("_o is not null").groupBy("col_id").agg(F.min("_o").alias("_o"))
    j = p.join(b, "col_id", "full_outer").join(o, "col_id", "full_outer")
    return j.select("col_id", F.coalesce("_o", "_b", "_p").alias("location"))


def coverage(exchanges: DataFrame) -> DataFrame:
    """type, total, linked, rate in percent (two decimals)."""
    g = exchanges.groupBy("type").agg(F.count(F.lit(1)).alias("total"), F.count_if("linked").alias("linked"))
    return g.withColumn("rate", F.round(F.lit(100.0) * F.col("linked") / F.greatest("total", F.lit(1)), 2))


def unlinked_counts(exchanges: DataFrame, dummy_prefix: str = "[Dummy]") -> DataFrame:
    """name, n of the unlinked rows, most frequent first."""
    u = exchanges.where(~F.col("linked") & ~F.col("name").startswith(dummy_prefix))
    return u.groupBy("name").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "name")


def flow_usage(records: DataFrame) -> DataFrame:
    """One row for each name: its units, compartments, a registry number, how often it stands and is linked."""
    place = F.array_join("categories", " / ")
    return records.groupBy(F.lower(F.trim("name")).alias("name")).agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("units")))).alias("units"), F.count_distinct(place).alias("n_places"), F.min("cas").alias("cas"), F.sum("n_exchanges").alias("n"), F.sum("n_linked").alias("linked")
    )
