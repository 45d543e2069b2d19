"""What leaves the engine: labelled packages, review lists, comparison summaries, evidence for reports."""

from __future__ import annotations

import json
import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.operators.keep import keep_first, top_per_group
from flowloom.operators.registry import method_slug

#: Types of entries that can be scored, those of a smoke run, and the mark of stand-ins.
SCOREABLE = ("process", "processwithreferenceproduct", "product", "multifunctional")
SMOKE, DUMMY = ("process", "multifunctional"), "[Dummy]"
#: Flows named as evidence are at least this share of a score, and at most so many.
LEAST_SHARE, EVIDENCE = 0.01, 6
#: Fixed value: what stands between the elements of a compartment in exported text.
CATEGORY_SEPARATOR = "::"


class Unnamed(ValueError):
    """Rows of an export without a name, database or code."""


def scoreable(entries: DataFrame, types: tuple[str, ...] = SCOREABLE) -> DataFrame:
    """Entries (type) that can be scored."""
    return entries.where(F.col("type").isin(list(types)))


def smoke_entries(entries: DataFrame, n: int) -> DataFrame:
    """The first n entries (name, seq) of the smoke types that are no stand-ins, in the table's order."""
    return entries.where(F.col("type").isin(list(SMOKE)) & ~F.startswith("name", F.lit(DUMMY))).orderBy("seq").limit(n)


def first_rows(table: DataFrame, seq: str, n: int | None) -> DataFrame:
    """The first n rows in the table's own order; all if n is not given."""
    return table if n is None else table.orderBy(seq).limit(n)


def dealt(ids: DataFrame, column: str, parts: int) -> DataFrame:
    """ids with `part`, the number of the worker that takes each: round robin over the sorted ids, without sorting them in one task."""
    hit = ids.select(column).where(F.col(column).isNotNull()).distinct()
    ranged = hit.repartitionByRange(column).sortWithinPartitions(column)
    return ranged.withColumn("part", F.pmod(F.monotonically_increasing_id() % (1 << 33) + F.spark_partition_id(), F.lit(parts)).cast("int"))


def product_labels(products: DataFrame, catalog: DataFrame) -> DataFrame:
    """product_id of every row of the system with its labels (null where the catalogue lacks it), once each."""
    labels = ["name", "code", "database", "type", "unit"]
    return products.select("product_id").distinct().join(keep_first(catalog.select("product_id", *labels), ["product_id"], ["database", "code"]), "product_id", "left")


def activity_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """col_id, name, unit, location, reference_product, database, code, production_product_id; raises Unnamed.

    pairs: col_id, product_id. labels: activity_id and the texts.
    """
    texts = ["name", "unit", "location", "reference_product", "database", "code"]
    one = keep_first(labels.select(F.col("activity_id").alias("col_id"), *texts), ["col_id"], ["database", "code"])
    out = pairs.select("col_id", F.col("product_id").alias("production_product_id")).join(one, "col_id", "left")
    return fully_named(out, ["name", "database", "code"], "activities")


def flow_labels(flows: DataFrame, labels: DataFrame, corrections: DataFrame) -> DataFrame:
    """bioflow_id, is_correction, name, categories (as text), unit, database, code; corrections: flow_id, name."""
    one = keep_first(labels.select("flow_id", "name", F.array_join("categories", CATEGORY_SEPARATOR).alias("categories"), "unit", "database", "code"), ["flow_id"], ["database", "code"])
    made = corrections.select("flow_id", F.col("name").alias("_c")).distinct()
    out = flows.select("flow_id").distinct().join(one, "flow_id", "left").join(made, "flow_id", "left")
    fixed = F.col("_c").isNotNull()
    text = lambda c, v: F.when(fixed, v).otherwise(F.col(c)).alias(c)
    out = out.select(F.col("flow_id").alias("bioflow_id"), fixed.alias("is_correction"), text("name", F.col("_c")), text("categories", F.lit("")), text("unit", F.lit("")), text("database", F.lit("correction")), text("code", F.col("flow_id").cast("string")))
    return fully_named(out, ["database", "code"], "flows")


def fully_named(table: DataFrame, columns: list[str], what: str) -> DataFrame:
    """The table as it is; a row without one of the texts fails when it is read."""
    bad: Column = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull() | (F.col(c) == "")
    first = columns[0]
    return table.withColumn(first, F.when(bad, F.raise_error(F.lit(f"{what}: a row lacks one of {', '.join(columns)}"))).otherwise(F.col(first)))


def parity_samples(scores: DataFrame, pairs: DataFrame) -> DataFrame:
    """product_id, activity_col_id, expected (method and score, by method) of the products that an activity makes."""
    made = pairs.select("product_id", F.col("col_id").alias("activity_col_id"))
    e = scores.groupBy("product_id").agg(F.array_sort(F.collect_list(F.struct("method", "score"))).alias("expected"))  # one entry for each method
    return e.join(made, "product_id").select("product_id", "activity_col_id", "expected")


def methods_index(methods: list[list[str]]) -> dict:
    """What methods.json says: key, slug and file of each method, by slug."""
    return {"methods": sorted(({"key": list(m), "slug": method_slug(m), "path": f"methods/{method_slug(m)}"} for m in methods), key=lambda x: x["slug"]), "version": 1}


def write_package(root: str, tables: dict[str, DataFrame], methods: list[list[str]], extra: dict) -> dict:
    """Writes the tables as parquet, methods.json and manifest.json (extra, and the rows of each table); returns the manifest."""
    os.makedirs(root, exist_ok=True)
    counts = {}
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
        counts[name] = df.sparkSession.read.parquet(f"{root}/{name}").count()
    manifest = extra | {"counts": counts | {"methods": len(methods)}}
    for name, content in (("methods.json", methods_index(methods)), ("manifest.json", manifest)):
        with open(f"{root}/{name}", "w", encoding="utf-8") as f:
            json.dump(content, f, indent=2, sort_keys=True)
    return manifest


def deletion_list(activities: DataFrame, marker: str) -> DataFrame:
    """name, identifier of the activities whose name or category has the marker, each once."""
    hit = F.contains("name", F.lit(marker)) | F.coalesce(F.contains("category", F.lit(marker)), F.lit(False))
    return activities.where(hit).select("name", "identifier").distinct()


def restored_names(exchanges: DataFrame, suffix: str) -> DataFrame:
    """name, restored of the exchanges whose name ends with the suffix, each name once."""
    n = F.col("name")
    return exchanges.where(F.endswith(n, F.lit(suffix))).select(n, F.substring(n, F.lit(1), F.length(n) - len(suffix)).alias("restored")).distinct()


def residual_review(exchanges: DataFrame, prior: DataFrame) -> DataFrame:
    """name, unit, categories of unlinked biosphere rows, the first of each name, with an earlier proposal (name, target).

    exchanges: type, target_code, name, unit, categories, seq.
    """
    open_ = exchanges.where("type = 'biosphere' and target_code is null and name <> ''").select("name", "unit", "categories", "seq")
    return keep_first(open_, ["name"], ["seq"]).drop("seq").join(keep_first(prior.select("name", "target"), ["name"], ["target"]), "name", "left")


def rule_package(name: str, verb: str, entries: DataFrame) -> str:
    """A rule package as JSON text: entries (name, and restored or identifier) under the verb. For review-sized tables."""
    rows = []
    for r in entries.orderBy("name").toLocalIterator():
        d = r.asDict()
        source = {k: v for k, v in d.items() if k in ("name", "identifier") and v}
        rows.append({"source": source} | ({"target": {"name": d["restored"]}} if "restored" in d else {}))
    return json.dumps({"name": name, verb: rows}, ensure_ascii=False, indent=2)


def status_summary(compared: DataFrame, key: str, statuses: list[str]) -> DataFrame:
    """One row for each key with how many rows have each status, and all."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in statuses]
    return compared.groupBy(key).agg(*counts, F.count(F.lit(1)).alias("n"))


def evidence(contributions: DataFrame, group: list[str]) -> DataFrame:
    """The largest flows of each group: share of at least LEAST_SHARE, at most EVIDENCE of them, with the sign in words.

    contributions: contribution, share, name. In the order of the share, then the name.
    """
    c = contributions.where(F.col("share") >= LEAST_SHARE)
    top = top_per_group(c, group, [F.col("share").desc(), F.col("name")], EVIDENCE)
    return top.withColumn("share_pct", F.col("share") * 100).withColumn("sign", F.when(F.col("contribution") < 0, "negative").otherwise("positive"))


def enriched(contributions: DataFrame, units: DataFrame, compared: DataFrame) -> DataFrame:
    """contributions (code, method) with the unit of the flow (code, unit) and both factors of the comparison (code, method, sp_cf, ef_cf)."""
    u = keep_first(units.select("code", "unit"), ["code"], ["unit"])
    c = keep_first(compared.select("code", "method", "sp_cf", "ef_cf"), ["code", "method"], ["sp_cf", "ef_cf"])
    return contributions.join(u, "code", "left").join(c, ["code", "method"], "left")


def distinct_counts(frame: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many different values each column has."""
    return frame.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def largest_input(exchanges: DataFrame, unit: str) -> DataFrame:
    """activity_id, largest: the largest positive technosphere input in a unit."""
    return exchanges.where((F.col("type") == "technosphere") & (F.lower(F.trim("unit")) == unit) & (F.col("amount") > 0)).groupBy("activity_id").agg(F.max("amount").alias("largest"))


def snapshot_counts(exchanges: DataFrame) -> DataFrame:
    """edge_type, n of a snapshot; an empty one fails."""
    counts = exchanges.groupBy("edge_type").agg(F.count(F.lit(1)).alias("n"))
    if exchanges.isEmpty():
        raise ValueError("the snapshot is empty")
    return counts
