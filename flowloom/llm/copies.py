"""Duplicates that differ in formatting only, collapsed and counted at any skew.

A record's canonical key is two 64-bit hashes of its canonical text. The records are read once and reduced to key and
id, written to the shared folder. Keys are counted exactly with partial (map-side) counts; those with more rows than
one task should hold are hot. Hot keys are reduced in two levels over a salt, and their representatives joined to
salted rows; all other keys take one shuffle. How many keys are hot doesn't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.text import alnum_key
from flowloom.session import checkpointed

#: Rows of one key that a task takes without splitting (24 bytes each), and the parts of a hotter one.
HOT_ROWS, SALTS = 250_000, 64


def canonical_parts(name: Column) -> Column:
    """The parts of a name between commas, semicolons, bars and slashes, each reduced to letters and digits, sorted."""
    parts = F.split(F.coalesce(name, F.lit("")), r"[,;|/]")
    return F.array_sort(F.filter(F.transform(parts, alnum_key), lambda x: x != ""))


def canonical_elements(values: Column) -> Column:
    """List elements reduced to letters and digits, sorted; an element is never divided."""
    reduced = F.transform(values, lambda x: alnum_key(F.coalesce(x, F.lit(""))))
    return F.coalesce(F.array_sort(F.filter(reduced, lambda x: x != "")), F.array().cast("array<string>"))


def flow_key(scope: str = "inventory", name: str = "name", categories: str = "categories") -> list[Column]:
    """Columns k1, k2: 128 bits of the canonical form of a flow within its inventory."""
    text = F.concat_ws("\u0001", F.coalesce(F.col(scope).cast("string"), F.lit("\u0003")), F.array_join(canonical_parts(F.col(name)), "\u0002"), F.lit("\u0004"), F.array_join(canonical_elements(F.col(categories)), "\u0002"))
    return [F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("\u0005"), text).alias("k2")]


def with_representative(keyed: DataFrame) -> DataFrame:
    """keyed: k1, k2, id. Adds first_id, the smallest id of the key. Rows without an id must not be in it."""
    keyed = checkpointed(keyed.select("k1", "k2", "id"))
    first = F.min("id").over(Window.partitionBy("k1", "k2"))
    hot = checkpointed(keyed.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT_ROWS).select("k1", "k2", F.lit(True).alias("hot")))
    if hot.isEmpty():
        return keyed.withColumn("first_id", first)
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")
    each = hot.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    marked = keyed.select("*", salt).join(each, ["k1", "k2", "salt"], "left")  # a hot key's rows meet it in SALTS parts
    hot_rows = marked.where("hot")
    parts = hot_rows.groupBy("k1", "k2", "salt").agg(F.min("id").alias("m"))
    firsts = parts.groupBy("k1", "k2").agg(F.min("m").alias("first_id")).select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    found = hot_rows.join(firsts, ["k1", "k2", "salt"])
    cold = marked.where("hot is null").withColumn("first_id", first)
    return cold.select("k1", "k2", "id", "first_id").unionByName(found.select("k1", "k2", "id", "first_id"))


def _keyed(records: DataFrame) -> DataFrame:
    return records.where(F.col("record_id").isNotNull()).select(*flow_key(), F.col("record_id").cast("long").alias("id"))


def later_copies(records: DataFrame) -> DataFrame:
    """first_id, record_id of each record that has an earlier one of the same flow in its inventory.

    Null or empty names and categories count as having no parts, so two such records are the same. A record
    delivered twice under one id is one record; records without an id are left out. Empty tables give no rows.
    """
    found = with_representative(_keyed(records)).where(F.col("id") > F.col("first_id"))
    return found.select("first_id", F.col("id").alias("record_id")).distinct()


def copy_counts(records: DataFrame) -> DataFrame:
    """first_id, n_copies: one row for each flow of an inventory, with how many records (ids) it has."""
    rows = with_representative(_keyed(records)).select("first_id", "id").distinct()
    # partial counts by salt first, so that a hot flow is no single task
    parts = rows.groupBy("first_id", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(F.count(F.lit(1)).alias("n"))
    return parts.groupBy("first_id").agg(F.sum("n").alias("n_copies"))
