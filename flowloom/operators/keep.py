"""Keep-first, dominant value, insert-if-absent and other picks that need an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, key: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key (nulls are one key), the first in the order. Rows of all columns are kept.

    A partial aggregation picks each task's first row before the shuffle, so a hot key costs no more than any
    other. The order must decide: ties are broken by the whole row.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    marked = df.select(F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *[F.col(c) for c in df.columns if c not in key and _ordered(df, c)]).alias("_o"), F.struct(*df.columns).alias("_row"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)])
    best = marked.groupBy(*[f"_k{i}" for i in range(len(key))]).agg(F.min_by("_row", "_o").alias("_row"))
    return best.select("_row.*")


def _ordered(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.typeName() not in ("map", "variant")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group in the order, with `rank` from 1."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col("rank") <= n)


def dominant(df: DataFrame, group: list[str], values: list[str]) -> DataFrame:
    """The most frequent value of each group with its count `n`; ties go to the smallest value."""
    counts = df.groupBy(*group, *values).agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy(*group).agg(F.min(F.struct((-F.col("n")).alias("o"), *values)).alias("b"))
    return best.select(*group, *[F.col(f"b.{v}").alias(v) for v in values], (-F.col("b.o")).alias("n"))


def insert_if_absent(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """existing, and the rows of new whose key it lacks (null keys are equal)."""
    seen = existing.select(*[F.col(k).alias(f"_{k}") for k in key]).distinct()
    match = None
    for k in key:
        c = new[k].eqNullSafe(seen[f"_{k}"])
        match = c if match is None else match & c
    return existing.unionByName(new.join(seen, match, "left_anti"), allowMissingColumns=True)


def upsert(existing: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """new, and the rows of existing whose key it lacks."""
    return insert_if_absent(new, existing, key)


def unique_lookup(right: DataFrame, key: list[str], value: list[str]) -> DataFrame:
    """key and value of the keys that stand for exactly one row; ambiguous keys are left out."""
    distinct = right.select(*key, *value).distinct()
    one = distinct.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.min(v).alias(v) for v in value])
    return one.where("_n = 1").drop("_n")


def forward_fill(df: DataFrame, value: Column, order: str, into: str, group: list[str] = ()) -> DataFrame:
    """`into`: the last value that isn't null up to each row, within the group.

    Without a group the rows are cut into ranges of the order column (a number) first, at its quantiles, so that gaps don't
    overfill a range: each range is filled by itself and starts from the last value of the ranges before it, and no
    task sees all rows.
    """
    df = df.withColumn("_v", value)
    if group:
        w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(into, F.last("_v", ignorenulls=True).over(w)).drop("_v")
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    cuts = sorted(set(df.approxQuantile(order, [i / parts for i in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    df = df.withColumn("_r", F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= F.col(order))).cast("long") if cuts else F.lit(0).cast("long"))
    w = Window.partitionBy("_r").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    filled = df.withColumn("_f", F.last("_v", ignorenulls=True).over(w))
    ends = df.where("_v is not null").groupBy("_r").agg(F.max_by("_v", order).alias("_e"))
    ranges = df.sparkSession.range(parts + 1).select(F.col("id").alias("_r")).join(F.broadcast(ends), "_r", "left")  # one row for each range
    before = ranges.withColumn("_b", F.last("_e", ignorenulls=True).over(Window.partitionBy(F.lit(0)).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1))).select("_r", "_b")
    return filled.join(F.broadcast(before), "_r", "left").withColumn(into, F.coalesce("_f", "_b")).drop("_v", "_r", "_f", "_b")
