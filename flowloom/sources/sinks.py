"""Sinks: tables, packages addressed by their content, exports and reports."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.operators.keep import insert_if_absent, upsert
from flowloom.schema import conformed
from flowloom.sources.readers import INDEX_VERSION, exists


def write_table(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """Parquet, replaced as a whole by the commit of the job; sorted inside each file if an order is given."""
    (df.sortWithinPartitions(*order) if order else df).write.mode("overwrite").parquet(path)


def write_method_factors(factors: DataFrame, root: str, regional: DataFrame | None = None) -> None:
    """Factors of all methods as one table partitioned by method, with a versioned index."""
    for name, df in (("method_cf", factors), ("regional_cf", regional)):
        if df is not None:
            conformed(df, name).repartition("method_slug").write.mode("overwrite").partitionBy("method_slug").parquet(f"{root}/{name}")
    os.makedirs(root, exist_ok=True)
    with open(f"{root}/index.json", "w") as f:
        json.dump({"version": INDEX_VERSION}, f)


def content_hash(*frames: DataFrame, constants: tuple = ()) -> str:
    """Digest of the rows of several frames, whatever their order and partitioning.

    Each row's digest is cut in four numbers that are summed (with the number of rows), so nothing is sorted or
    collected; equal rows count as often as they stand.
    """
    import hashlib

    parts = [repr(constants)]
    for df in frames:
        cols = sorted(df.columns)
        row = F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)
        pieces = [F.sum(F.conv(F.substring(row, 1 + 12 * i, 12), 16, 10).cast("decimal(30,0)")).alias(f"s{i}") for i in range(4)]
        parts.append(repr([cols, *df.agg(F.count(F.lit(1)).alias("n"), *pieces).first()]))
    return hashlib.sha256("|".join(parts).encode()).hexdigest()[:24]


class PackageStore:
    """Scoring packages in directories named by their content; the most recent ones are kept."""

    def __init__(self, spark: SparkSession, root: str, most: int = 5):
        self.spark, self.root, self.most = spark, root.rstrip("/"), most
        self._fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def write(self, frames: dict[str, DataFrame], constants: tuple = ()) -> str:
        """The package's name. What exists already is only touched; a half-written package is never seen."""
        key = content_hash(*[frames[n] for n in sorted(frames)], constants=(*sorted(frames), *constants))
        if exists(self.spark, f"{self.root}/{key}"):
            now = int(time.time() * 1000)
            self._fs.setTimes(self._path(key), now, now)
            return key
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{self.root}/{key}.partial/{name}")
        self._fs.rename(self._path(f"{key}.partial"), self._path(key))
        self._evict()
        return key

    def read(self, key: str) -> dict[str, DataFrame]:
        if not exists(self.spark, f"{self.root}/{key}"):
            raise FileNotFoundError(f"{self.root}/{key}")
        return {s.getPath().getName(): self.spark.read.parquet(s.getPath().toString()) for s in self._fs.listStatus(self._path(key)) if s.isDirectory()}

    def names(self) -> list[str]:
        """Most recent first."""
        found = [(s.getModificationTime(), s.getPath().getName()) for s in self._fs.listStatus(self._path(""))]
        return [n for _, n in sorted(found, reverse=True) if not n.endswith(".partial")]

    def _evict(self) -> None:
        for n in self.names()[self.most :]:
            self._fs.delete(self._path(n), True)


def write_csv(df: DataFrame, path: str, digits: int | None = None) -> None:
    """Comma text with a header; null is empty, doubles have so many significant digits."""
    if digits:
        df = df.select(*[F.when(F.col(c).isNotNull(), F.format_string(f"%.{digits}g", c)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
    df.write.mode("overwrite").options(header=True, nullValue="", emptyValue="").csv(path)


def write_product_json(contributions: DataFrame, path: str, key: str = "demand_id", limit: int | None = None) -> None:
    """One JSON document for each product and method, with its contributions, the largest first; only so many if a limit is given.

    A document holds the flows of one inventory. With a limit `n_flows` tells how many there are in all.
    """
    top = F.sort_array(F.collect_list(F.struct(F.abs("contribution").alias("size"), "row_id", "contribution", "share")), asc=False)
    top = top if limit is None else F.slice(top, 1, limit)
    doc = contributions.groupBy(key, "method").agg(top.alias("flows"), F.count(F.lit(1)).alias("n_flows"), F.sum(F.abs("contribution")).alias("total_abs_contribution"))
    doc.write.mode("overwrite").json(path)


def append_absent(path: str, new: DataFrame, key: list[str]) -> int:
    """Adds the rows whose key the table lacks; returns how many."""
    spark = new.sparkSession
    old = spark.read.parquet(path) if exists(spark, path) else new.limit(0)
    fresh = insert_if_absent(old.limit(0), new.join(old.select(*key).distinct(), key, "left_anti"), key)
    n = fresh.count()
    fresh.write.mode("append").parquet(path)
    return n


def save_overrides(path: str, old: DataFrame, new: DataFrame) -> None:
    """Overrides replaced by (name, scope), letter case of the name aside; the file is small and written whole."""
    keyed = lambda df: df.withColumn("_n", F.lower("parameter_name"))
    rows = upsert(keyed(old), keyed(new), ["_n", "scope"]).drop("_n").orderBy("parameter_name", "scope")
    conformed(rows, "override").coalesce(1).write.mode("overwrite").options(sep=";", header=True).csv(path)


def write_report(path: str, report: dict) -> None:
    """A run report of the driver, replaced as a whole."""
    with open(path + ".partial", "w") as f:
        json.dump(report, f, indent=1, sort_keys=True)
    os.replace(path + ".partial", path)


def matrix_report(a: DataFrame) -> dict:
    """Shape of a matrix: rows, columns, entries, deficit and whether it is square."""
    r = a.agg(F.count_distinct("row_id").alias("rows"), F.count_distinct("col_id").alias("cols"), F.count(F.lit(1)).alias("entries")).first()
    return {"rows": r.rows, "cols": r.cols, "entries": r.entries, "deficit": r.rows - r.cols, "square": r.rows == r.cols}
