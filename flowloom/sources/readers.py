"""Readers: documents, rule packages, sheets, factors, overrides. Schemas are declared, never inferred."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.exprs import bucket_of, bucket_of_context, literal_list
from flowloom.functions.text import blank_to_null
from flowloom.operators.keep import forward_fill, keep_first
from flowloom.schema import conformed, schema

INDEX_VERSION = 1


class VersionError(ValueError):
    """A versioned file of another version."""


class DuplicateKeyError(ValueError):
    """A curated file that names one key twice."""


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One document for each file, plain or gzip (by its ending)."""
    return spark.read.schema(ddl).option("multiLine", True).option("mode", "FAILFAST").json(path)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_or_empty(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The parquet table, or no rows in its schema where it doesn't exist."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema(name))
    return conformed(spark.read.parquet(path), name)


def cached(spark: SparkSession, source: str, cache: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The cache if it is newer than the source, else what `build` makes, written there."""
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(source).getFileSystem(spark._jsc.hadoopConfiguration())
    at = lambda p: fs.getFileStatus(jvm.org.apache.hadoop.fs.Path(p)).getModificationTime()
    if not exists(spark, cache + "/_SUCCESS") or at(cache + "/_SUCCESS") < at(source):
        build().write.mode("overwrite").parquet(cache)
    return spark.read.parquet(cache)


_ENTRY = "struct<source:struct<name:string,unit:string,context:array<string>,identifier:string,`CAS number`:string>,target:struct<name:string,unit:string,context:array<string>,identifier:string>,conversion_factor:double,comment:string>"
PACKAGE = f"name string, version string, replace array<{_ENTRY}>, update array<{_ENTRY}>, delete array<{_ENTRY}>"


def read_rules(spark: SparkSession, path: str, verbs: tuple[str, ...] = ("replace", "update")) -> DataFrame:
    """verb, seq, source and target fields, factor (missing and 0 are 1), comment of the entries of a rule package."""
    doc = read_json(spark, path, PACKAGE)
    out = None
    for v in verbs:
        one = doc.select(F.lit(v).alias("verb"), F.posexplode(v).alias("seq", "e")).select("verb", "seq", F.col("e.source").alias("source"), F.col("e.target").alias("target"), F.coalesce(F.when(F.col("e.conversion_factor") != 0, F.col("e.conversion_factor")), F.lit(1.0)).alias("factor"), F.col("e.comment").alias("comment"))
        out = one if out is None else out.unionByName(one)
    return out


FLOW_LIST = "flows array<struct<identifier:string,source:string,prefLabel:string,altLabel:array<string>,context_iri:string>>"


def read_flow_list(spark: SparkSession, path: str, source: str, known: DataFrame | None = None) -> DataFrame:
    """code, label, name, bucket, row of every label of the flows of one source.

    Labels with '<' are left out, the preferred label stays; each (label, bucket, code) once, the first counts.
    known: code; flows of other codes are left out.
    """
    f = read_json(spark, path, FLOW_LIST).select(F.posexplode("flows").alias("i", "f")).where(F.col("f.source") == source)
    code = blank_to_null("f.identifier")
    pref = blank_to_null("f.prefLabel")
    alts = F.filter(F.transform(F.coalesce("f.altLabel", F.array().cast("array<string>")), lambda a: F.trim(a)), lambda a: ~a.contains("<") & (a != ""))
    labels = F.concat(F.when(pref.isNotNull(), F.array(pref)).otherwise(F.array().cast("array<string>")), alts)
    rows = f.select("i", code.alias("code"), pref.alias("pref"), bucket_of_context(F.coalesce("f.context_iri", F.lit(""))).alias("bucket"), F.posexplode(labels).alias("j", "label")).where("code is not null")
    if known is not None:
        rows = rows.join(known.select("code").distinct(), "code", "left_semi")
    rows = rows.withColumn("_l", F.lower("label"))
    first = keep_first(rows, ["_l", "bucket", "code"], ["i", "j"])
    return first.select("code", "label", F.coalesce("pref", "label").alias("name"), "bucket", F.concat_ws(".", "i", "j").alias("row"))


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """Parameter overrides of a semicolon file; raises for rows that don't fit and for values that aren't finite."""
    df = spark.read.schema(schema("override")).options(sep=";", header=True, mode="FAILFAST").csv(path)
    ok = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") != float("inf"))
    return df.withColumn("value", F.when(ok, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no finite value for "), F.coalesce("parameter_name", F.lit("?"))))))


def read_located(spark: SparkSession, path: str, version: int = INDEX_VERSION) -> DataFrame:
    """database, code, location of a curated file; raises for another version or a key that stands twice."""
    doc = read_json(spark, path, "version int, overrides array<struct<database:string,code:string,location:string,rationale:string>>")
    found = doc.select("version").first()
    if found is None or found.version != version:
        raise VersionError(f"{path}: version {found and found.version}, not {version}")
    rows = doc.select(F.explode("overrides").alias("o")).select("o.database", "o.code", "o.location")
    twice = rows.groupBy("database", "code").count().where("count > 1").limit(5).collect()
    if twice:
        raise DuplicateKeyError(f"{path}: {[(r.database, r.code) for r in twice]}")
    return rows


def read_method_factors(spark: SparkSession, root: str, regional: bool = False) -> DataFrame:
    """Factors of all methods from one table partitioned by method_slug; a filter on it prunes the partitions.

    root/index.json names the version. regional: the rows by location.
    """
    with open(f"{root}/index.json") as f:
        found = json.load(f).get("version")
    if found != INDEX_VERSION:
        raise VersionError(f"{root}: version {found}, not {INDEX_VERSION}")
    name = "regional_cf" if regional else "method_cf"
    path = f"{root}/{name}"
    return conformed(spark.read.parquet(path), name) if exists(spark, path) else spark.createDataFrame([], schema(name))


def read_factor_sheet(spark: SparkSession, path: str, skip: int = 150) -> DataFrame:
    """Factors of a sheet (semicolon text with a row number first) whose header rows name the method of the rows below.

    Header rows read 'Impact category; method; unit'. Rows before a header, blank rows and rows without a
    number are left out.
    """
    ddl = "row long, a string, b string, c string, d string, e string, f string, g string"
    raw = spark.read.schema(ddl).options(sep=";", header=False).csv(path).where(F.col("row") >= skip)
    head = (F.col("a") == "Impact category") & F.col("b").isNotNull()
    filled = forward_fill(raw, F.when(head, F.struct("b", "c")), "row", "m")
    rows = filled.where(~F.coalesce(head, F.lit(False)) & F.col("m").isNotNull() & F.col("a").isNotNull()).withColumn("cf", F.col("e").try_cast("double")).where("cf is not null")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    return rows.select(F.col("m.b").alias("method"), F.col("m.c").alias("method_unit"), F.col("a").alias("compartment"), text("b").alias("sub_compartment"), text("c").alias("name"), text("d").alias("cas"), "cf", text("f").alias("flow_unit"), text("g").alias("cf_unit"), F.col("row").alias("seq"))


def read_reference_scores(spark: SparkSession, path: str, labels: dict[str, int], methods: dict[str, int], header_rows: int = 3, without: str | None = None) -> DataFrame:
    """Reference scores by the position of their columns; what is no number is null.

    path: semicolon text with a row number first. without: rows whose first label contains this text are left out.
    """
    width = max([*labels.values(), *methods.values()]) + 1
    ddl = "row long, " + ", ".join(f"c{i} string" for i in range(width))
    raw = spark.read.schema(ddl).options(sep=";", header=False).csv(path).where(F.col("row") >= header_rows)
    out = raw.select("row", *[blank_to_null(f"c{i}").alias(n) for n, i in labels.items()], *[F.col(f"c{i}").try_cast("double").alias(n) for n, i in methods.items()])
    if without:
        out = out.where(~F.coalesce(F.col(next(iter(labels))).contains(without), F.lit(False)))
    return out


def read_placeholder_sheet(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a curated sheet whose categories are a written tuple."""
    ddl = "row long, name string, unit string, categories string, cas string, target string"
    raw = spark.read.schema(ddl).options(sep=";", header=True).csv(path)
    cats = literal_list(F.coalesce("categories", F.lit("")))
    cas = F.when(~F.lower(blank_to_null("cas")).isin("nan", "none"), blank_to_null("cas"))
    return raw.where(blank_to_null("name").isNotNull()).select("row", F.trim("name").alias("name"), F.trim("unit").alias("unit"), cats.alias("categories"), bucket_of(cats).alias("bucket"), cas.alias("cas"), blank_to_null("target").alias("target"))


def exchanges_of_database(exchanges: DataFrame, activities: DataFrame, database: str) -> DataFrame:
    """The background edges of one database: exchanges joined with the activities that they belong to."""
    a = activities.where(F.col("database") == database).select(F.col("database").alias("output_database"), F.col("code").alias("output_code"))
    return exchanges.join(a, ["output_database", "output_code"]).select("output_database", "output_code", "input_database", "input_code", "amount", "type")


def jdbc_table(spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int) -> DataFrame:
    """A database table read in `parts` ranges of a number column; needs the database's driver on the class path."""
    return spark.read.jdbc(url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts)


def checksum_ok(path: str, sha256: str) -> bool:
    """Whether a downloaded file is the pinned one; read in pieces."""
    import hashlib

    if not os.path.exists(path):
        return False
    h = hashlib.sha256()
    with open(path, "rb") as f:
        for piece in iter(lambda: f.read(1 << 20), b""):
            h.update(piece)
    return h.hexdigest() == sha256
