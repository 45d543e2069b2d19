"""Further files: spreadsheets, variants of an export, run reports, score files, single factor files, snapshots."""

from __future__ import annotations

import io
import json
import lzma
import os
import re
import shutil
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.text import blank_to_null
from flowloom.operators.registry import with_bucket
from flowloom.schema import conformed
from flowloom.sources.readers import PACKAGE, VersionError, exists, read_json

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


class SnapshotError(RuntimeError):
    """A snapshot that is missing, of another layout, or of another source."""


def sheet_rows(content: bytes, sheet: str | None = None) -> list[list[str | None]]:
    """Cells of a sheet (the first one by default) as texts; numbers as they are written, missing cells null."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        names = set(z.namelist())
        shared: list[str] = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))]
        links = {r.get("Id"): r.get("Target", "").lstrip("/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        sheets = {s.get("name"): links[s.get(_LINK)] for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
        if sheet is not None and sheet not in sheets:
            raise KeyError(f"no sheet {sheet!r} among {sorted(sheets)}")
        path = sheets[sheet] if sheet is not None else next(iter(sheets.values()))
        root = ElementTree.fromstring(z.read(path if path.startswith("xl/") else f"xl/{path}"))
    rows: list[list[str | None]] = []
    for row in root.iter(f"{_MAIN}row"):
        at = int(row.get("r", len(rows) + 1))
        rows += [[] for _ in range(at - len(rows) - 1)]
        cells: list[str | None] = []
        for c in row.iter(f"{_MAIN}c"):
            letters = re.match(r"[A-Z]*", c.get("r", "")).group()
            column = 0
            for x in letters:
                column = column * 26 + ord(x) - 64
            cells += [None] * (column - 1 - len(cells)) if column else []
            value, kind = c.find(f"{_MAIN}v"), c.get("t")
            if kind == "inlineStr":
                cells.append("".join(t.text or "" for t in c.iter(f"{_MAIN}t")))
            elif value is None or value.text is None:
                cells.append(None)
            else:
                cells.append(shared[int(value.text)] if kind == "s" else value.text)
        rows.append(cells)
    return rows


def read_sheet(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """row (from 0), cells of a spreadsheet; each file is read by one task. Use readers.cached to read it once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b[0].to_pylist():
                rows = sheet_rows(content, sheet)
                yield pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(rows, pa.list_(pa.string()))], ["row", "cells"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "row long, cells array<string>")


def sheet_table(sheet: DataFrame, columns: list[str], skip: int = 1) -> DataFrame:
    """The sheet's rows after `skip` header rows, with named columns by position; wholly blank rows are left out."""
    named = sheet.where(F.col("row") >= skip).select("row", *[blank_to_null(F.get("cells", F.lit(i))).alias(c) for i, c in enumerate(columns)])
    return named.where(F.coalesce(*columns).isNotNull())


def chosen_variant(folder: str, full: str, stripped: str, cache: str) -> tuple[str, str]:
    """(path, variant) of an export: the full one if it is there, else the stripped one; an .xz file is unpacked once into the cache."""
    for name, variant in ((full, "full"), (stripped, "stripped")):
        path = os.path.join(folder, name)
        if os.path.exists(path):
            return path, variant
        if os.path.exists(path + ".xz"):
            out = os.path.join(cache, name)
            if not os.path.exists(out) or os.path.getmtime(out) < os.path.getmtime(path + ".xz"):
                os.makedirs(cache, exist_ok=True)
                with lzma.open(path + ".xz", "rb") as src, open(out + ".partial", "wb") as dst:
                    shutil.copyfileobj(src, dst)
                os.replace(out + ".partial", out)
            return out, variant
    raise FileNotFoundError(f"neither {full} nor {stripped} in {folder}")


class RulePackages:
    """Rule packages of a folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.json"

    def has(self, name: str) -> bool:
        return exists(self.spark, self.path(name))

    def load(self, name: str) -> DataFrame:
        return read_json(self.spark, self.path(name), PACKAGE)

    def metadata(self, name: str) -> dict:
        return self.load(name).select("name", "version").first().asDict()

    def labels(self, name: str) -> list[str]:
        """Fields of the sources that the package's rules name at all."""
        fields = ["name", "unit", "context", "identifier", "CAS number"]
        e = F.explode(F.concat(*[F.coalesce(v, F.array().cast(self.load(name).schema[v].dataType)) for v in ("replace", "update", "delete")]))
        r = self.load(name).select(e.alias("e")).agg(*[F.count(F.col(f"e.source.`{f}`")).alias(f) for f in fields]).first()
        return [f for f in fields if r[f]]


def context_pairs(package: DataFrame, provenance: str) -> DataFrame:
    """source_context, target_context, provenance of a package of context rules."""
    e = package.select(F.explode(F.concat(F.coalesce("update", F.array().cast(package.schema["update"].dataType)), F.coalesce("replace", F.array().cast(package.schema["replace"].dataType)))).alias("e"))
    rows = e.select(F.col("e.source.context").alias("source_context"), F.col("e.target.context").alias("target_context"), F.lit(provenance).alias("provenance"))
    return conformed(rows.where((F.size("source_context") > 0) & (F.size("target_context") > 0)), "context_norm")


def edge_labels(rules: DataFrame, provenance: str) -> DataFrame:
    """Rename pairs of edges (readers.read_rules): names that change, with the edge's compartments."""
    rows = rules.select(F.col("source.name").alias("source_name"), F.col("target.name").alias("target_name"), F.lit(None).cast("string").alias("edge_type"), F.col("source.context").alias("categories"), F.lit(provenance).alias("provenance"))
    return conformed(rows.where("source_name is not null and target_name is not null and source_name <> target_name"), "edge_label")


def migration(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """Fields and rules of a migration file {"fields": [...], "data": [[[values], {patch}], ...]}: seq, a column for each field, new_name, multiplier.

    Migration files are curated by hand and read by the driver.
    """
    with open(path, encoding="utf-8") as f:
        doc = json.load(f)
    fields = doc["fields"]
    rows = [(i, *[str(v) for v in values], patch.get("name"), float(patch.get("multiplier") or 1.0)) for i, (values, patch) in enumerate(doc["data"])]
    ddl = "seq int, " + ", ".join(f"`{c}` string" for c in fields) + ", new_name string, multiplier double"
    return fields, spark.createDataFrame(rows, ddl)


def load_report(path: str) -> dict:
    """A run report; FileNotFoundError if there is none."""
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def located_package(report: str, root: str) -> str:
    """Folder of the package that a run report names ('content_hash'); raises if the report or the package is missing."""
    key = load_report(report).get("content_hash")
    if not key:
        raise KeyError(f"{report} names no package")
    path = f"{root.rstrip('/')}/{key}"
    if not os.path.isdir(path):
        raise FileNotFoundError(path)
    return path


def read_backtest(spark: SparkSession, path: str, methods: list[str]) -> DataFrame:
    """code, name and one number for each method of a comma file with a header; blank cells are null."""
    raw = spark.read.options(header=True, mode="FAILFAST").schema("code string, name string, " + ", ".join(f"`{m}` string" for m in methods)).csv(path)
    return raw.select("code", "name", *[F.col(f"`{m}`").try_cast("double").alias(m) for m in methods])


def read_product_json(spark: SparkSession, path: str, key: str = "demand_id") -> DataFrame:
    """key, method, total, row_id, contribution, share of the documents that sinks.write_product_json leaves."""
    doc = spark.read.schema(f"{key} long, method string, flows array<struct<size:double,row_id:long,contribution:double,share:double>>, n_flows long, total_abs_contribution double").json(path)
    return doc.select(key, "method", F.col("total_abs_contribution").alias("total"), F.explode("flows").alias("f")).select(key, "method", "total", "f.row_id", "f.contribution", "f.share")


def method_folder(spark: SparkSession, root: str, slugs: list[str]) -> DataFrame:
    """method_raw, cf of whole method folders, global and regional rows alike (for statistics); missing folders are skipped."""
    out = None
    for slug in slugs:
        for name in ("method_cf", "regional_cf"):
            path = f"{root}/{name}/method_slug={slug}"
            if exists(spark, path):
                one = spark.read.parquet(path).select(F.lit(slug).alias("method_raw"), F.col("cf").cast("double").alias("cf"))
                out = one if out is None else out.unionByName(one)
    return out if out is not None else spark.createDataFrame([], "method_raw string, cf double")


def two_columns(table: DataFrame, method: str, cf: str) -> DataFrame:
    """method_raw, cf of a factor table; no other column is read."""
    return table.select(F.col(method).alias("method_raw"), F.col(cf).cast("double").alias("cf"))


def load_catalog(spark: SparkSession, path: str, databases: list[str] | None = None) -> DataFrame:
    """A catalogue of flows with compartments; the filter on databases reaches the scan."""
    return with_bucket(spark.read.parquet(path), databases)


def curated_factors(spark: SparkSession, path: str, version: int = 1) -> DataFrame:
    """db, code, cf of a versioned curated file {"version": n, "factors": [{database, code, amount}]}."""
    doc = read_json(spark, path, "version int, factors array<struct<database:string,code:string,amount:double>>")
    found = doc.select("version").first()
    if found is None or found.version != version:
        raise VersionError(f"{path}: version {found and found.version}, not {version}")
    return doc.select(F.explode("factors").alias("f")).select(F.col("f.database").alias("db"), "f.code", F.col("f.amount").alias("cf"))


def write_snapshot(frames: dict[str, DataFrame], root: str, stamp: str, layout: int = 1) -> None:
    """Tables of a linked graph with the layout and the stamp of their source, which is written last."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    with open(f"{root}/snapshot.json", "w", encoding="utf-8") as f:
        json.dump({"layout": layout, "stamp": stamp, "tables": sorted(frames)}, f)


def load_snapshot(spark: SparkSession, root: str, stamp: str, layout: int = 1) -> dict[str, DataFrame]:
    """The tables of a snapshot; raises where it is missing, incomplete, of another layout or of another source."""
    try:
        meta = load_report(f"{root}/snapshot.json")
    except (FileNotFoundError, json.JSONDecodeError) as e:
        raise SnapshotError(f"no whole snapshot in {root}") from e
    if meta.get("layout") != layout:
        raise SnapshotError(f"layout {meta.get('layout')}, not {layout}")
    if meta.get("stamp") != stamp:
        raise SnapshotError("the source has changed since")
    for name in meta["tables"]:
        if not exists(spark, f"{root}/{name}/_SUCCESS"):
            raise SnapshotError(f"{name} is missing")
    return {name: spark.read.parquet(f"{root}/{name}") for name in meta["tables"]}


def reset(spark: SparkSession, paths: list[str]) -> list[str]:
    """Deletes caches and override files that exist; returns what was deleted."""
    gone = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        if p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True):
            gone.append(path)
    return gone
