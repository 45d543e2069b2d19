"""Inventory exports made of text blocks ('Process' ... 'End'), split and read in parallel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.functions.text import blank_to_null


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """block: the text from 'Process' to the line before 'End', of every block. Line ends are single line feeds.

    The file is cut at the closing lines by the reader, so one large export is read by many tasks.
    """
    raw = spark.read.option("lineSep", "\nEnd\n").text(path)
    body = F.regexp_extract(F.concat(F.lit("\n"), F.regexp_replace("value", "\r\n", "\n"), F.lit("\n")), r"(?s)\n(Process\n.*)", 1)
    return raw.select(body.alias("block")).where("block <> ''")


def section(block: Column, title: str) -> Column:
    """Lines below a title up to the next blank line, as an array without blank lines."""
    text = F.regexp_extract(block, rf"(?s)(?:^|\n){title}\n(.*?)(?:\n\n|\n*$)", 1)
    return F.filter(F.split(text, "\n"), lambda x: F.trim(x) != "")


def field(block: Column, title: str) -> Column:
    return blank_to_null(F.get(section(block, title), F.lit(0)))


def decimal(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast("double")


def processes(blocks: DataFrame) -> DataFrame:
    """identifier, name, type, category and geography of each block."""
    b = F.col("block")
    return blocks.select(field(b, "Process identifier").alias("identifier"), field(b, "Process name").alias("name"), field(b, "Type").alias("type"), field(b, "Category type").alias("category"), field(b, "Geography").alias("geography"))


def products(blocks: DataFrame) -> DataFrame:
    """identifier, seq, name, unit, amount, allocation of the products and waste treatments of each block."""
    b = F.col("block")
    lines = F.concat(section(b, "Products"), section(b, "Waste treatment"))
    rows = blocks.select(field(b, "Process identifier").alias("identifier"), F.posexplode(lines).alias("seq", "line"))
    c = F.split("line", ";")
    return rows.select("identifier", "seq", F.trim(F.get(c, F.lit(0))).alias("name"), F.trim(F.get(c, F.lit(1))).alias("unit"), decimal(F.get(c, F.lit(2))).alias("amount"), decimal(F.get(c, F.lit(3))).alias("allocation"))


#: Sections of exchanges and their types.
EXCHANGE_SECTIONS = {
    "Materials/fuels": "technosphere", "Electricity/heat": "technosphere", "Waste to treatment": "technosphere", "Avoided products": "substitution",
    "Resources": "biosphere", "Emissions to air": "biosphere", "Emissions to water": "biosphere", "Emissions to soil": "biosphere",
}


def exchanges(blocks: DataFrame) -> DataFrame:
    """identifier, section, type, seq, name, sub_compartment, unit, amount, formula of the exchanges of each block.

    Emissions and resources have the sub-compartment as second cell. What is no number is a formula.
    """
    b = F.col("block")
    every = F.array(*[F.struct(F.lit(t).alias("section"), F.lit(k).alias("type"), section(b, t).alias("lines")) for t, k in EXCHANGE_SECTIONS.items()])
    rows = blocks.select(field(b, "Process identifier").alias("identifier"), F.explode(every).alias("s")).select("identifier", "s.section", "s.type", F.posexplode("s.lines").alias("seq", "line"))
    c = F.split("line", ";")
    shift = F.when(F.col("type") == "biosphere", 1).otherwise(0)
    amount = F.trim(F.get(c, shift + 2))
    return rows.select("identifier", "section", "type", "seq", F.trim(F.get(c, F.lit(0))).alias("name"), F.when(shift == 1, F.trim(F.get(c, F.lit(1)))).alias("sub_compartment"), F.trim(F.get(c, shift + 1)).alias("unit"), decimal(amount).alias("amount"), F.when(decimal(amount).isNull(), amount).alias("formula"))


def parameters(blocks: DataFrame) -> DataFrame:
    """process_code, kind, name, original_name, amount, formula of the parameters of each block."""
    b = F.col("block")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), section(b, t).alias("lines")) for k, t in (("input", "Input parameters"), ("calculated", "Calculated parameters"))])
    rows = blocks.select(field(b, "Process identifier").alias("process_code"), F.explode(kinds).alias("s")).select("process_code", "s.kind", F.explode("s.lines").alias("line"))
    c = F.split("line", ";")
    name, value = F.trim(F.get(c, F.lit(0))), F.trim(F.get(c, F.lit(1)))
    return rows.select("process_code", "kind", F.lower(name).alias("name"), name.alias("original_name"), F.when(F.col("kind") == "input", decimal(value)).alias("amount"), F.when(F.col("kind") == "calculated", value).alias("formula"))


def split_marked(blocks: DataFrame, markers: list[str]) -> tuple[DataFrame, DataFrame]:
    """Blocks that no marker names in their products or comment, and identifier, type, marker, sha256 of the others."""
    hit = None
    for m in markers:
        c = F.lower("block").contains(m.lower())
        hit = F.when(c, m) if hit is None else hit.when(c, m)
    marked = blocks.withColumn("marker", hit)
    b = F.col("block")
    gone = marked.where("marker is not null").select(field(b, "Process identifier").alias("identifier"), field(b, "Type").alias("type"), "marker", F.sha2(b, 256).alias("sha256"))
    return marked.where("marker is null").drop("marker"), gone
