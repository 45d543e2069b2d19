"""Matrices as coordinate DataFrames (row_id, col_id, value): ids are the coordinates, so nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.operators.frame import biosphere, is_production, technosphere

#: Fixed values of the net-consumption gate.
ASYMMETRY, LEAST_NET, FALLBACK_CF = 0.95, 0.05, 7.0


class NotSquareError(ValueError):
    """Products and activities differ in number."""


def technosphere_matrix(frame: DataFrame) -> DataFrame:
    """A: rows are products, columns activities; production and substitution positive, the rest negative.

    Edges to products that nobody makes are dropped, duplicates summed, zeros left out.
    """
    t = technosphere(frame)
    made = t.where(is_production()).select("input_id").distinct()
    makers = t.where(is_production()).select("output_id").distinct()
    sign = F.when(is_production() | (F.col("edge_type") == "substitution"), F.col("amount")).otherwise(-F.col("amount"))
    kept = t.join(made, "input_id", "left_semi").join(makers, "output_id", "left_semi")
    summed = kept.groupBy(F.col("input_id").alias("row_id"), F.col("output_id").alias("col_id")).agg(F.sum(sign).alias("value"))
    return summed.where("value <> 0")


def check_square(frame: DataFrame) -> int:
    """Number of products; raises NotSquareError unless it is the number of activities."""
    r = frame.agg(F.count_distinct(F.when(is_production(), F.col("input_id"))).alias("p"), F.count_distinct("output_id").alias("a")).first()
    if r.p != r.a:
        raise NotSquareError(f"{r.p} products, {r.a} activities")
    return r.p


def biosphere_matrix(frame: DataFrame) -> DataFrame:
    """B: rows are flows, columns the activities that make something."""
    makers = frame.where(is_production()).select(F.col("output_id").alias("col_id")).distinct()
    b = biosphere(frame).groupBy(F.col("input_id").alias("row_id"), F.col("output_id").alias("col_id")).agg(F.sum("amount").alias("value"))
    return b.join(makers, "col_id", "left_semi").select("row_id", "col_id", "value")


def characterisation(cfs: DataFrame, b: DataFrame | None = None) -> DataFrame:
    """Q: method, row_id, cf of the flows that B has; duplicates summed. Without b, of all flows: a join with B drops the others."""
    q = cfs.groupBy("method", F.col("flow_id").alias("row_id")).agg(F.sum("cf").alias("cf"))
    return q if b is None else q.join(b.select("row_id").distinct(), "row_id", "left_semi").select("method", "row_id", "cf")


def regional_correction(b: DataFrame, q: DataFrame, regional: DataFrame, locations: DataFrame) -> DataFrame:
    """C: method, col_id, value = sum over flows of (regional - global factor) * B; a missing global factor is 0.

    regional: method, flow_id, location, cf (the first in order of cf counts); locations: col_id, location.
    """
    reg = regional.groupBy("method", F.col("flow_id").alias("row_id"), "location").agg(F.min("cf").alias("rcf"))
    hit = b.join(locations, "col_id").join(reg, ["row_id", "location"]).join(q, ["method", "row_id"], "left")
    out = hit.groupBy("method", "col_id").agg(F.sum((F.col("rcf") - F.coalesce("cf", F.lit(0.0))) * F.col("value")).alias("value"))
    return out.where("value <> 0")


def consumption_correction(b: DataFrame, resource: DataFrame, returned: DataFrame, locations: DataFrame, cf_by_location: DataFrame) -> DataFrame:
    """col_id, value: net consumption times the local factor for activities that take much more than they return.

    resource, returned: row_id. Counts where (max - min) / max >= 0.95 and the net is at least 0.05; unknown
    locations take 7.0. Locations are compared without their sub-region.
    """
    side = resource.select("row_id", F.lit(1).alias("_in")).distinct().unionByName(returned.select("row_id", F.lit(-1).alias("_in")).distinct())
    sums = b.join(side, "row_id").groupBy("col_id").agg(F.sum(F.when(F.col("_in") == 1, F.col("value")).otherwise(0.0)).alias("res"), F.sum(F.when(F.col("_in") == -1, F.col("value")).otherwise(0.0)).alias("ret"))
    high, low = F.greatest("res", "ret"), F.least("res", "ret")
    asymmetry = F.when(high > 0, (high - low) / high).otherwise(0.0)
    net = F.col("res") - F.col("ret")
    kept = sums.where((asymmetry >= ASYMMETRY) & (net >= LEAST_NET) & (F.col("res") > F.col("ret"))).select("col_id", net.alias("net"))
    local = locations.select("col_id", F.substring_index("location", "-", 1).alias("location"))
    known = cf_by_location.groupBy("location").agg(F.min("cf").alias("cf"))
    return kept.join(local, "col_id", "left").join(known, "location", "left").select("col_id", (F.col("net") * F.coalesce("cf", F.lit(FALLBACK_CF))).alias("value"))


def embedded_correction(b: DataFrame, corrections: DataFrame, first_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """B with one more row for each corrected method, and method, row_id, cf = 1 of the new rows.

    New ids start at first_id in the order of the methods' names.
    """
    methods = corrections.select("method").distinct()  # one row for each method
    numbered = methods.select("method", (F.rank().over(Window.orderBy("method")) - 1 + first_id).cast("long").alias("row_id"))
    rows = corrections.join(F.broadcast(numbered), "method").select("row_id", "col_id", "value")
    return b.select("row_id", "col_id", "value").unionByName(rows), numbered.withColumn("cf", F.lit(1.0))


def skeleton(matrix: DataFrame, background: DataFrame) -> DataFrame:
    """The matrix without the columns of the background activities (col_id)."""
    return matrix.join(background, "col_id", "left_anti").where("value <> 0")
