"""Scores of products and what they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowloom.operators import flows
from flowloom.operators.keep import top_per_group
from flowloom.operators.solve import supply, unit_scores
from flowloom.session import let_go


def inventory(s: DataFrame, b: DataFrame) -> DataFrame:
    """demand_id, row_id, amount: B times the supply."""
    return s.join(b, "col_id").groupBy("demand_id", "row_id").agg(F.sum(F.col("supply") * F.col("value")).alias("amount"))


def per_activity(b: DataFrame, q: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """method, col_id, x: what one unit of an activity scores, Q B + C. A few rows for each activity, however many flows it has."""
    x = b.join(q, "row_id").groupBy("method", "col_id").agg(F.sum(F.col("value") * F.col("cf")).alias("x"))
    if corrections is None:
        return x
    return x.unionByName(corrections.select("method", "col_id", F.col("value").alias("x"))).groupBy("method", "col_id").agg(F.sum("x").alias("x"))


def product_scores(a: DataFrame, producers: DataFrame, demands: DataFrame, b: DataFrame, q: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """demand_id, method, score of each demand (demand_id, product_id, amount), without the supply of any.

    The transposed system gives what one unit of every product scores; demands only look it up.
    """
    y = unit_scores(a, producers, per_activity(b, q, corrections))
    return demands.join(y, "product_id").groupBy("demand_id", "method").agg(F.sum(F.col("amount") * F.col("score")).alias("score"))


def scores(s: DataFrame, b: DataFrame, q: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """demand_id, method, score = (Q B + C) s.

    The factors meet the emissions of the activities first, so the supply of all demands is joined with one row
    for each activity and method instead of every emission.
    """
    return s.join(per_activity(b, q, corrections), "col_id").groupBy("demand_id", "method").agg(F.sum(F.col("supply") * F.col("x")).alias("score"))


def scores_by_inventory(s: DataFrame, b: DataFrame, q: DataFrame) -> DataFrame:
    """The same by way of the inventory, Q (B s): for checks, and where the inventory is wanted anyway."""
    return inventory(s, b).join(q, "row_id").groupBy("demand_id", "method").agg(F.sum(F.col("amount") * F.col("cf")).alias("score"))


def top_inventory(s: DataFrame, b: DataFrame, n: int) -> DataFrame:
    """The n largest amounts (without zeros) of each demand; ties by the flow's id."""
    return top_per_group(inventory(s, b).where("amount <> 0"), ["demand_id"], [F.abs("amount").desc(), F.col("row_id")], n)


def flow_contributions(s: DataFrame, b: DataFrame, q: DataFrame) -> DataFrame:
    """demand_id, method, row_id, contribution, share of the score, and share of the sum of magnitudes."""
    c = inventory(s, b).join(q, "row_id").select("demand_id", "method", "row_id", (F.col("amount") * F.col("cf")).alias("contribution")).where("contribution <> 0")
    w = Window.partitionBy("demand_id", "method")  # at most the flows of one inventory
    x, total, size = F.col("contribution"), F.sum("contribution").over(w), F.sum(F.abs("contribution")).over(w)
    return c.select("demand_id", "method", "row_id", "contribution", F.try_divide(x, total).alias("share"), F.try_divide(F.abs(x), size).alias("abs_share"))


def demand_flow_contributions(a: DataFrame, producers: DataFrame, demands: DataFrame, b: DataFrame, q: DataFrame, share: bool = True) -> DataFrame:
    """flow_contributions of each demand (demand_id, product_id, amount), without its supply where workers can hold the graph.

    Two passes over the flows: the first sums up magnitudes for each product and method, the second gives the rows with
    their shares; no inventory is shuffled. share: whether the share of the score is wanted too (null if not).
    """
    methods = flows.methods_of(q)
    held = flows.held(a, producers, demands) if methods else None
    if held is None or held.nodes * len(methods) > flows.HELD_SUMS:
        return flow_contributions(supply(a, producers, demands), b, q)
    sizes = held.table(held.sums(b, q, methods, "magnitudes"), methods)
    totals = held.table(held.sums(b, q, methods), methods) if share else None
    let_go(b.sparkSession)  # what the first pass shuffled
    out = flows.named(held.contributions(b, q, methods, sizes, totals), methods)
    return out.select("demand_id", "method", "row_id", "contribution", "share", "abs_share")


def demand_parity(a: DataFrame, producers: DataFrame, demands: DataFrame, b: DataFrame, q: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """parity of the scores of each demand by way of the activities and by way of its inventory, which is formed in whole."""
    methods = flows.methods_of(q)
    held = flows.held(a, producers, demands) if methods else None
    if held is None:
        s = supply(a, producers, demands)
        return parity(scores(s, b, q), scores_by_inventory(s, b, q), tolerance)
    return _errors(flows.named(held.scores(b, q, methods), methods), tolerance)


def activity_contributions(s: DataFrame, b: DataFrame, q: DataFrame, corrections: DataFrame | None = None) -> DataFrame:
    """demand_id, method, col_id, contribution = ((Q B) + C) s, share of the corrected score."""
    per = per_activity(b, q, corrections)
    c = s.join(per, "col_id").select("demand_id", "method", "col_id", (F.col("supply") * F.col("x")).alias("contribution")).where("contribution <> 0")
    t = c.groupBy("demand_id", "method").agg(F.sum("contribution").alias("_t"))
    # every row has its total; a left join is left out where nobody asks for the share
    return c.join(t, ["demand_id", "method"], "left").select("demand_id", "method", "col_id", "contribution", F.try_divide("contribution", "_t").alias("share"))


def edge_contributions(s: DataFrame, b: DataFrame, q: DataFrame, n: int | None = None) -> DataFrame:
    """demand_id, method, row_id, col_id, contribution; the n largest of each demand and method (with `rank`) if n is given.

    With n, each activity's n largest edges for a method are picked before the supplies are met: supply scales all
    edges of an activity alike, so no other edge of it can be among the n of any demand. Ties by flow, then activity.
    """
    e = b.join(q, "row_id").select("method", "row_id", "col_id", "value", "cf").where("value * cf <> 0")
    if n is not None:
        e = top_per_group(e, ["method", "col_id"], [F.abs(F.col("value") * F.col("cf")).desc(), F.col("row_id")], n).drop("rank")
    x = s.join(e, "col_id").select("demand_id", "method", "row_id", "col_id", (F.col("supply") * F.col("value") * F.col("cf")).alias("contribution")).where("contribution <> 0")
    return x if n is None else top_per_group(x, ["demand_id", "method"], [F.abs("contribution").desc(), F.col("row_id"), F.col("col_id")], n)


def parity(a: DataFrame, b: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """method, n, max_error, ok: largest relative difference of two score tables; a missing score is an error of 1."""
    m = a.select("demand_id", "method", F.col("score").alias("x")).join(b.select("demand_id", "method", F.col("score").alias("y")), ["demand_id", "method"], "full_outer")
    return _errors(m, tolerance)


def _errors(m: DataFrame, tolerance: float) -> DataFrame:
    """parity of pairs x and y."""
    top = F.greatest(F.abs("x"), F.abs("y"))
    error = F.when(F.col("x").isNull() | F.col("y").isNull(), 1.0).when(top == 0, 0.0).otherwise(F.abs(F.col("x") - F.col("y")) / top)
    return m.groupBy("method").agg(F.count(F.lit(1)).alias("n"), F.max(error).alias("max_error")).withColumn("ok", F.col("max_error") <= tolerance)


def wide(table: DataFrame, methods: list[str]) -> DataFrame:
    """One column for each method; the methods are given, so no pass looks for them."""
    return table.groupBy("demand_id").pivot("method", methods).agg(F.first("score"))
