"""The exchange frame: one row for each edge (output_id, input_id, amount, edge_type, is_biosphere).

All operators are set-based: flags by aggregation or window over the owner, then semi or anti joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowloom.functions.exprs import synthetic_id

PRODUCTION = ("production", "generic production")
TECHNOSPHERE = ("technosphere", "substitution", "generic consumption")


def is_production() -> Column:
    return F.col("edge_type").isin(*PRODUCTION)


def is_technosphere() -> Column:
    return F.col("edge_type").isin(*TECHNOSPHERE)


def production(frame: DataFrame) -> DataFrame:
    return frame.where(is_production())


def technosphere(frame: DataFrame) -> DataFrame:
    return frame.where(is_production() | is_technosphere())


def biosphere(frame: DataFrame) -> DataFrame:
    return frame.where("is_biosphere")


def flatten(activities: DataFrame) -> DataFrame:
    """Long frame of activities with nested exchanges (array of struct(input_id, amount, edge_type[, allocation_factor])).

    Exchanges without a target are left out; the type defaults to technosphere, the allocation factor to 1.
    """
    fields = {f.name for f in activities.schema["exchanges"].dataType.elementType}
    e = activities.select("output_id", F.explode("exchanges").alias("e"))
    kind = F.coalesce(F.col("e.edge_type"), F.lit("technosphere"))
    factor = F.coalesce(F.col("e.allocation_factor"), F.lit(1.0)) if "allocation_factor" in fields else F.lit(1.0)
    return e.where("e.input_id is not null").select(
        "output_id", F.col("e.input_id").alias("input_id"), F.col("e.amount").cast("double").alias("amount"), kind.alias("edge_type"), (kind == "biosphere").alias("is_biosphere"), factor.alias("allocation_factor")
    )


def not_numbers(frame: DataFrame, limit: int = 5) -> DataFrame:
    """A few rows whose amount is NaN or missing, for an error message."""
    return frame.where(F.col("amount").isNull() | F.isnan("amount")).limit(limit)


def positive_waste(frame: DataFrame) -> DataFrame:
    """Negative production made positive, and with it the sign of the technosphere rows that use such an activity's product."""
    flipped = production(frame).where("amount < 0").select(F.col("input_id").alias("_w")).distinct()
    own = is_production() & (F.col("amount") < 0)
    out = frame.join(flipped, frame.input_id == F.col("_w"), "left")
    uses = F.col("_w").isNotNull() & is_technosphere()
    return out.withColumn("amount", F.when(own | uses, -F.col("amount")).otherwise(F.col("amount"))).select(*frame.columns)


def check_allocation(frame: DataFrame) -> None:
    """Raises ValueError for missing or negative factors, or an activity of several products whose factors don't sum to more than 0."""
    p = production(frame).groupBy("output_id").agg(F.count(F.lit(1)).alias("n"), F.sum("allocation_factor").alias("s"), F.bool_or(F.col("allocation_factor").isNull() | F.isnan("allocation_factor") | (F.col("allocation_factor") < 0)).alias("bad"))
    bad = p.where("n > 1 and (bad or s <= 0)").limit(5).collect()
    if bad:
        raise ValueError(f"allocation factors of {[r.output_id for r in bad]} can't be used")


def allocate(frame: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits activities of several products into one for each product; returns the frame and the provenance.

    Each production row of such an activity gets an activity of its own (synthetic_id) with the other rows
    times its normalised factor; a product with factor 0 keeps its production row only. Activities without a
    production row are dropped. Without the column allocation_factor the frame passes unchanged.
    provenance: synthetic_id, activity_id, product_id, factor.
    """
    columns = ["output_id", "input_id", "amount", "edge_type", "is_biosphere"]
    spark = frame.sparkSession
    if "allocation_factor" not in frame.columns:
        return frame, spark.createDataFrame([], "synthetic_id long, activity_id long, product_id long, factor double")
    w = Window.partitionBy("output_id")
    counted = frame.withColumn("_n", F.count(F.when(is_production(), 1)).over(w))
    single = counted.where("_n = 1").select(*columns)
    several = counted.where("_n > 1")
    total = F.sum("allocation_factor").over(w)
    products = several.where(is_production()).withColumn("factor", F.try_divide(F.col("allocation_factor"), total))
    products = products.withColumn("synthetic_id", synthetic_id(F.col("output_id"), F.col("input_id")))
    split = products.select("synthetic_id", F.col("output_id").alias("activity_id"), F.col("input_id").alias("product_id"), "factor")
    own = products.select(F.col("synthetic_id").alias("output_id"), "input_id", "amount", "edge_type", "is_biosphere")
    rest = several.where(~is_production()).join(split.where("factor > 0"), F.col("output_id") == F.col("activity_id"))
    shared = rest.select(F.col("synthetic_id").alias("output_id"), "input_id", (F.col("amount") * F.col("factor")).alias("amount"), "edge_type", "is_biosphere")
    return single.unionByName(own).unionByName(shared), split


def one_producer(frame: DataFrame) -> DataFrame:
    """Drops every row of an activity that produces something which an activity of smaller id produces too."""
    p = production(frame).select("input_id", "output_id")
    first = p.groupBy("input_id").agg(F.min("output_id").alias("first"))
    excess = p.join(first, "input_id").where("output_id <> first").select("output_id").distinct()
    return frame.join(excess, "output_id", "left_anti")


def without_self_loops(frame: DataFrame) -> DataFrame:
    """Drops an activity's use of its own product where it is a substitution or uses up all that is produced."""
    made = production(frame).groupBy("output_id", "input_id").agg(F.sum("amount").alias("_made"))
    out = frame.join(made, ["output_id", "input_id"], "left")
    loop = is_technosphere() & F.col("_made").isNotNull() & ((F.col("edge_type") == "substitution") | (F.abs("amount") >= F.abs("_made")))
    return out.where(~F.coalesce(loop, F.lit(False))).select(*frame.columns)


def prune(frame: DataFrame) -> DataFrame:
    """Drops edges that hang: self-loops, uses of what nobody makes, rows of activities that make nothing.

    One pass. A technosphere row stays only if its input is made in a positive amount by someone and its owner
    makes something; all rows of an activity go whose production rows are all 0 or less. Biosphere rows of
    owners without any production row stay.
    """
    f = without_self_loops(frame)
    made = production(f).where("amount > 0")
    products, makers = made.select("input_id").distinct(), made.select("output_id").distinct()
    empty = production(f).groupBy("output_id").agg(F.max("amount").alias("_m")).where("_m <= 0").select("output_id")
    uses = f.where(is_technosphere()).join(products, "input_id", "left_semi").join(makers, "output_id", "left_semi")
    return f.where(~is_technosphere()).unionByName(uses.select(*f.columns)).join(empty, "output_id", "left_anti").select(*frame.columns)


def without_edges(frame: DataFrame, activities: DataFrame, flows: DataFrame) -> DataFrame:
    """Drops the biosphere edges between the given activities (output_id) and flows (input_id)."""
    hit = biosphere(frame).join(activities, "output_id", "left_semi").join(flows, "input_id", "left_semi").select("output_id", "input_id").distinct().withColumn("_hit", F.lit(True))
    return frame.join(hit, ["output_id", "input_id"], "left").where(~(F.col("is_biosphere") & F.coalesce("_hit", F.lit(False)))).select(*frame.columns)


def drop_attribution(stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """id, drop_stage, consumer_count: the first stage in which a product of the first stage is no longer made.

    stages: (name, frame) in order. consumer_count: technosphere rows of the first frame that use the product.
    """
    first = stages[0][1]
    held = None
    for i, (_, f) in enumerate(stages):
        one = production(f).select(F.col("input_id").alias("id"), F.lit(i).alias("stage"))
        held = one if held is None else held.unionByName(one)
    seen = held.distinct().groupBy("id").agg(F.collect_set("stage").alias("stages"))
    every = F.array(*[F.lit(i) for i in range(len(stages))])
    gone = seen.withColumn("_s", F.array_min(F.array_except(every, "stages"))).where(F.array_contains("stages", 0) & F.col("_s").isNotNull())
    names = F.array(*[F.lit(n) for n, _ in stages])
    used = first.where(is_technosphere()).groupBy(F.col("input_id").alias("id")).agg(F.count(F.lit(1)).alias("consumer_count"))
    return gone.join(used, "id", "left").select("id", F.element_at(names, F.col("_s") + 1).alias("drop_stage"), F.coalesce("consumer_count", F.lit(0)).alias("consumer_count"))


def unmade_products(frame: DataFrame) -> DataFrame:
    """input_id, n_consumers of the products that are used but that nobody makes."""
    used = frame.where(is_technosphere()).groupBy("input_id").agg(F.count(F.lit(1)).alias("n_consumers"))
    return used.join(production(frame).select("input_id").distinct(), "input_id", "left_anti")


def exported_sign(frame: DataFrame) -> DataFrame:
    """Amounts as they are written outside: technosphere inputs negated, zeros left out."""
    amount = F.when(is_technosphere() & (F.col("edge_type") != "substitution"), -F.col("amount")).otherwise(F.col("amount"))
    return frame.where("amount <> 0").withColumn("amount", amount)
