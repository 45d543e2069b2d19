"""Views of the order tables as life-cycle data, and the same views as SQL.

A part is an activity with one product; part p consumes part p // 2 (so the system has no cycles); what its
lineitems say of suppliers are its emissions; a region is an impact method and a supplier's balance a factor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.sources.tables import table

FLOW_BASE = 1_000_000_000


def exchanges(spark: SparkSession, root: str) -> DataFrame:
    part = table(spark, root, "part")
    p = F.col("p_partkey").cast("long")
    made = part.select(p.alias("output_id"), p.alias("input_id"), F.lit(1.0).alias("amount"), F.lit("production").alias("edge_type"), F.lit(False).alias("is_biosphere"))
    used = part.where("p_partkey >= 2").select(p.alias("output_id"), F.expr("p_partkey div 2").alias("input_id"), (F.col("p_size") / 100.0).alias("amount"), F.lit("technosphere").alias("edge_type"), F.lit(False).alias("is_biosphere"))
    return made.unionByName(used).unionByName(emissions(spark, root))


def emissions(spark: SparkSession, root: str) -> DataFrame:
    # grouped by the columns as they are given, so that sums over them need no exchange of their own
    keys = F.col("l_partkey").cast("long").alias("output_id"), (F.col("l_suppkey") + FLOW_BASE).cast("long").alias("input_id")
    b = table(spark, root, "lineitem").groupBy(*keys).agg((F.sum("l_quantity") / 1000).alias("amount"))
    return b.select("output_id", "input_id", "amount", F.lit("biosphere").alias("edge_type"), F.lit(True).alias("is_biosphere"))


def emitted(spark: SparkSession, root: str) -> DataFrame:
    """row_id, col_id, value: B with several rows for a cell, for what sums them up anyway, so that they need no exchange before."""
    return table(spark, root, "lineitem").select((F.col("l_suppkey") + FLOW_BASE).cast("long").alias("row_id"), F.col("l_partkey").cast("long").alias("col_id"), (F.col("l_quantity") / 1000).alias("value"))


def factors(spark: SparkSession, root: str) -> DataFrame:
    s = table(spark, root, "supplier").join(table(spark, root, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.select(F.concat(F.lit("m"), F.col("n_regionkey").cast("string")).alias("method"), (F.col("s_suppkey") + FLOW_BASE).cast("long").alias("flow_id"), (F.col("s_acctbal") / 1000).alias("cf"))


def regional_factors(spark: SparkSession, root: str) -> DataFrame:
    """A factor of each flow for the nations of its own region."""
    n = table(spark, root, "nation")
    other = n.select(F.col("n_regionkey").alias("rk"), F.col("n_nationkey").alias("nk"))
    s = table(spark, root, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(other, F.col("n_regionkey") == F.col("rk"))
    return s.select(
        F.concat(F.lit("m"), F.col("n_regionkey").cast("string")).alias("method"), (F.col("s_suppkey") + FLOW_BASE).cast("long").alias("flow_id"),
        F.concat(F.lit("N"), F.col("nk").cast("string")).alias("location"), (F.col("s_acctbal") / 1000 * (1 + F.col("nk") / 10)).alias("cf"),
    )


def locations(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("col_id"), F.concat(F.lit("N"), (F.col("p_partkey") % 25).cast("string")).alias("location"))


def producers(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("product_id"), F.col("p_partkey").cast("long").alias("activity_id"))


def demands(spark: SparkSession, root: str) -> DataFrame:
    """One unit of every product."""
    return table(spark, root, "part").select(F.col("p_partkey").cast("long").alias("demand_id"), F.col("p_partkey").cast("long").alias("product_id"), F.lit(1.0).alias("amount"))


SQL = {
    "bio": f"bio as (select l_partkey::bigint as output_id, (l_suppkey + {FLOW_BASE})::bigint as input_id, sum(l_quantity) / 1000 as amount from lineitem group by 1, 2)",
    "exc": "exc as (select p_partkey::bigint as output_id, p_partkey::bigint as input_id, 1.0::double as amount, 'production' as edge_type, false as is_biosphere from part"
    " union all select p_partkey, p_partkey // 2, p_size / 100.0::double, 'technosphere', false from part where p_partkey >= 2"
    " union all select output_id, input_id, amount, 'biosphere', true from bio)",
    "q": f"q as (select 'm' || n_regionkey as method, (s_suppkey + {FLOW_BASE})::bigint as row_id, s_acctbal / 1000 as cf from supplier join nation on s_nationkey = n_nationkey where s_suppkey in (select l_suppkey from lineitem))",
    "reg": f"reg as (select 'm' || n.n_regionkey as method, (s_suppkey + {FLOW_BASE})::bigint as row_id, 'N' || o.n_nationkey as location, s_acctbal / 1000 * (1 + o.n_nationkey / 10) as rcf from supplier join nation n on s_nationkey = n.n_nationkey join nation o on o.n_regionkey = n.n_regionkey)",
    "loc": "loc as (select p_partkey::bigint as col_id, 'N' || (p_partkey % 25) as location from part)",
    # supply of one unit of each part: the path to its ancestors
    "s": "s as (with recursive r(demand_id, col_id, supply, d) as (select p_partkey::bigint, p_partkey::bigint, 1.0::double, 0 from part"
    " union all select r.demand_id, (r.col_id // 2)::bigint, r.supply * p.p_size / 100.0, d + 1 from r join part p on p.p_partkey = r.col_id where r.col_id >= 2)"
    " select demand_id, col_id, sum(supply) as supply from r where col_id in (select p_partkey from part) group by 1, 2)",
    "b": "b as (select input_id as row_id, output_id as col_id, amount as value from bio where output_id in (select p_partkey from part))",
}


def sql(*names: str) -> str:
    """'with ...' of the named views; 'exc', 'b' and 's' bring what they need."""
    need = []
    for n in names:
        for x in ({"exc": ["bio"], "b": ["bio"]}.get(n, []) + [n]):
            if x not in need:
                need.append(x)
    return "with " + ", ".join(SQL[n] for n in need) + " "
