from __future__ import annotations

from pyspark.sql import functions as F

from flowloom.session import checkpointed, placement_keys


def test_each_key_has_a_partition_of_its_own(spark):
    for n in (1, 7, 40):
        keys = placement_keys(spark, n)
        df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k long").repartition(n, "k")
        got = {r.i: r.p for r in df.select("i", F.spark_partition_id().alias("p")).collect()}
        assert got == {i: i for i in range(n)}


def test_checkpoint_cuts_the_plan(spark):
    df = checkpointed(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in df._jdf.queryExecution().toString() and df.count() == 5
