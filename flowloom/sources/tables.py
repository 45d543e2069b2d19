"""Access to the parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table `name` under `root`; columns are pruned by what the query selects."""
    return spark.read.parquet(f"{root}/{name}.parquet")
