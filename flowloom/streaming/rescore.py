"""Incremental aggregation of an event stream. Each micro-batch leaves partial sums, written once for each batch id."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.session import shared_folder

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def windowed(stream: DataFrame, length: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Counts and sums of an event stream by window and type, late rows dropped by the watermark."""
    ts = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return ts.groupBy(F.window("ts", length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def drain(stream: DataFrame, length: str = "1 day") -> DataFrame:
    """All that the stream holds now, aggregated by window and type.

    Each micro-batch writes its partial sums to a place named by its id, so a batch that is run again replaces
    its own rows (effectively once); the partial sums are added up when read.
    """
    spark = stream.sparkSession
    root = f"{shared_folder(spark)}/{uuid.uuid4().hex}"

    def batch(df: DataFrame, number: int) -> None:
        part = df.groupBy(F.window(F.col("ts").cast("timestamp"), length).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
        part.select(F.col("w.start").alias("start"), "event_type", "n", "total").write.mode("overwrite").parquet(f"{root}/parts/batch={number}")

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
    q.awaitTermination()
    parts = spark.read.schema("start timestamp, event_type string, n bigint, total double, batch int").parquet(f"{root}/parts")
    return parts.groupBy("start", "event_type").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def events(spark: SparkSession, root: str) -> DataFrame:
    return spark.readStream.schema(EVENTS).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1).parquet(root)
