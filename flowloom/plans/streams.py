"""Queries over the event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowloom.plans.scoring import Query, rnd
from flowloom.plans.scoring import query as _query
from flowloom.streaming.rescore import drain, events

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


@_query("select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, event_type, count(*) as n, round(sum(value), 6) as total from events group by 1, 2", QUERIES, ORACLE)
def stream_daily_totals(spark: SparkSession, root: str) -> DataFrame:
    d = drain(events(spark, root))
    return d.select(F.date_format("start", "yyyy-MM-dd").alias("day"), "event_type", "n", rnd(F.col("total")).alias("total"))
