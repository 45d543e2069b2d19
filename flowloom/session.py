"""Session helpers: settings read from the session, shared-folder lineage cuts."""

from __future__ import annotations

import gc
import math
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str | int = "*", shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="flowloom-"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage into the shared folder (see shared_folder)."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names in spark.checkpoint.dir.

    A folder of this machine is made only for a session on this machine that names none; on a cluster, whose executors
    could not read it, that raises.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="flowloom-")


def let_go(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files that nothing refers to any more, which it else does when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def parallelism(spark: SparkSession) -> int:
    """Shuffle partitions of the session, never under 1."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def placement_keys(spark: SparkSession, n: int) -> list[int]:
    """Numbers of which the i-th falls into partition i when rows are hash-partitioned by it into n partitions.

    Parts of planned size are placed one to a partition with them; hashing the parts' own numbers would put
    several into one partition and none into others. One small job over about n * ln(n) numbers.
    """
    tries = spark.range(0, max(64, int(n * (math.log(n + 1) + 8) * 1.5)), 1, 1)
    found = {r.p: r.k for r in tries.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("p")).agg(F.min("id").alias("k")).collect()}  # n rows
    return [found.get(i, i) for i in range(n)]
