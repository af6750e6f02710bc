"""Tables of intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where it is unset, a new local folder, which only local mode can share."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="kinfold-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Spark drops a query's shuffle files at its end, not when the driver's garbage happens to be collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back: computed once, lost executors don't bring it back to its start, and its shuffles leave the disk."""
    path, conf = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}", df.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


#: Tasks a core that long work is dealt to.
TASKS = 3


def spread(df: DataFrame, *keys: str, tasks: int = TASKS) -> DataFrame:
    """``df``, dealt by ``keys`` to ``tasks`` a core if it would be read by fewer: a small table may be a lot of work.

    ``df`` is to be a table as read, not the outcome of joins or groups.
    """
    least = tasks * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= least else df.repartition(least, *keys)
