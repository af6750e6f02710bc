"""Running totals that no single task has to make."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.scratch import saved


def running_total(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over all rows up to this one in order of the unique ``key``.

    Rows are dealt to ranges of the key; each range sums its own, and starts from the sum of the ranges before it,
    of which there is a row each.
    """
    ranged = saved(df.repartitionByRange(key).withColumn("__range", F.spark_partition_id()), "ranges")
    before = W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    starts = ranged.groupBy("__range").agg(F.sum(value).alias("__sum")).select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__start"))
    within = W.partitionBy("__range").orderBy(key).rowsBetween(W.unboundedPreceding, 0)
    return ranged.withColumn("__own", F.sum(value).over(within)).join(F.broadcast(starts), "__range").withColumn(name, F.col("__own") + F.col("__start")).drop("__range", "__own", "__start")
