"""Training sets: entity choice, splits by record, labels and negatives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import Settings


def draw(*ids: str, seed: int) -> Column:
    """A fixed pseudo-random number of a row: the same on every run, whatever the partitioning."""
    return F.xxhash64(F.lit(seed), *ids)


def choose(records: DataFrame, labelled: DataFrame, limit: int | None, seed: int) -> DataFrame:
    """Records with a label, at most ``limit`` of them, drawn by hash."""
    own = records.join(labelled.select(F.col("s1_id").alias("entity_id")).distinct(), "entity_id", "left_semi")
    return own if limit is None else own.orderBy(draw("entity_id", seed=seed), "entity_id").limit(limit)


def split(ids: DataFrame, validation: float, inner: float, seed: int) -> DataFrame:
    """(s1_id, role): val, inner or train, by hash of the record, so roles never share one."""
    part = F.pmod(draw("s1_id", seed=seed), F.lit(10_000)) / 10_000
    return ids.select("s1_id").distinct().withColumn("role", F.when(part < validation, "val").when(part < validation + (1 - validation) * inner, "inner").otherwise("train"))


def label(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """``pairs`` with ``label``: 1 for pairs of ``truth`` (s1_id, cand_id), else 0."""
    return pairs.join(truth.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1)), ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)))


def sample_negatives(pairs: DataFrame, hard: int, random: int, seed: int, by: str = "blk_quick") -> DataFrame:
    """All positives, each record's ``hard`` best-scored negatives and ``random`` others drawn by hash."""
    negative = W.partitionBy("s1_id", "label")
    ranked = pairs.withColumn("__hard", F.row_number().over(negative.orderBy(F.desc(by), "cand_id")))
    drawn = W.partitionBy("s1_id", "label", F.col("__hard") <= hard).orderBy(draw("s1_id", "cand_id", seed=seed), "cand_id")
    ranked = ranked.withColumn("__drawn", F.row_number().over(drawn))
    return ranked.where((F.col("label") == 1) | (F.col("__hard") <= hard) | (F.col("__drawn") <= random)).drop("__hard", "__drawn")


def build(features: DataFrame, truth: DataFrame, settings: Settings) -> DataFrame:
    """Labelled features with role; negatives are thinned in the training role only."""
    roles = split(features, settings.validation, settings.inner, settings.seed)
    rows = label(features, truth).join(roles, "s1_id")
    train = sample_negatives(rows.where("role = 'train'"), settings.hard_negatives, settings.random_negatives, settings.seed)
    return train.unionByName(rows.where("role <> 'train'"), allowMissingColumns=True)
