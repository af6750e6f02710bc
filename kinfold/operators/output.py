"""Outputs: one row per record with its sorted ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.text import normalized_entities
from ..sources.scratch import saved
from .decide import apply_rule


def id_lists(records: DataFrame, pairs: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """(source1_entity_id, ``column``): distinct ids in order, comma-joined; records without pairs have an empty text."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_set("cand_id")), ",").alias(column))
    own = records.select(F.col("entity_id").alias("s1_id")).distinct()
    return own.join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def samples(decided: DataFrame, records: DataFrame, per_country: int = 4, matches: int = 2) -> DataFrame:
    """Up to ``per_country`` records of each country with up to ``matches`` accepted candidates each."""
    kept = decided.where("pred").withColumn("m", F.row_number().over(W.partitionBy("s1_id").orderBy(F.desc("p"), "cand_id"))).where(F.col("m") <= matches)
    named = kept.join(records.select(F.col("entity_id").alias("s1_id"), "country", "business_name"), "s1_id")
    place = F.dense_rank().over(W.partitionBy("country").orderBy("s1_id"))
    return named.withColumn("r", place).where(F.col("r") <= per_country).select("country", "s1_id", "business_name", "cand_id", "p")


def link(entities: DataFrame, models: dict, weights: dict[str, float], rule: tuple[float, float, int], settings) -> DataFrame:
    """From raw entities to decided pairs: s1_id, cand_id, source, model probabilities, p, pred. One lazy plan."""
    from . import candidates, features
    from . import models as m

    ready = saved(normalized_entities(entities), "normalized")
    records, others = candidates.sides(ready)
    rows = features.compute(candidates.generate(ready, settings.blocking), records, others)
    scored = m.predict(rows, models, features.FEATURES, ["s1_id", "cand_id", "source"])
    p = sum((F.col(f"p_{name}") * w for name, w in weights.items()), F.lit(0.0))
    return apply_rule(scored.withColumn("p", p), *rule)
