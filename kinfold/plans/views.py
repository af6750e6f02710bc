"""Inputs of the registered queries: an entity view over ``documents`` and what is derived from it."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Blocking
from ..functions.text import normalized_entities
from ..operators import blocking, candidates
from ..sources.scratch import saved, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entity_id(doc_id="doc_id"):
    return F.concat(F.lit("S"), (1 + F.col(doc_id) % 3).cast("string"), F.lit("-"), F.col(doc_id).cast("string"))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document is a record of source 1, 2 or 3 by its number; its first line, however long, is its name."""
    address = F.concat((F.col("doc_id") % 97).cast("string"), F.lit(" "), F.col("source"), F.lit(" rd "), (10_000 + F.col("doc_id") % 500).cast("string"))
    name = F.split_part("text", F.lit("\n"), F.lit(1))
    return table(spark, sf_dir, "documents").select(entity_id().alias("entity_id"), name.alias("business_name"), address.alias("business_address"), F.col("lang").alias("country"))


def normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised records, saved: the Unicode cleaner runs once however often they are read."""
    return saved(normalized_entities(spread(entities(spark, sf_dir), "entity_id")), "normalized")


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s1_id, cand_id) of documents with one text; texts meet by their SHA-256, so they don't travel."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(entity_id().alias("id"), F.sha2("text", 256).alias("digest"))
    own = docs.where(F.col("id").startswith("S1-")).withColumnRenamed("id", "s1_id")
    return own.join(docs.where(~F.col("id").startswith("S1-")).withColumnRenamed("id", "cand_id"), "digest").select("s1_id", "cand_id")


def truth_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source1_entity_id, matched_entity_ids) of every record of source 1, as a delimited text."""
    own = entities(spark, sf_dir).where(F.col("entity_id").startswith("S1-")).select(F.col("entity_id").alias("s1_id"))
    lists = truth(spark, sf_dir).groupBy("s1_id").agg(F.array_join(F.sort_array(F.collect_list("cand_id")), " ; ").alias("ids"))
    return own.join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce("ids", F.lit("")).alias("matched_entity_ids"))


def strategy_pairs(spark: SparkSession, sf_dir: str, *names: str, ready: DataFrame | None = None) -> DataFrame:
    """(s1_id, cand_id, score, bits, source) of the named strategies, of all enabled ones if none is named; ``ready``: the normalised records, if they are there."""
    records, others = candidates.sides(normalized(spark, sf_dir) if ready is None else ready)
    settings = Blocking() if not names else replace(Blocking(), enabled=names)
    pairs = blocking.all_pairs(records, others, others.count(), settings)
    return pairs.withColumn("source", candidates.source_of(F.col("cand_id")))


def scored_pairs(spark: SparkSession, sf_dir: str, ready: DataFrame | None = None) -> DataFrame:
    """Pairs of all enabled strategies with a probability that follows from their score alone, and their label."""
    from ..operators.training import label

    pairs = strategy_pairs(spark, sf_dir, ready=ready)
    return label(pairs.withColumn("p", F.round(F.col("score") / (F.col("score") + 40), 4)), truth(spark, sf_dir))
