"""The corpus pipeline: toxicity, exact deduplication, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of ``documents``. ``run`` writes each stage's result as Parquet in the
shared folder, so a lost executor costs one stage at most, and rereads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import common, dedup, jaccard, packing, toxicity


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject.

    Null texts are empty and stay; null ids and repeated rows are scored like others; an empty table stays empty."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the least id (null ids last).

    Null texts are empty and equal to each other; of a repeated row one stays."""
    return dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least id, of each group linked by a similarity of 0.8 or more over five-word shingles.

    Null and blank texts and rows without an id stay; rows that share an id stay or go together."""
    return jaccard.one_per_component(docs, width=5, p=80, q=100)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 tokens. Null texts are their end id alone; repeated rows are packed each."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)


STAGES = [("toxicity", without_toxic), ("exact dedup", without_copies), ("near duplicates", without_near_copies), ("packing", packed)]

#: Neither the toxicity model nor the tokenizer is expressible in SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Extra columns of any name pass all stages but the last; empty tables give no rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
