"""Profiles of entity tables in Spark SQL; each is one query over a view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Classes of characters, the first that fits.
CLASSES = (
    ("ascii_letter", r"[A-Za-z]"), ("digit", r"[\p{Nd}\x{00B2}\x{00B3}\x{00B9}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}]"), ("space", r"[\x{0009}-\x{000D}\x{001C}-\x{0020}\x{0085}\p{Z}]"),
    ("ascii_punct", r"[\x{0000}-\x{007F}]"), ("latin_ext", r"[\x{0080}-\x{024F}]"), ("devanagari", r"[\x{0900}-\x{097F}]"),
)

#: Missing values are nulls (for countries blanks, too); empty ones are nulls and blanks.
COUNTS = """
SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_ids, count(*) - count(DISTINCT entity_id) AS repeated_ids,
  count(*) FILTER (WHERE business_name IS NULL) AS missing_names,
  count(*) FILTER (WHERE business_address IS NULL) AS missing_addresses,
  count(*) FILTER (WHERE country IS NULL OR trim(country) = '') AS missing_countries,
  count(*) FILTER (WHERE trim(coalesce(business_name, '')) = '') AS empty_names,
  count(*) FILTER (WHERE trim(coalesce(business_address, '')) = '') AS empty_addresses
FROM {t}
"""

DUPLICATES = """
SELECT count(*) - count(DISTINCT lower(trim(business_name))) AS repeated_names,
  count(*) - count(DISTINCT lower(trim(business_address))) AS repeated_addresses,
  count(*) - count(DISTINCT struct(lower(trim(coalesce(business_name, ''))), lower(trim(coalesce(business_address, ''))), lower(trim(coalesce(country, ''))))) AS repeated_records
FROM {t}
"""


def _text_columns(column: str, name: str) -> str:
    share = "round(avg(CASE WHEN {c} RLIKE r'{p}' THEN 1.0D ELSE 0.0D END), 6) AS {n}"
    return ", ".join([
        f"round(avg(length({column})), 6) AS {name}_mean", f"CAST(median(length({column})) AS DOUBLE) AS {name}_median", f"CAST(max(length({column})) AS BIGINT) AS {name}_longest",
        f"round(avg(size(split(trim({column}), ' '))), 6) AS {name}_words", share.format(c=column, p="[0-9]", n=f"{name}_with_digit"), share.format(c=column, p=r"[^\x00-\x7F]", n=f"{name}_non_ascii"),
    ])


TEXT = f"""
SELECT {_text_columns("business_name", "name")}, {_text_columns("business_address", "address")},
  round(avg(CASE WHEN business_address RLIKE r'\\b[0-9]{{{{5,6}}}}\\b' THEN 1.0D ELSE 0.0D END), 6) AS address_with_postal
FROM {{t}}
"""

CATEGORIES = "SELECT coalesce(country, '(none)') AS country, count(*) AS n FROM {t} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25"


def _top_tokens(column: str) -> str:
    return f"""
SELECT token, count(*) AS n FROM (SELECT explode(split(lower({column}), ' ')) AS token FROM {{t}}) WHERE token <> ''
GROUP BY token ORDER BY n DESC, token LIMIT 30
"""


TOP_TOKENS, TOP_ADDRESS_TOKENS = _top_tokens("business_name"), _top_tokens("business_address")


def run(spark: SparkSession, entities: DataFrame, query: str) -> DataFrame:
    """A query of this module over ``entities``."""
    return spark.sql(query, t=entities)


def examples(entities: DataFrame, n: int = 5) -> DataFrame:
    return entities.orderBy("entity_id").limit(n)


def scripts(entities: DataFrame) -> DataFrame:
    """(script, n, share) of all characters of names."""
    of = F.lit("other_unicode")
    for name, pattern in reversed(CLASSES):
        of = F.when(F.col("c").rlike(pattern), name).otherwise(of)
    counted = entities.select(F.explode(F.split("business_name", "")).alias("c")).where("c <> ''").groupBy(of.alias("script")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).first()[0] or 1
    return counted.withColumn("share", F.col("n") / F.lit(float(total)))


def only_in(entities: DataFrame, others: DataFrame) -> DataFrame:
    """Countries of ``entities`` that ``others`` don't have."""
    return entities.select("country").distinct().exceptAll(others.select("country").distinct())


def truth_shape(parsed: DataFrame) -> DataFrame:
    """One row over (s1_id, matched): records without, with one and with several matches, mean, max, by source, several in source 2."""
    n = F.size("matched")
    of = lambda s: F.size(F.filter("matched", lambda x: x.startswith(f"S{s}-")))
    return parsed.agg(
        F.count_if(n == 0).alias("without"), F.count_if(n == 1).alias("with_one"), F.count_if(n > 1).alias("with_several"), F.round(F.avg(n), 6).alias("mean"), F.max(n).cast("bigint").alias("most"),
        F.sum(of(2)).alias("source2"), F.sum(of(3)).alias("source3"), F.count_if(of(2) > 1).alias("several_in_source2"),
    )


def truth_histogram(parsed: DataFrame, most: int = 10) -> DataFrame:
    return parsed.groupBy(F.least(F.size("matched"), F.lit(most)).cast("bigint").alias("matches")).agg(F.count("*").alias("n"))
