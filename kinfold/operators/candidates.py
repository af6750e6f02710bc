"""Candidate pairs: union of strategies, fuzzy fallback, two-stage caps and recall."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import FUZZY_BIT, FUZZY_WEIGHT, QUICK_FULL_SCORE, QUICK_WEIGHTS, STRATEGIES, Blocking
from ..functions import tfidf
from ..functions.similarity import similarities, similarity_fields
from ..sources.scratch import saved, spread
from . import blocking


def source_of(entity_id: Column) -> Column:
    """2 or 3, from the prefix of a candidate's id."""
    return F.substring(entity_id, 2, 1).cast("int")


def sides(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records of source 1, and candidates of sources 2 and 3 with their source."""
    first = entities.where(F.col("entity_id").startswith("S1-"))
    rest = entities.where(F.col("entity_id").startswith("S2-") | F.col("entity_id").startswith("S3-"))
    return first, rest.withColumn("source", source_of(F.col("entity_id")))


def top(pairs: DataFrame, by: str, keep: int, rank: str | None = None) -> DataFrame:
    """The ``keep`` best of each record and source (ties: least cand_id), with their rank from 1 if named."""
    order = W.partitionBy("s1_id", "source").orderBy(F.desc(by), "cand_id")
    out = pairs.withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= keep)
    return out.withColumnRenamed("__rank", rank) if rank else out.drop("__rank")


def with_texts(pairs: DataFrame, records: DataFrame, candidates: DataFrame, *columns: str) -> DataFrame:
    left = records.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"a_{c}") for c in columns))
    right = candidates.select(F.col("entity_id").alias("cand_id"), *(F.col(c).alias(f"b_{c}") for c in columns))
    return pairs.join(left, "s1_id", "left").join(right, "cand_id", "left")


def quick_scores(pairs: DataFrame, records: DataFrame, candidates: DataFrame) -> DataFrame:
    """``pairs`` with ``quick``: seven weighted terms over names, addresses, postal codes, numbers and score."""
    p = with_texts(pairs, records, candidates, "name_core", "normalized_address", "primary_postal", "building_number")
    p = p.withColumn("__s", similarity_fields({"n": (F.col("a_name_core"), F.col("b_name_core"), ("tset", "ratio")), "a": (F.col("a_normalized_address"), F.col("b_normalized_address"), ("tset", "ratio"))}))

    def equal(column: str) -> Column:
        return F.coalesce((F.col(f"a_{column}") == F.col(f"b_{column}")).cast("double"), F.lit(0.0))

    terms = {
        "name_set": F.col("__s.n_tset"), "name_ratio": F.col("__s.n_ratio"), "address_set": F.col("__s.a_tset"), "address_ratio": F.col("__s.a_ratio"),
        "postal": equal("primary_postal"), "building": equal("building_number"), "score": F.least(F.col("score") / QUICK_FULL_SCORE, F.lit(1.0)),
    }
    quick = sum((F.lit(weight) * terms[name] for name, weight in QUICK_WEIGHTS.items()), F.lit(0.0))
    return p.withColumn("quick", quick).select(*pairs.columns, "quick")


def fuzzy_pairs(records: DataFrame, candidates: DataFrame, settings: Blocking) -> DataFrame:
    """(s1_id, cand_id, source, fz) by character TF-IDF cosine, re-ranked with the token-set ratio of core names.

    A record meets the candidates of its country and those without one; without a country, or with one no
    candidate has, all. Grams of more than ``fuzzy_max_df`` candidates are left out, so no key is hot.
    """
    best = []
    names = candidates.where("name_core <> ''").select("entity_id", "source", "normalized_country", "name_core")
    countries = names.where("normalized_country IS NOT NULL").select("source", F.col("normalized_country").alias("place")).distinct()
    for source in (2, 3):
        own = names.where(F.col("source") == source)
        asked = records.where("name_core <> ''").join(countries.where(F.col("source") == source).drop("source"), F.col("normalized_country") == F.col("place"), "left").select("entity_id", "name_core", "place")
        # Each distinct name is looked at once, under its least id; names themselves don't travel with grams or pairs.
        theirs = saved(own.groupBy("name_core").agg(F.min("entity_id").alias("c")), "fuzzy-names")
        mine = saved(asked.groupBy("name_core").agg(F.min("entity_id").alias("q")), "fuzzy-asked")
        counts = theirs.select("name_core").mapInArrow(tfidf.trigram_counts, "gram string, df long").groupBy("gram").agg(F.sum("df").alias("df"))
        grams = saved(counts.where(F.col("df").between(2, settings.fuzzy_max_df)), "fuzzy-grams")
        found = saved(theirs.mapInArrow(tfidf.near(grams._saved_at, mine._saved_at, theirs.count(), settings.fuzzy_least), "q string, c string, cosine double"), "fuzzy-near")
        met = found.join(asked.join(mine, "name_core").select("q", F.col("entity_id").alias("s1_id"), "place"), "q").join(own.join(theirs, "name_core").select("c", F.col("entity_id").alias("cand_id"), F.col("normalized_country").alias("country")), "c")
        near = W.partitionBy("s1_id").orderBy(F.desc("cosine"), "cand_id")
        kept = met.where(F.col("place").isNull() | F.col("country").isNull() | (F.col("place") == F.col("country"))).withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= settings.fuzzy_retrieve)
        kept = kept.join(mine.withColumnRenamed("name_core", "a_core"), "q").join(theirs.withColumnRenamed("name_core", "b_core"), "c")
        scored = kept.withColumn("fz", 0.5 * F.col("cosine") + 0.5 * similarities(F.col("a_core"), F.col("b_core"), "tset")["tset"]).withColumn("source", F.lit(source))
        best.append(top(scored, "fz", settings.fuzzy_keep).select("s1_id", "cand_id", "source", "fz"))
    return best[0].unionByName(best[1])


def under_served(records: DataFrame, pairs: DataFrame, below: int) -> DataFrame:
    """(s1_id, source) of records with fewer than ``below`` pairs in a source, none included."""
    wanted = records.select(F.col("entity_id").alias("s1_id"), F.explode(F.array(F.lit(2), F.lit(3))).alias("source"))
    served = pairs.groupBy("s1_id", "source").agg(F.count("*").alias("n")).where(F.col("n") >= below)
    return wanted.join(served, ["s1_id", "source"], "left_anti")


def generate(entities: DataFrame, settings: Blocking) -> DataFrame:
    """(s1_id, cand_id, source, score, bits, quick, rank, n_strategies) of normalised entities."""
    records, candidates = sides(entities)
    total = candidates.count()
    pairs = blocking.all_pairs(records, candidates, total, settings).withColumn("source", source_of(F.col("cand_id")))
    if settings.fuzzy:
        extra = fuzzy_pairs(records, candidates, settings).join(under_served(records, pairs, settings.fuzzy_below), ["s1_id", "source"], "left_semi")
        extra = extra.select("s1_id", "cand_id", (FUZZY_WEIGHT * 10 * F.col("fz")).alias("score"), F.lit(FUZZY_BIT).alias("bits"))
        pairs = blocking.merged(pairs.drop("source").unionByName(extra)).withColumn("source", source_of(F.col("cand_id")))
    first = saved(top(pairs, "score", settings.keep_first), "first")
    return top(quick_scores(spread(first, "s1_id"), records, candidates), "quick", settings.keep, "rank").withColumn("n_strategies", F.bit_count("bits"))


def recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """(scope, found, total, recall): over all, by source, by strategy, and by strategy alone (``only_``)."""
    hits = truth.join(pairs.select("s1_id", "cand_id", "bits"), ["s1_id", "cand_id"], "left").withColumn("source", source_of(F.col("cand_id")))
    hit = F.col("bits").isNotNull()
    scopes = [("all", F.lit(True), hit), *((f"source{s}", F.col("source") == s, hit) for s in (2, 3))]
    for s in STRATEGIES:
        scopes += [(s.name, F.lit(True), F.coalesce(F.col("bits").bitwiseAND(F.lit(s.bit)) > 0, F.lit(False))), (f"only_{s.name}", F.lit(True), F.coalesce(F.col("bits") == s.bit, F.lit(False)))]
    rows = F.explode(F.array(*(F.struct(F.lit(n).alias("scope"), in_.alias("counts"), found.alias("found")) for n, in_, found in scopes)))
    return (
        hits.select(rows.alias("r")).where("r.counts").groupBy("r.scope")
        .agg(F.count_if("r.found").alias("found"), F.count("*").alias("total"))
        .withColumn("recall", F.col("found") / F.col("total"))
    )


def sizes(records: DataFrame, candidates: DataFrame, pairs: DataFrame) -> DataFrame:
    """One row: pairs, mean_candidates, median_candidates, max_candidates, reduction; records without pairs count 0."""
    counts = records.select(F.col("entity_id").alias("s1_id")).join(pairs.groupBy("s1_id").agg(F.count("*").alias("n")), "s1_id", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    total = candidates.count()
    return counts.agg(
        F.sum("n").alias("pairs"), F.avg("n").alias("mean_candidates"), F.median("n").alias("median_candidates"), F.max("n").alias("max_candidates"),
        (1 - F.sum("n") / (F.count("*") * F.lit(float(total)))).alias("reduction"),
    )
