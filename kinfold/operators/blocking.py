"""Blocking keys, capped indexes and weighted key joins.

Blocks larger than a strategy's cap say little and are left out before the join, so no key of the
join is hot, however the data are spread; counting them is one aggregation with map-side sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import STRATEGIES, STRATEGY, Blocking, Strategy


def _grams(core: Column, n: int = 3) -> Column:
    padded = F.concat(F.lit(" "), F.replace(F.substring(core, 1, 15), F.lit(" "), F.lit("_")), F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.char_length(padded) - n + 1), lambda i: F.substr(padded, i, F.lit(n)))


def keys_of(strategy: str) -> Column:
    """The strategy's keys of a normalised record, as an array without repeats."""
    name, core, postal = F.col("normalized_name"), F.col("name_core"), F.col("primary_postal")
    none = F.array().cast("array<string>")

    def one(key: Column, when: Column) -> Column:
        return F.when(when & key.isNotNull(), F.array(key)).otherwise(none)

    def longer(tokens: str, least: int) -> Column:
        return F.filter(tokens, lambda t: F.char_length(t) >= least)

    rules = {
        "exact_name": lambda: one(name, F.char_length(name) >= 2),
        "exact_core": lambda: one(core, F.char_length(core) >= 3),
        "name_signature": lambda: one(F.col("name_signature"), F.char_length("name_signature") >= 3),
        "name_token": lambda: longer("core_tokens", 2),
        "char_ngram": lambda: F.when(F.char_length(core) >= 3, _grams(core)).otherwise(none),
        "addr_token": lambda: longer("address_word_tokens", 3),
        "postal_name": lambda: one(F.concat_ws("#", postal, F.substring(core, 1, 3)), postal.isNotNull() & (F.char_length(core) >= 3)),
        "postal_building": lambda: one(F.concat_ws("#", postal, "building_number"), postal.isNotNull() & F.col("building_number").isNotNull()),
        "token_postal": lambda: F.when(postal.isNotNull(), F.transform(longer("core_tokens", 2), lambda t: F.concat(t, F.lit("@"), postal))).otherwise(none),
        "addr_signature": lambda: one(F.col("address_signature"), F.size("address_word_tokens") >= 2),
    }
    return F.array_distinct(rules[strategy]())


def raw_keys(entities: DataFrame, *strategies: str) -> DataFrame:
    """(entity_id, normalized_country, strategy, key) of the named strategies: one pass over the records."""
    keys = F.array(*(F.struct(F.lit(STRATEGY[n].bit).alias("strategy"), keys_of(n).alias("keys")) for n in strategies))
    each = entities.select("entity_id", "normalized_country", F.explode(keys).alias("k"))
    return each.select("entity_id", "normalized_country", "k.strategy", F.explode("k.keys").alias("key"))


def _of(column: str, strategies: tuple[Strategy, ...], value) -> Column:
    """A value of the strategy whose bit ``column`` holds; null where ``value`` gives None."""
    out = F.lit(None)
    for s in strategies:
        out = F.when(F.col(column) == s.bit, F.lit(value(s))).otherwise(out)
    return out


def scoped(keys: DataFrame, strategies: tuple[Strategy, ...], asking: bool, wildcard: bool = False) -> DataFrame:
    """Keys by country. A candidate stands under its country or ``?``; a record asks under its country and ``?``.

    With ``wildcard``, candidates also stand under ``*``, where records without a country ask. Strategies that aren't
    scoped have their keys as they are.
    """
    country = F.coalesce("normalized_country", F.lit("?"))
    if asking:
        places = F.array_distinct(F.array(country, F.lit("?")))
        if wildcard:
            places = F.when(F.col("normalized_country").isNull(), F.array(F.lit("*"))).otherwise(places)
    else:
        places = F.array(country, F.lit("*")) if wildcard else F.array(country)
    places = F.when(_of("strategy", strategies, lambda s: s.scoped), F.transform(places, lambda p: F.concat(p, F.lit("|")))).otherwise(F.array(F.lit("")))
    return keys.select("entity_id", "strategy", "key", F.explode(places).alias("place")).select("entity_id", "strategy", F.concat("place", "key").alias("key"))


def build_index(candidates: DataFrame, strategies: tuple[Strategy, ...], wildcard: bool = False) -> DataFrame:
    """(strategy, key, cand_id, df) of blocks no larger than their strategy's cap."""
    keys = scoped(raw_keys(candidates, *(s.name for s in strategies)), strategies, False, wildcard)
    sizes = keys.groupBy("strategy", "key").agg(F.count("*").alias("df")).where(F.col("df") <= _of("strategy", strategies, lambda s: s.cap))
    return keys.join(sizes, ["strategy", "key"]).select("strategy", "key", F.col("entity_id").alias("cand_id"), "df")


def rarest_keys(records: DataFrame, candidates: DataFrame, *strategies: Strategy) -> DataFrame:
    """A record's keys: (entity_id, normalized_country, strategy, key).

    Where a strategy says so, only those that are rarest among candidates, ``rarest`` at most. Keys no candidate has
    then drop out, and so do those of more than four caps. Keys made of a word and a postal
    code are ranked by the word alone, without that ceiling.
    """
    ranked = tuple(s for s in strategies if s.rarest is not None)
    keys = raw_keys(records, *(s.name for s in strategies))
    if not ranked:
        return keys
    by = F.when(_of("strategy", strategies, lambda s: s.rarest_ceiling), F.col("key")).otherwise(F.split_part("key", F.lit("@"), F.lit(1)))
    # What a strategy's keys are ranked by: counts of its own, or of plain words.
    words = STRATEGY["name_token"]
    counted = {s.name if s.rarest_ceiling else words.name for s in ranked}
    counts = raw_keys(candidates, *sorted(counted)).groupBy(F.col("strategy").alias("counted"), F.col("key").alias("by")).agg(F.count("*").alias("df"))
    of = _of("strategy", ranked, lambda s: s.bit if s.rarest_ceiling else words.bit)
    ceiling = _of("strategy", ranked, lambda s: 4 * s.cap if s.rarest_ceiling else None)
    rank = F.row_number().over(W.partitionBy("entity_id", "strategy").orderBy("df", "key"))
    mine = keys.where(of.isNotNull()).withColumns({"by": by, "counted": of}).join(counts, ["counted", "by"])
    mine = mine.where(ceiling.isNull() | (F.col("df") <= ceiling)).withColumn("rank", rank).where(F.col("rank") <= _of("strategy", ranked, lambda s: s.rarest))
    names = ("entity_id", "normalized_country", "strategy", "key")
    return mine.select(*names).unionByName(keys.where(of.isNull()).select(*names)) if len(ranked) < len(strategies) else mine.select(*names)


def all_pairs(records: DataFrame, candidates: DataFrame, total: int, settings: Blocking) -> DataFrame:
    """(s1_id, cand_id, score, bits) of every enabled strategy: weight times ln(1 + total / df) summed over shared keys, bits joined.

    Keys of all strategies are made, counted and joined together, so that each side is shuffled once.
    """
    strategies = tuple(STRATEGY[n] for n in settings.enabled)
    asked = scoped(rarest_keys(records, candidates, *strategies), strategies, True, settings.wildcard_scope).withColumnRenamed("entity_id", "s1_id")
    met = asked.join(build_index(candidates, strategies, settings.wildcard_scope), ["strategy", "key"])
    score = _of("strategy", strategies, lambda s: s.weight) * F.log1p(F.lit(float(total)) / F.col("df"))
    return met.groupBy("s1_id", "cand_id").agg(F.sum(score).alias("score"), F.bit_or("strategy").alias("bits"))


def merged(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("s1_id", "cand_id").agg(F.sum("score").alias("score"), F.bit_or("bits").alias("bits"))


def strategy_flags(bits: Column) -> dict[str, Column]:
    """A 0/1 column for each strategy, ``blk_fuzzy`` last."""
    flags = {f"blk_{s.name}": (bits.bitwiseAND(F.lit(s.bit)) > 0).cast("int") for s in STRATEGIES}
    return flags | {"blk_fuzzy": (bits.bitwiseAND(F.lit(1024)) > 0).cast("int")}
