"""Features of candidate pairs: similarities, set overlaps, matches, blocking bits and group context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions import tfidf
from ..functions.similarity import COUNTS, similarity_fields
from ..sources.scratch import saved, spread
from . import blocking
from .candidates import with_texts

TEXT_COLUMNS = (
    "normalized_name name_core name_acronym normalized_address primary_postal building_number normalized_country name_tokens core_tokens "
    "address_tokens numeric_tokens postal_code_candidates name_length address_length name_word_count"
).split()


def _shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)).cast("double")


def set_features(a: Column, b: Column, prefix: str) -> dict[str, Column]:
    """Jaccard, overlap, common and common ratio of distinct tokens; null where a denominator is 0."""
    shared, left, right = _shared(a, b), F.size(F.array_distinct(a)), F.size(F.array_distinct(b))
    both = F.size(F.array_union(a, b))
    return {
        f"{prefix}_jacc": F.try_divide(shared, both), f"{prefix}_overlap": F.try_divide(shared, F.least(left, right)),
        f"{prefix}_common": shared, f"{prefix}_common_ratio": F.try_divide(shared, left),
    }


def _count_features(shared: Column, left: Column, right: Column, prefix: str) -> dict[str, Column]:
    """``set_features`` of numbers of distinct tokens."""
    return {
        f"{prefix}_jacc": F.try_divide(shared, left + right - shared), f"{prefix}_overlap": F.try_divide(shared, F.least(left, right)),
        f"{prefix}_common": shared, f"{prefix}_common_ratio": F.try_divide(shared, left),
    }


def number_features() -> dict[str, Column]:
    a, b = F.col("a_numeric_tokens"), F.col("b_numeric_tokens")
    shared = _shared(a, b)
    pa, pb = F.col("a_postal_code_candidates"), F.col("b_postal_code_candidates")
    both, hit = (F.size(pa) > 0) & (F.size(pb) > 0), F.size(F.array_intersect(pa, pb)) > 0
    return {
        "num_common": shared, "num_jacc": shared / F.greatest(F.size(a), F.size(b), F.lit(1)),
        "postal_match": F.when(both, hit.cast("double")), "postal_both_present": both.cast("int"), "postal_conflict": (both & ~hit).cast("int"),
        "building_match": (F.col("a_building_number") == F.col("b_building_number")).cast("double"),
    }


def length_features() -> dict[str, Column]:
    la, lb = F.col("a_name_length"), F.col("b_name_length")
    return {
        "name_len_diff": F.abs(la - lb).cast("double"), "name_len_ratio": F.least(la, lb) / F.greatest(la, lb, F.lit(1)),
        "addr_len_diff": F.abs(F.col("a_address_length") - F.col("b_address_length")).cast("double"),
        "name_wc_diff": F.abs(F.col("a_name_word_count") - F.col("b_name_word_count")).cast("double"),
    }


def _missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) == ""


def exact_features() -> dict[str, Column]:
    named, placed = ~_missing("a_normalized_name"), ~(_missing("a_normalized_address") | _missing("b_normalized_address"))
    return {
        "name_exact": ((F.col("a_normalized_name") == F.col("b_normalized_name")) & named).cast("int"),
        "core_exact": ((F.col("a_name_core") == F.col("b_name_core")) & named).cast("int"),
        "addr_exact": ((F.col("a_normalized_address") == F.col("b_normalized_address")) & placed).cast("int"),
    }


def acronym_feature() -> Column:
    def spells(a: str, b: str) -> Column:
        acronym = F.col(f"{a}_name_acronym")
        return (F.char_length(acronym) >= 2) & (acronym == F.replace(F.col(f"{b}_name_core"), F.lit(" "), F.lit("")))

    return (spells("a", "b") | spells("b", "a")).cast("int")


def country_features() -> dict[str, Column]:
    a, b = F.col("a_normalized_country"), F.col("b_normalized_country")
    return {"country_match": (a == b).cast("double"), "country_missing": (a.isNull() | b.isNull()).cast("int")}


def group_features(pairs: DataFrame) -> DataFrame:
    """Counts, ranks and gaps to the best within a record's candidates; two partitionings, one a part of the other."""
    group, source = W.partitionBy("s1_id"), W.partitionBy("s1_id", "source")
    return pairs.withColumns({
        "grp_n_cands": F.count("*").over(group).cast("double"),
        "grp_n_cands_src": F.count("*").over(source).cast("double"),
        "name_jw_rank": F.rank().over(group.orderBy(F.desc("name_jw"))).cast("double"),
        "name_jw_gap": F.max("name_jw").over(group) - F.col("name_jw"),
        "na_rank": F.rank().over(group.orderBy(F.desc("na_combined"))).cast("double"),
        "na_gap": F.max("na_combined").over(group) - F.col("na_combined"),
        "quick_gap": F.max("blk_quick").over(source) - F.col("blk_quick"),
        "grp_same_name": F.count("*").over(W.partitionBy("s1_id", "b_name_core")).cast("double"),
        "grp_n_core_exact": F.sum("core_exact").over(group).cast("double"),
    })


#: What pairs carry of either side; token lists are read from the texts again.
_PAIR_COLUMNS = (
    "normalized_name name_core name_acronym normalized_address primary_postal building_number normalized_country "
    "numeric_tokens postal_code_candidates name_length address_length name_word_count __words __cored"
).split()


def _words(name: Column) -> Column:
    """The words of ``tfidf.word_grams`` between blanks; null where that is the name itself."""
    found = F.array_join(tfidf.word_grams(name), " ")
    return F.when(found != name, found)


def compute(pairs: DataFrame, records: DataFrame, candidates: DataFrame) -> DataFrame:
    """``pairs`` (as ``candidates.generate`` makes them) with all features; ids and source first.

    Pairs meet either side's texts once; what is read from texts is worked out there, and texts go no further.
    """
    def texts(column: str) -> DataFrame:
        both = records.select(F.col(column).alias("text")).union(candidates.select(F.col(column).alias("text")))
        return spread(saved(both.where("text <> ''").distinct(), "texts"), "text")

    names, places = texts("normalized_name"), texts("normalized_address")
    worded = names.select(F.coalesce(_words(F.col("text")), "text").alias("text"))
    records, candidates = (side.withColumns({"__words": _words(F.col("normalized_name")), "__cored": F.size("core_tokens") > 0}) for side in (records, candidates))
    p = with_texts(spread(saved(pairs, "pairs"), "s1_id"), records, candidates, *_PAIR_COLUMNS)
    p = p.withColumnsRenamed({"score": "blk_score", "quick": "blk_quick", "rank": "blk_rank", "n_strategies": "blk_n_strat"})
    p = p.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("a_normalized_name", "b_normalized_name", "a_normalized_address", "b_normalized_address")})
    name, address = ((F.col(f"a_{c}"), F.col(f"b_{c}")) for c in ("normalized_name", "normalized_address"))
    both = [F.concat(f"{x}_normalized_name", F.lit(" | "), f"{x}_normalized_address") for x in "ab"]
    p = p.withColumn("__c", tfidf.cosine_fields({
        "name_char_cos": (*name, tfidf.gram_counts(names, 2, 4), 2, 4),
        "name_word_cos": (*(F.coalesce(f"{x}___words", f"{x}_normalized_name") for x in "ab"), tfidf.gram_counts(worded, 0, 0), 0, 0),
        "addr_char_cos": (*address, tfidf.gram_counts(places, 3, 3), 3, 3),
    }))
    p = p.withColumn("__s", similarity_fields({
        "name": (*name, ("lev", "ratio", "jaro", "jw", "tsort", "tset", "partial", *COUNTS)),
        "core": (F.col("a_name_core"), F.col("b_name_core"), ("ratio", "jw", "tset", "partial", "prefix", *COUNTS)),
        "addr": (*address, ("lev", "jaro", "jw", "tsort", "tset", "partial", *COUNTS)),
        "post": (F.col("a_primary_postal"), F.col("b_primary_postal"), ("lcp",)),
        "both": (*both, ("tset",)),
    }))
    sims = {f"{f}_{k}": F.col(f"__s.{f}_{k}") for f, ks in (("name", "lev ratio jaro jw tsort tset partial"), ("core", "ratio jw tset partial"), ("addr", "lev jaro jw tsort tset partial")) for k in ks.split()}
    # A name of legal words alone is its own core, but has no core tokens.
    cored = {"shared": F.col("a___cored") & F.col("b___cored"), "left": F.col("a___cored"), "right": F.col("b___cored")}
    counts = {"name": [F.col(f"__s.name_{k}") for k in COUNTS], "core": [F.when(cored[k], F.col(f"__s.core_{k}")).otherwise(0.0) for k in COUNTS], "addr": [F.col(f"__s.addr_{k}") for k in COUNTS]}
    columns = sims | {c: F.col(f"__c.{c}") for c in ("name_char_cos", "name_word_cos", "addr_char_cos")}
    columns |= {"name_prefix": F.col("__s.core_prefix"), "postal_prefix": F.col("__s.post_lcp"), "na_combined": F.col("__s.both_tset")}
    for field, numbers in counts.items():
        columns |= _count_features(*numbers, f"{field}_tok")
    columns |= number_features() | length_features() | exact_features() | country_features() | blocking.strategy_flags(F.col("bits")) | {
        "name_acronym_match": acronym_feature(), "is_s3": (F.col("source") == 3).cast("int"), "s1_name_missing": _missing("a_normalized_name").cast("int"),
        "cand_name_missing": _missing("b_normalized_name").cast("int"), "s1_addr_missing": _missing("a_normalized_address").cast("int"), "cand_addr_missing": _missing("b_normalized_address").cast("int"),
    }
    kept = ("s1_id", "cand_id", "source", "blk_score", "blk_quick", "blk_rank", "blk_n_strat")
    p = p.select(*kept, F.sha2("b_name_core", 256).alias("b_name_core"), *(c.alias(n) for n, c in columns.items()))
    unplaced = (F.col("s1_addr_missing") == 1) | (F.col("cand_addr_missing") == 1)
    p = p.withColumns({c: F.when(~unplaced, F.col(c)) for c in p.columns if c.startswith("addr_") and c != "addr_exact"})
    p = p.withColumn("name_addr_mean", (F.col("name_tset") + F.coalesce("addr_tset", "name_tset")) / 2)
    return group_features(p).select("s1_id", "cand_id", "source", *(F.col(f).cast("float").alias(f) for f in FEATURES))


FEATURES = (
    [f"name_{k}" for k in "lev ratio jaro jw tsort tset partial".split()] + [f"core_{k}" for k in "ratio jw tset partial".split()]
    + ["name_prefix"] + [f"addr_{k}" for k in "lev jaro jw tsort tset partial".split()] + ["name_char_cos", "name_word_cos", "addr_char_cos", "postal_prefix", "na_combined", "name_addr_mean"]
    + [f"{f}_tok_{k}" for f in ("name", "core", "addr") for k in "jacc overlap common common_ratio".split()]
    + "num_common num_jacc postal_match postal_both_present postal_conflict building_match name_len_diff name_len_ratio addr_len_diff name_wc_diff".split()
    + "name_exact core_exact addr_exact name_acronym_match country_match country_missing is_s3 s1_name_missing cand_name_missing s1_addr_missing cand_addr_missing".split()
    + "blk_score blk_quick blk_rank blk_n_strat".split() + [f"blk_{s.name}" for s in blocking.STRATEGIES] + ["blk_fuzzy"]
    + "grp_n_cands grp_n_cands_src grp_same_name grp_n_core_exact name_jw_rank name_jw_gap na_rank na_gap quick_gap".split()
)
