"""Normalised names, addresses and countries, and the fields derived from them.

Everything is a column expression but ``unicode_clean``: Spark has no Unicode normalisation, so that
one is an Arrow-batched UDF. All regexes ask for Unicode classes, ``(?U)``, as names come in any script.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .words import ADDRESS_WORDS, COUNTRY_NAMES, LEGAL_WORDS, NAME_WORDS

_MARKS = {c: None for c in range(0x300, 0x370)}

# Patterns of the text rules and what takes their place, in the order in which they apply.
INITIALS = ((r"\b(\w)\.(\w)\.(\w)\.?", "$1$2$3"), (r"\b(\w)\.(\w)\b\.?", "$1$2"))
PUNCTUATION = (("&", " & "), ("['’`´]", ""), (r"[^\w&\s]", " "), ("_", " "))
BLANKS = (r"\s+", " ")
MESSRS = (r"^\s*m\s*/\s*s\b\.?", " ")
ADDRESS_CODES = (
    (r"\b(pin|pincode|pin code|zip|zipcode|postal code|cp)\s*[:\-]?\s*(\d{3})\s+(\d{3})\b", "$1 $2$3"),
    (r"(\d{5})-(\d{4})\b", "$1"),
    ("#", " number "),
)
LETTER_DIGIT = (r"(\p{L})(\d)", "$1 $2")


def clean(text: str | None) -> str:
    """Compatibility forms, lower case, without combining accents; null is empty."""
    text = unicodedata.normalize("NFKC", text or "").lower()
    return unicodedata.normalize("NFC", unicodedata.normalize("NFKD", text).translate(_MARKS))


@F.pandas_udf(StringType())
def unicode_clean(texts: pd.Series) -> pd.Series:
    return texts.map(clean)


def replaced(c: Column, *rules: tuple[str, str]) -> Column:
    """The regex rules one after another."""
    return reduce(lambda x, rule: F.regexp_replace(x, f"(?U){rule[0]}", rule[1]), rules, c)


def join_initials(c: Column) -> Column:
    """``s.a.s.`` to ``sas``: three single characters between dots, then two."""
    return replaced(c, *INITIALS)


def spaced(c: Column) -> Column:
    """Punctuation to single spaces; ampersands stand alone, apostrophes go."""
    return F.trim(replaced(c, *PUNCTUATION, BLANKS))


def word_map(words: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for pair in words.items() for x in pair))


def mapped(c: Column, words: dict[str, str]) -> Column:
    """Each word replaced by the table's, if it has one."""
    table = word_map(words)
    return F.trim(replaced(F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.try_element_at(table, w), w)), " "), BLANKS))


def normalized_name(cleaned: Column) -> Column:
    return mapped(spaced(replaced(join_initials(cleaned), MESSRS)), NAME_WORDS)


def normalized_address(cleaned: Column) -> Column:
    return mapped(replaced(spaced(replaced(join_initials(cleaned), *ADDRESS_CODES)), LETTER_DIGIT), ADDRESS_WORDS)


def normalized_country(cleaned: Column) -> Column:
    c = spaced(cleaned)
    return F.nullif(F.coalesce(F.try_element_at(word_map(COUNTRY_NAMES), c), c), F.lit(""))


def normalize(entities: DataFrame) -> DataFrame:
    """``entities`` with normalized_name, normalized_address and normalized_country; other columns stay."""
    cleaned = entities.withColumns({f"__{c}": unicode_clean(c) for c in ("business_name", "business_address", "country")})
    return cleaned.withColumns({
        "normalized_name": normalized_name(F.col("__business_name")),
        "normalized_address": normalized_address(F.col("__business_address")),
        "normalized_country": normalized_country(F.col("__country")),
    }).drop("__business_name", "__business_address", "__country")


def words(c: Column) -> Column:
    return F.filter(F.split(c, " "), lambda w: w != "")


def derive(entities: DataFrame, postal: str = r"\b\d{5,6}\b") -> DataFrame:
    """Token lists, core name, signatures, acronym, postal codes, numbers and sizes of normalised entities."""
    legal = F.array(*(F.lit(w) for w in LEGAL_WORDS))
    name, address = F.col("normalized_name"), F.col("normalized_address")
    d = entities.withColumns({
        "name_tokens": words(name),
        "address_tokens": words(address),
        "numeric_tokens": F.regexp_extract_all(address, F.lit(r"(?U)\d+"), 0),
        "postal_code_candidates": F.array_distinct(F.regexp_extract_all(address, F.lit(f"(?U){postal}"), 0)),
    })
    d = d.withColumns({
        "core_tokens": F.filter("name_tokens", lambda w: ~F.array_contains(legal, w)),
        "address_word_tokens": F.filter("address_tokens", lambda w: w.rlike(r"(?U)^\D{3,}$")),
        "primary_postal": F.get("postal_code_candidates", F.lit(0)),
        "building_number": F.get(F.filter("numeric_tokens", lambda n: F.char_length(n) <= 4), F.lit(0)),
    })
    return d.withColumns({
        "name_core": F.when(F.size("core_tokens") > 0, F.array_join("core_tokens", " ")).otherwise(name),
        "name_signature": signature(F.col("core_tokens")),
        "address_signature": signature(F.col("address_word_tokens")),
        "name_acronym": F.array_join(F.transform("core_tokens", lambda w: F.substring(w, 1, 1)), ""),
        "name_length": F.char_length(name),
        "address_length": F.char_length(address),
        "name_word_count": F.size("name_tokens"),
        "address_word_count": F.size("address_tokens"),
    })


def signature(tokens: Column) -> Column:
    """Distinct words in order of spelling."""
    return F.array_join(F.array_sort(F.array_distinct(tokens)), " ")


NORMALIZED_COLUMNS = (
    "entity_id business_name business_address country normalized_name normalized_address normalized_country "
    "name_core name_signature name_acronym primary_postal building_number address_signature "
    "name_tokens core_tokens address_tokens address_word_tokens numeric_tokens postal_code_candidates "
    "name_length address_length name_word_count address_word_count"
).split()


def normalized_entities(entities: DataFrame) -> DataFrame:
    return derive(normalize(entities)).select(*NORMALIZED_COLUMNS)


def normalize_one(spark: SparkSession, kind: str, value: str | None) -> str | None:
    """One value by the batch rules; ``kind``: name, address or country."""
    rule = {"name": normalized_name, "address": normalized_address, "country": normalized_country}[kind]
    return spark.createDataFrame([(value,)], "v string").select(rule(unicode_clean("v")).alias("v")).first()["v"]
