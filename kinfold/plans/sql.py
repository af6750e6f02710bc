"""The same queries in DuckDB's SQL."""

from __future__ import annotations

from ..config import STRATEGIES, STRATEGY, Settings, Strategy
from ..functions.words import ADDRESS_WORDS, COUNTRY_NAMES, LEGAL_WORDS, NAME_WORDS
from ..operators.decide import weight_grid


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _map(words: dict[str, str]) -> str:
    return "MAP {" + ", ".join(f"{_text(k)}: {_text(v)}" for k, v in words.items()) + "}"


def _regex(c: str, *rules: tuple[str, str]) -> str:
    for pattern, by in rules:
        c = f"regexp_replace({c}, {_text(pattern)}, {_text(by)}, 'g')"
    return c


_LETTER = r"\p{L}\p{M}\p{N}_"


def _clean(c: str) -> str:
    return f"nfc_normalize(strip_accents(lower(coalesce({c}, ''))))"


def _initials(c: str) -> str:
    return _regex(c, (r"\b(\w)\.(\w)\.(\w)\.?", r"\1\2\3"), (r"\b(\w)\.(\w)\b\.?", r"\1\2"))


def _spaced(c: str) -> str:
    return f"trim({_regex(c, ('&', ' & '), ('[' + chr(39) + '’`´]', ''), (f'[^{_LETTER}&' + chr(92) + 's]', ' '), ('_', ' '), (chr(92) + 's+', ' '))})"


def _mapped(c: str, words: dict[str, str]) -> str:
    return f"trim(regexp_replace(array_to_string(list_transform(string_split({c}, ' '), lambda w: coalesce({_map(words)}[w], w)), ' '), '\\s+', ' ', 'g'))"


_NAME = _mapped(_spaced(_regex(_initials(_clean("business_name")), (r"^\s*m\s*/\s*s\b\.?", " "))), NAME_WORDS)
_ADDRESS = _mapped(
    _regex(
        _spaced(_regex(_initials(_clean("business_address")), (r"\b(pin|pincode|pin code|zip|zipcode|postal code|cp)\s*[:\-]?\s*(\d{3})\s+(\d{3})\b", r"\1 \2\3"), (r"(\d{5})-(\d{4})\b", r"\1"), ("#", " number "))),
        (r"(\p{L})(\d)", r"\1 \2"),
    ),
    ADDRESS_WORDS,
)
_LEGAL = "[" + ", ".join(map(_text, LEGAL_WORDS)) + "]"

ENTITIES = """ent AS MATERIALIZED (
  SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS entity_id, split_part(text, chr(10), 1) AS business_name,
         (doc_id % 97) || ' ' || source || ' rd ' || (10000 + doc_id % 500) AS business_address, lang AS country
  FROM documents)"""

NORMALIZED = f"""{ENTITIES}, nrm0 AS MATERIALIZED (
  SELECT *, {_NAME} AS normalized_name, {_ADDRESS} AS normalized_address, {_spaced(_clean("country"))} AS c FROM ent
), nrm1 AS (
  SELECT * EXCLUDE (c), nullif(coalesce({_map(COUNTRY_NAMES)}[c], c), '') AS normalized_country,
    list_filter(string_split(normalized_name, ' '), lambda w: w <> '') AS name_tokens,
    list_filter(string_split(normalized_address, ' '), lambda w: w <> '') AS address_tokens,
    regexp_extract_all(normalized_address, '\\d+') AS numeric_tokens,
    regexp_extract_all(normalized_address, '\\b\\d{{5,6}}\\b') AS postal_all
  FROM nrm0
), nrm2 AS (
  SELECT *, list_filter(postal_all, lambda p, i: list_position(postal_all, p) = i) AS postal_code_candidates,
    list_filter(name_tokens, lambda w: NOT list_contains({_LEGAL}, w)) AS core_tokens,
    list_filter(address_tokens, lambda w: regexp_full_match(w, '\\D{{3,}}')) AS address_word_tokens
  FROM nrm1
), nrm AS MATERIALIZED (
  SELECT * EXCLUDE (postal_all), CASE WHEN len(core_tokens) > 0 THEN array_to_string(core_tokens, ' ') ELSE normalized_name END AS name_core,
    coalesce(array_to_string(list_sort(list_distinct(core_tokens)), ' '), '') AS name_signature,
    coalesce(array_to_string(list_sort(list_distinct(address_word_tokens)), ' '), '') AS address_signature,
    coalesce(array_to_string(list_transform(core_tokens, lambda w: substr(w, 1, 1)), ''), '') AS name_acronym,
    postal_code_candidates[1] AS primary_postal, list_filter(numeric_tokens, lambda n: length(n) <= 4)[1] AS building_number
  FROM nrm2)"""

TRUTH = """docs AS (SELECT 'S' || (1 + doc_id % 3) || '-' || doc_id AS id, text FROM documents),
truth AS MATERIALIZED (SELECT a.id AS s1_id, b.id AS cand_id FROM docs a JOIN docs b USING (text) WHERE starts_with(a.id, 'S1-') AND NOT starts_with(b.id, 'S1-'))"""

_KEYS = {
    "exact_name": "CASE WHEN length(normalized_name) >= 2 THEN [normalized_name] ELSE [] END",
    "exact_core": "CASE WHEN length(name_core) >= 3 THEN [name_core] ELSE [] END",
    "name_signature": "CASE WHEN length(name_signature) >= 3 THEN [name_signature] ELSE [] END",
    "name_token": "list_distinct(list_filter(core_tokens, lambda t: length(t) >= 2))",
    "char_ngram": "CASE WHEN length(name_core) >= 3 THEN list_distinct(list_transform(range(1, least(length(name_core), 15) + 1), lambda i: substr(' ' || replace(substr(name_core, 1, 15), ' ', '_') || ' ', i, 3))) ELSE [] END",
    "addr_token": "list_distinct(list_filter(address_word_tokens, lambda t: length(t) >= 3))",
    "postal_name": "CASE WHEN primary_postal IS NOT NULL AND length(name_core) >= 3 THEN [primary_postal || '#' || substr(name_core, 1, 3)] ELSE [] END",
    "postal_building": "CASE WHEN primary_postal IS NOT NULL AND building_number IS NOT NULL THEN [primary_postal || '#' || building_number] ELSE [] END",
    "token_postal": "CASE WHEN primary_postal IS NOT NULL THEN list_distinct(list_transform(list_filter(core_tokens, lambda t: length(t) >= 2), lambda t: t || '@' || primary_postal)) ELSE [] END",
    "addr_signature": "CASE WHEN len(address_word_tokens) >= 2 THEN [address_signature] ELSE [] END",
}


def _rarest(s: Strategy, x: str) -> str:
    """CTEs ``{x}_raw`` (keys of all) and ``{x}_own`` (those that records of source 1 ask with)."""
    out = f"{x}_raw AS MATERIALIZED (SELECT entity_id, normalized_country AS nc, unnest({_KEYS[s.name]}) AS key FROM nrm)"
    own = f"SELECT * FROM {x}_raw WHERE starts_with(entity_id, 'S1-')"
    if s.rarest is None:
        return f"{out}, {x}_own AS ({own})"
    by, of = ("key", f"{x}_raw") if s.rarest_ceiling else ("split_part(key, '@', 1)", f"(SELECT entity_id, unnest({_KEYS['name_token']}) AS key FROM nrm)")
    limit = f"HAVING count(*) <= {4 * s.cap}" if s.rarest_ceiling else ""
    return f"""{out}, {x}_df AS (SELECT key AS byk, count(*) AS d FROM {of} WHERE NOT starts_with(entity_id, 'S1-') GROUP BY 1 {limit}),
{x}_own AS (SELECT entity_id, nc, key FROM (SELECT o.*, row_number() OVER (PARTITION BY entity_id ORDER BY d, key) AS r FROM ({own}) o JOIN {x}_df ON byk = {by}) WHERE r <= {s.rarest})"""


def _pairs(s: Strategy, x: str) -> str:
    """CTEs that end with ``{x}``: s1_id, cand_id, score, bits of one strategy."""
    place = "coalesce(nc, '?') || '|' || key" if s.scoped else "key"
    asked = f"SELECT DISTINCT entity_id, unnest([coalesce(nc, '?'), '?']) || '|' || key AS key FROM {x}_own" if s.scoped else f"SELECT entity_id, key FROM {x}_own"
    return f"""{_rarest(s, x)}, {x}_all AS (SELECT entity_id AS cand_id, {place} AS key FROM {x}_raw WHERE NOT starts_with(entity_id, 'S1-')),
{x}_idx AS (SELECT cand_id, key, d FROM {x}_all JOIN (SELECT key, count(*) AS d FROM {x}_all GROUP BY key HAVING count(*) <= {s.cap}) USING (key)),
{x} AS (SELECT entity_id AS s1_id, cand_id, sum({s.weight} * ln(1 + (SELECT count(*) FROM nrm WHERE NOT starts_with(entity_id, 'S1-')) / d)) AS score, {s.bit} AS bits FROM ({asked}) JOIN {x}_idx USING (key) GROUP BY 1, 2)"""


def pairs_of(*names: str) -> str:
    """CTEs that end with ``pairs``: s1_id, cand_id, score, bits, source of several strategies."""
    parts = ", ".join(_pairs(STRATEGY[n], f"k{i}") for i, n in enumerate(names))
    union = " UNION ALL ".join(f"SELECT * FROM k{i}" for i in range(len(names)))
    return f"{NORMALIZED}, {parts}, pairs AS MATERIALIZED (SELECT s1_id, cand_id, sum(score) AS score, bit_or(bits)::INT AS bits, substr(cand_id, 2, 1)::INT AS source FROM ({union}) GROUP BY 1, 2)"


ENABLED = tuple(s.name for s in STRATEGIES if s.name != "char_ngram")
SCORED_PAIRS = f"""{pairs_of(*ENABLED)}, {TRUTH}, scored AS MATERIALIZED (
  SELECT pairs.*, round(score / (score + 40), 4) AS p, (truth.s1_id IS NOT NULL)::INT AS label,
    max(round(score / (score + 40), 4)) OVER (PARTITION BY s1_id) AS best,
    row_number() OVER (PARTITION BY s1_id ORDER BY round(score / (score + 40), 4) DESC, cand_id) AS place
  FROM pairs LEFT JOIN truth USING (s1_id, cand_id))"""


def blocked(name: str) -> str:
    return f"WITH {pairs_of(name)} SELECT s1_id, cand_id, round(score, 6) AS score, bits FROM pairs"


def capped(keep: int, *names: str) -> str:
    return f"""WITH {pairs_of(*names)} SELECT s1_id, cand_id, source, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY score DESC, cand_id) AS rank FROM pairs) WHERE rank <= {keep}"""


def recall() -> str:
    scopes = ["('all', true, bits IS NOT NULL)", *(f"('source{s}', source = {s}, bits IS NOT NULL)" for s in (2, 3))]
    for s in STRATEGIES:
        scopes += [f"('{s.name}', true, coalesce(bits & {s.bit} > 0, false))", f"('only_{s.name}', true, coalesce(bits = {s.bit}, false))"]
    rows = " UNION ALL ".join(f"SELECT v.scope, v.found FROM hits, (SELECT {x[1:-1].split(', ', 1)[0]} AS scope, {x[1:-1].split(', ', 2)[1]} AS counts, {x[1:-1].split(', ', 2)[2]} AS found) v WHERE v.counts" for x in scopes)
    return f"""WITH {pairs_of(*ENABLED)}, {TRUTH}, hits AS (SELECT bits, substr(cand_id, 2, 1)::INT AS source FROM truth LEFT JOIN (SELECT s1_id, cand_id, bits FROM pairs) USING (s1_id, cand_id))
SELECT scope, count(*) FILTER (WHERE found) AS found, count(*) AS total, round(count(*) FILTER (WHERE found) / count(*), 6) AS recall FROM ({rows}) GROUP BY scope"""


def rules(thresholds: tuple, ratios: tuple, limits: tuple) -> str:
    """CTEs that end with ``measured``: threshold, ratio, top, tp, fp, precision, recall, f05."""
    def values(name: str, v: tuple) -> str:
        return f"(SELECT unnest([{', '.join(map(str, v))}]) AS {name})"

    return f"""{SCORED_PAIRS}, counted AS (
  SELECT threshold::DOUBLE AS threshold, ratio::DOUBLE AS ratio, top, count(*) FILTER (WHERE ok AND label = 1) AS tp, count(*) FILTER (WHERE ok AND label = 0) AS fp
  FROM (SELECT threshold, ratio, top, label, p >= threshold AND p >= ratio::DOUBLE * best AND (top = 0 OR place <= top) AS ok
        FROM scored, {values("threshold", thresholds)}, {values("ratio", ratios)}, {values("top", limits)}) GROUP BY ALL
), pr AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif((SELECT count(*) FROM truth), 0), 0) AS recall FROM counted
), measured AS (SELECT *, coalesce(1.25 * precision * recall / nullif(0.25 * precision + recall, 0), 0) AS f05 FROM pr)"""


_ROUNDED = "threshold, ratio, top, tp, fp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f05, 6) AS f05"
_S = Settings()
_RULE = "p >= 0.5 AND p >= 0.85 * best AND place <= 3"
_NEXT = "SELECT a.p_partkey, a.p_name AS a, b.p_name AS b FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1"


def _pair_columns(select: str) -> str:
    """Features over the pairs of ``ENABLED``; a is the record, b the candidate."""
    return f"WITH {pairs_of(*ENABLED)} SELECT s1_id, cand_id, {select} FROM pairs JOIN nrm a ON a.entity_id = s1_id JOIN nrm b ON b.entity_id = cand_id"


def _set(x: str, name: str) -> str:
    shared, a, b = f"len(list_intersect(a.{x}, b.{x}))", f"len(list_distinct(a.{x}))", f"len(list_distinct(b.{x}))"
    return (
        f"round({shared} / nullif({a} + {b} - {shared}, 0), 6) AS {name}_jacc, round({shared} / nullif(least({a}, {b}), 0), 6) AS {name}_overlap, "
        f"{shared}::DOUBLE AS {name}_common, round({shared} / nullif({a}, 0), 6) AS {name}_common_ratio"
    )


def _ensemble() -> str:
    grid = weight_grid(3)
    rows = ", ".join(f"({i}, {a!r}::DOUBLE, {b!r}::DOUBLE, {c!r}::DOUBLE)" for i, (a, b, c) in enumerate(grid))
    return f"""WITH {SCORED_PAIRS}, grid(grid, w1, w2, w3) AS (VALUES {rows}),
held AS (SELECT grid, threshold::DOUBLE AS threshold, label FROM (SELECT grid, label, 0.0::DOUBLE + p * w1 + p * p * w2 + sqrt(p) * w3 AS q FROM scored, grid), (SELECT unnest([{", ".join(map(str, _S.thresholds))}]) AS threshold) WHERE q >= threshold::DOUBLE),
c AS (SELECT grid, threshold, count(*) FILTER (WHERE label = 1) AS tp, count(*) FILTER (WHERE label = 0) AS fp FROM held GROUP BY ALL),
m AS (SELECT *, tp / (tp + fp) AS precision, coalesce(tp / nullif((SELECT count(*) FROM truth), 0), 0) AS recall FROM c),
f AS (SELECT *, coalesce(1.25 * precision * recall / nullif(0.25 * precision + recall, 0), 0) AS f05 FROM m)
SELECT grid, threshold, tp, fp, round(f05, 6) AS f05 FROM (SELECT *, row_number() OVER (PARTITION BY grid ORDER BY f05 DESC, threshold) AS n FROM f) WHERE n = 1"""


def _cosine() -> str:
    grams = "unnest(flatten(list_transform(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 1), lambda i: substr(' ' || w || ' ', i, 3)))))"
    return f"""WITH t AS (SELECT DISTINCT p_name AS text FROM part WHERE p_name <> ''), g AS (SELECT text, {grams} AS gram FROM t), tf AS (SELECT text, gram, count(*) AS tf FROM g GROUP BY ALL),
df AS (SELECT gram, count(*) AS df FROM tf GROUP BY gram HAVING count(*) >= 2), w AS (SELECT text, gram, (1 + ln(tf)) * (ln((1 + (SELECT count(*) FROM t)) / (1 + df)) + 1) AS w FROM tf JOIN df USING (gram)),
n AS (SELECT text, gram, w / sqrt(sum(w * w) OVER (PARTITION BY text)) AS w FROM w), p AS ({_NEXT}),
d AS (SELECT p_partkey, sum(x.w * y.w) AS c FROM p JOIN n x ON x.text = a JOIN n y ON y.text = b AND y.gram = x.gram GROUP BY p_partkey)
SELECT p_partkey, round(coalesce(c, 0), 6) AS cosine FROM p LEFT JOIN d USING (p_partkey)"""


def _indel(a: str, b: str, more: str = "", value: str = "") -> str:
    """Similarity of two texts of ``_NEXT`` by the dynamic programme of their longest common subsequence, a row a step."""
    value = value or "CASE WHEN length(a) + length(b) = 0 THEN 1 ELSE 2 * lcs / (length(a) + length(b)) END"
    return f"""WITH RECURSIVE t AS (SELECT p_partkey, {a} AS a, {b} AS b {more} FROM ({_NEXT})), d AS (
  SELECT *, 0 AS i, list_transform(range(length(b) + 1), lambda x: 0) AS r FROM t
  UNION ALL SELECT * EXCLUDE (i, r, c), i + 1, list_transform(range(1, length(b) + 2), lambda j: list_max(c[1:j])) FROM (
    SELECT *, list_concat([0], list_transform(range(1, length(b) + 1), lambda j: CASE WHEN substr(a, i + 1, 1) = substr(b, j, 1) THEN r[j] + 1 ELSE r[j + 1] END)) AS c FROM d WHERE i < length(a))
), f AS (SELECT *, r[length(b) + 1] AS lcs FROM d WHERE i = length(a))
SELECT p_partkey, round({value}, 6) AS sim FROM f"""


def _words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, '\\s+'), lambda w: w <> '')"


def _token_set() -> str:
    x, y = f"list_distinct({_words('a')})", f"list_distinct({_words('b')})"
    rest = lambda p, q: f"array_to_string(list_sort(list_filter({p}, lambda w: NOT list_contains({q}, w))), ' ')"
    shared = f"coalesce(length(array_to_string(list_intersect({x}, {y}), ' ')), 0)"
    value = """CASE WHEN NOT full_sides THEN 0 WHEN s > 0 AND (a = '' OR b = '') THEN 1 ELSE greatest(
      2 * (s + (s > 0)::INT + lcs) / (2 * s + CASE WHEN a = '' THEN 0 ELSE (s > 0)::INT + length(a) END + CASE WHEN b = '' THEN 0 ELSE (s > 0)::INT + length(b) END),
      CASE WHEN s > 0 THEN 2 * s / (2 * s + 1 + length(a)) ELSE 0 END, CASE WHEN s > 0 THEN 2 * s / (2 * s + 1 + length(b)) ELSE 0 END) END"""
    return _indel(rest(x, y), rest(y, x), f", {shared} AS s, len({x}) > 0 AND len({y}) > 0 AS full_sides", value)


_ERRORS = f"""{SCORED_PAIRS}, dec AS (SELECT *, {_RULE} AS pred FROM scored), err AS (
  SELECT s1_id, cand_id, 'fp' AS kind, 'accepted' AS cause FROM dec WHERE pred AND label = 0
  UNION ALL SELECT s1_id, cand_id, 'fn', CASE WHEN pred IS NULL THEN 'missed_by_blocking' ELSE 'below_threshold' END FROM truth LEFT JOIN dec USING (s1_id, cand_id) WHERE pred IS NULL OR NOT pred)"""

SQL = {
    "entry": capped(25, "exact_core"),
    "profile_counts": f"WITH {ENTITIES} SELECT count(*) AS n_rows, count(DISTINCT entity_id) AS n_ids, count(*) - count(DISTINCT entity_id) AS repeated_ids, count(*) FILTER (WHERE business_name IS NULL) AS missing_names, count(*) FILTER (WHERE business_address IS NULL) AS missing_addresses, count(*) FILTER (WHERE country IS NULL OR trim(country) = '') AS missing_countries, count(*) FILTER (WHERE trim(coalesce(business_name, '')) = '') AS empty_names, count(*) FILTER (WHERE trim(coalesce(business_address, '')) = '') AS empty_addresses FROM ent",
    "profile_dups": f"WITH {ENTITIES} SELECT count(*) - count(DISTINCT lower(trim(business_name))) AS repeated_names, count(*) - count(DISTINCT lower(trim(business_address))) AS repeated_addresses, count(*) - count(DISTINCT (lower(trim(coalesce(business_name, ''))), lower(trim(coalesce(business_address, ''))), lower(trim(coalesce(country, ''))))) AS repeated_records FROM ent",
    "profile_text_stats": rf"WITH {ENTITIES} SELECT " + ", ".join(rf"round(avg(length({c})), 6) AS {n}_mean, median(length({c}))::DOUBLE AS {n}_median, max(length({c})) AS {n}_longest, round(avg(len(string_split(trim({c}), ' '))), 6) AS {n}_words, round(avg(regexp_matches({c}, '[0-9]')::INT), 6) AS {n}_with_digit, round(avg(regexp_matches({c}, '[^\x00-\x7F]')::INT), 6) AS {n}_non_ascii" for c, n in (("business_name", "name"), ("business_address", "address"))) + r", round(avg(regexp_matches(business_address, '\b[0-9]{5,6}\b')::INT), 6) AS address_with_postal FROM ent",
    **{f"profile_top_{n}tokens": f"WITH {ENTITIES} SELECT token, count(*) AS n FROM (SELECT unnest(string_split(lower({c}), ' ')) AS token FROM ent) WHERE token <> '' GROUP BY token ORDER BY n DESC, token LIMIT 30" for c, n in (("business_name", ""), ("business_address", "address_"))},
    "profile_categories": f"WITH {ENTITIES} SELECT coalesce(country, '(none)') AS country, count(*) AS n FROM ent GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
    "profile_examples": f"WITH {ENTITIES} SELECT * FROM ent ORDER BY entity_id LIMIT 5",
    "profile_scripts": rf"WITH {ENTITIES}, c AS (SELECT unnest(string_split(business_name, '')) AS c FROM ent), k AS (SELECT CASE WHEN regexp_matches(c, '[A-Za-z]') THEN 'ascii_letter' WHEN regexp_matches(c, '[\p{{Nd}}²³¹⁰⁴-⁹₀-₉]') THEN 'digit' WHEN regexp_matches(c, '[\x09-\x0D\x1C-\x20\x{{0085}}\p{{Z}}]') THEN 'space' WHEN unicode(c) < 128 THEN 'ascii_punct' WHEN unicode(c) < 592 THEN 'latin_ext' WHEN unicode(c) BETWEEN 2304 AND 2431 THEN 'devanagari' ELSE 'other_unicode' END AS script FROM c WHERE c <> '') SELECT script, count(*) AS n, round(count(*) / (SELECT count(*) FROM k), 6) AS share FROM k GROUP BY script",
    "profile_only_in": f"WITH {ENTITIES} SELECT DISTINCT country FROM ent WHERE starts_with(entity_id, 'S1-') AND country NOT IN (SELECT country FROM ent WHERE NOT starts_with(entity_id, 'S1-') AND country <> 'es')",
    "gt_parse_explode": f"WITH {TRUTH} SELECT DISTINCT s1_id, cand_id FROM truth",
    "gt_shape": f"WITH {ENTITIES}, {TRUTH}, l AS (SELECT e.entity_id, count(cand_id) AS n, count(*) FILTER (WHERE starts_with(cand_id, 'S2-')) AS n2, count(*) FILTER (WHERE starts_with(cand_id, 'S3-')) AS n3 FROM ent e LEFT JOIN truth ON s1_id = e.entity_id WHERE starts_with(e.entity_id, 'S1-') GROUP BY 1) SELECT count(*) FILTER (WHERE n = 0) AS without, count(*) FILTER (WHERE n = 1) AS with_one, count(*) FILTER (WHERE n > 1) AS with_several, round(avg(n), 6) AS mean, max(n) AS most, sum(n2)::BIGINT AS source2, sum(n3)::BIGINT AS source3, count(*) FILTER (WHERE n2 > 1) AS several_in_source2 FROM l",
    "gt_shape_hist": f"WITH {ENTITIES}, {TRUTH}, l AS (SELECT e.entity_id, count(cand_id) AS n FROM ent e LEFT JOIN truth ON s1_id = e.entity_id WHERE starts_with(e.entity_id, 'S1-') GROUP BY 1) SELECT least(n, 10) AS matches, count(*) AS n FROM l GROUP BY 1",
    "validate_ids": f"WITH {ENTITIES} SELECT count(*) AS rows, count(DISTINCT entity_id) AS ids, count(*) FILTER (WHERE entity_id IS NULL) AS null_ids, count(*) FILTER (WHERE NOT starts_with(entity_id, 'S')) AS bad_prefix, count(*) FILTER (WHERE trim(coalesce(business_name, '')) = '') AS empty_name, count(*) FILTER (WHERE trim(coalesce(business_address, '')) = '') AS empty_address, count(*) FILTER (WHERE trim(coalesce(country, '')) = '') AS empty_country FROM ent",
    "validate_shared": f"WITH {TRUTH} SELECT cand_id, count(DISTINCT s1_id) AS n FROM truth GROUP BY cand_id HAVING count(DISTINCT s1_id) > 1",
    "norm_name": f"WITH {NORMALIZED} SELECT entity_id, normalized_name FROM nrm",
    "norm_address": f"WITH {NORMALIZED} SELECT entity_id, normalized_address FROM nrm",
    "norm_country": f"WITH {NORMALIZED} SELECT entity_id, normalized_country FROM nrm",
    "derived_tokens": f"WITH {NORMALIZED} SELECT entity_id, coalesce(array_to_string(name_tokens, '|'), '') AS name_tokens, coalesce(array_to_string(core_tokens, '|'), '') AS core_tokens, coalesce(array_to_string(address_tokens, '|'), '') AS address_tokens, coalesce(array_to_string(address_word_tokens, '|'), '') AS address_word_tokens, coalesce(array_to_string(numeric_tokens, '|'), '') AS numeric_tokens FROM nrm",
    "derived_signature": f"WITH {NORMALIZED} SELECT entity_id, name_core, name_signature, address_signature FROM nrm",
    "derived_acronym": f"WITH {NORMALIZED} SELECT entity_id, name_acronym, length(normalized_name) AS name_length, length(normalized_address) AS address_length, len(name_tokens) AS name_word_count, len(address_tokens) AS address_word_count FROM nrm",
    "derived_postal": f"WITH {NORMALIZED} SELECT entity_id, coalesce(array_to_string(postal_code_candidates, '|'), '') AS postals, primary_postal, building_number FROM nrm",
    **{f"blk_{s.name}": blocked(s.name) for s in STRATEGIES},
    "rarest_k_tokens": f"WITH {NORMALIZED}, {_rarest(STRATEGY['name_token'], 'k')} SELECT entity_id, key FROM k_own",
    "cand_union_bits": f"WITH {pairs_of(*ENABLED)} SELECT s1_id, cand_id, source, round(score, 6) AS score, bits, bit_count(bits)::INT AS n_strategies FROM pairs",
    "cand_precap": f"WITH {pairs_of(*ENABLED)} SELECT s1_id, cand_id, source, rank FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, source ORDER BY round(score, 6) DESC, cand_id) AS rank FROM pairs) WHERE rank <= 200",
    "cand_under_served": f"WITH {pairs_of(*ENABLED)} SELECT entity_id AS s1_id, source FROM (SELECT entity_id, unnest([2, 3]) AS source FROM ent WHERE starts_with(entity_id, 'S1-')) e ANTI JOIN (SELECT s1_id, source FROM pairs GROUP BY 1, 2 HAVING count(*) >= 3) s ON e.entity_id = s.s1_id AND e.source = s.source",
    "cand_recall": recall(),
    "cand_reduction": f"WITH {pairs_of(*ENABLED)}, c AS (SELECT entity_id, count(cand_id) AS n FROM ent LEFT JOIN pairs ON s1_id = entity_id WHERE starts_with(entity_id, 'S1-') GROUP BY 1) SELECT sum(n)::BIGINT AS pairs, round(avg(n), 6) AS mean_candidates, median(n)::DOUBLE AS median_candidates, max(n) AS max_candidates, round(1 - sum(n) / (count(*) * (SELECT count(*) FROM ent WHERE NOT starts_with(entity_id, 'S1-'))), 9) AS reduction FROM c",
    "sim_levenshtein": f"SELECT p_partkey, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 1 ELSE 1 - levenshtein(a, b) / greatest(length(a), length(b)) END, 6) AS sim FROM ({_NEXT})",
    "sim_jaro": f"SELECT p_partkey, round(jaro_similarity(a, b), 6) AS sim FROM ({_NEXT})",
    "sim_jaro_winkler": f"SELECT p_partkey, round(jaro_winkler_similarity(a, b), 6) AS sim FROM ({_NEXT})",
    "sim_indel": _indel("a", "b"),
    "sim_token_sort": _indel(*(f"array_to_string(list_sort({_words(c)}), ' ')" for c in "ab")),
    "sim_token_set": _token_set(),
    "sim_prefix": f"SELECT p_partkey, round(CASE WHEN greatest(length(a), length(b)) = 0 THEN 1 ELSE list_max(list_filter(range(least(length(a), length(b)) + 1), lambda n: left(a, n) = left(b, n))) / greatest(length(a), length(b)) END, 6) AS sim FROM ({_NEXT})",
    "feat_set_overlap": _pair_columns(f"{_set('name_tokens', 'name_tok')}, {_set('core_tokens', 'core_tok')}, {_set('address_tokens', 'addr_tok')}"),
    "feat_numeric_postal": _pair_columns("""len(list_intersect(a.numeric_tokens, b.numeric_tokens))::DOUBLE AS num_common, round(len(list_intersect(a.numeric_tokens, b.numeric_tokens)) / greatest(len(a.numeric_tokens), len(b.numeric_tokens), 1), 6) AS num_jacc,
      CASE WHEN len(a.postal_code_candidates) > 0 AND len(b.postal_code_candidates) > 0 THEN (len(list_intersect(a.postal_code_candidates, b.postal_code_candidates)) > 0)::INT::DOUBLE END AS postal_match,
      (len(a.postal_code_candidates) > 0 AND len(b.postal_code_candidates) > 0)::INT AS postal_both_present,
      (len(a.postal_code_candidates) > 0 AND len(b.postal_code_candidates) > 0 AND len(list_intersect(a.postal_code_candidates, b.postal_code_candidates)) = 0)::INT AS postal_conflict, (a.building_number = b.building_number)::INT::DOUBLE AS building_match"""),
    "feat_length_exact": _pair_columns("""abs(length(a.normalized_name) - length(b.normalized_name))::DOUBLE AS name_len_diff, round(least(length(a.normalized_name), length(b.normalized_name)) / greatest(length(a.normalized_name), length(b.normalized_name), 1), 6) AS name_len_ratio,
      abs(length(a.normalized_address) - length(b.normalized_address))::DOUBLE AS addr_len_diff, abs(len(a.name_tokens) - len(b.name_tokens))::DOUBLE AS name_wc_diff,
      (a.normalized_name = b.normalized_name AND a.normalized_name <> '')::INT AS name_exact, (a.name_core = b.name_core AND a.normalized_name <> '')::INT AS core_exact, (a.normalized_address = b.normalized_address AND a.normalized_address <> '')::INT AS addr_exact"""),
    "feat_acronym": _pair_columns("((length(a.name_acronym) >= 2 AND a.name_acronym = replace(b.name_core, ' ', '')) OR (length(b.name_acronym) >= 2 AND b.name_acronym = replace(a.name_core, ' ', '')))::INT AS name_acronym_match, (a.normalized_country = b.normalized_country)::INT::DOUBLE AS country_match, (a.normalized_country IS NULL OR b.normalized_country IS NULL)::INT AS country_missing"),
    "feat_group_context": f"""WITH {SCORED_PAIRS} SELECT s1_id, cand_id, CAST(count(*) OVER g AS DOUBLE) AS grp_n_cands, CAST(count(*) OVER s AS DOUBLE) AS grp_n_cands_src, CAST(rank() OVER (PARTITION BY s1_id ORDER BY p DESC) AS DOUBLE) AS name_jw_rank, round(max(p) OVER g - p, 6) AS name_jw_gap,
      CAST(rank() OVER (PARTITION BY s1_id ORDER BY p DESC) AS DOUBLE) AS na_rank, round(max(p) OVER g - p, 6) AS na_gap, round(max(p) OVER s - p, 6) AS quick_gap, CAST(count(*) OVER (PARTITION BY s1_id, name_core) AS DOUBLE) AS grp_same_name, CAST(sum(label) OVER g AS DOUBLE) AS grp_n_core_exact
      FROM scored JOIN nrm ON entity_id = cand_id WINDOW g AS (PARTITION BY s1_id), s AS (PARTITION BY s1_id, source)""",
    "feat_strategy_flags": f"WITH {pairs_of(*ENABLED)} SELECT s1_id, cand_id, " + ", ".join(f"((bits & {s.bit}) > 0)::INT AS blk_{s.name}" for s in STRATEGIES) + ", ((bits & 1024) > 0)::INT AS blk_fuzzy FROM pairs",
    "feat_tfidf_cosine": _cosine(),
    "hard_negatives": f"WITH {SCORED_PAIRS} SELECT s1_id, cand_id, label FROM (SELECT *, row_number() OVER (PARTITION BY s1_id, label ORDER BY p DESC, cand_id) AS r FROM scored) WHERE label = 1 OR r <= 5",
    "label_join": f"WITH {SCORED_PAIRS} SELECT s1_id, cand_id, label FROM scored",
    "decision_rule": f"WITH {SCORED_PAIRS} SELECT s1_id, cand_id, {_RULE} AS pred FROM scored",
    "threshold_search": f"WITH {rules(_S.thresholds, (0.0,), (0,))} SELECT {_ROUNDED} FROM measured",
    "rule_search": f"WITH {rules(_S.thresholds, _S.ratios, _S.limits)} SELECT {_ROUNDED} FROM measured ORDER BY round(f05, 6) DESC, round(precision, 6) DESC, ratio, top, threshold LIMIT 1",
    "rule_grid": f"WITH {rules(_S.thresholds, _S.ratios, _S.limits)} SELECT {_ROUNDED} FROM measured",
    "ensemble_weighted": _ensemble(),
    "eval_prf": f"""WITH {SCORED_PAIRS}, k AS (SELECT s1_id, cand_id, label FROM scored WHERE {_RULE}), r AS (
      SELECT e.entity_id, (SELECT count(*) FROM k WHERE k.s1_id = e.entity_id) AS n_kept, (SELECT count(*) FROM truth t WHERE t.s1_id = e.entity_id) AS n_true, (SELECT count(*) FROM k WHERE k.s1_id = e.entity_id AND label = 1) AS hit FROM ent e WHERE starts_with(e.entity_id, 'S1-')
    ), s AS (SELECT sum(hit)::BIGINT AS tp, sum(n_kept - hit)::BIGINT AS fp, sum(n_true - hit)::BIGINT AS fn, coalesce(avg(CASE WHEN n_true = 0 THEN (n_kept = 0)::INT END), 1) AS singleton_correct, avg(n_kept) AS mean_matches, count(*) FILTER (WHERE n_kept = 0) AS unmatched FROM r
    ), m AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM s)
    SELECT tp, fp, fn, round(singleton_correct, 6) AS singleton_correct, round(mean_matches, 6) AS mean_matches, unmatched, round(precision, 6) AS precision, round(recall, 6) AS recall,
      round(coalesce(1.25 * precision * recall / nullif(0.25 * precision + recall, 0), 0), 6) AS f05, round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0), 6) AS f1 FROM m""",
    "error_rows": f"WITH {_ERRORS} SELECT * FROM err",
    "error_buckets": f"WITH {_ERRORS} SELECT kind, cause, substr(cand_id, 2, 1)::INT AS source, CASE WHEN p >= 0.9 THEN '>=0.9' WHEN p >= 0.7 THEN '0.7-0.9' WHEN p IS NOT NULL THEN '<0.7' ELSE 'unknown' END AS level, count(*) AS n FROM err LEFT JOIN (SELECT s1_id, cand_id, p FROM scored) USING (s1_id, cand_id) GROUP BY ALL",
    "submission_lists": f"WITH {SCORED_PAIRS} SELECT entity_id AS source1_entity_id, coalesce((SELECT string_agg(DISTINCT cand_id, ',' ORDER BY cand_id) FROM scored WHERE s1_id = entity_id AND {_RULE}), '') AS matched_entity_ids FROM ent WHERE starts_with(entity_id, 'S1-')",
    "submission_check": f"""WITH {SCORED_PAIRS}, o AS (
      SELECT entity_id AS s1_id, (SELECT count(DISTINCT cand_id) FROM scored WHERE s1_id = entity_id AND {_RULE}) AS n, country FROM ent WHERE starts_with(entity_id, 'S1-'))
    SELECT 'missing' AS problem, count(*) FILTER (WHERE country = 'fr') AS n FROM o
    UNION ALL SELECT 'extra', count(*) FROM ent WHERE starts_with(entity_id, 'S2-') AND country = 'fr'
    UNION ALL SELECT 'repeated', count(*) FROM o WHERE country = 'es'
    UNION ALL SELECT 'unknown', count(*) FROM o WHERE country = 'de'
    UNION ALL SELECT 'not_candidate', (SELECT count(*) FROM o WHERE country = 'de') + (SELECT count(*) FROM ent WHERE starts_with(entity_id, 'S2-') AND country = 'fr')""",
    "sample_export": f"""WITH {SCORED_PAIRS}, k AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, cand_id) AS m FROM scored WHERE {_RULE}), r AS (
      SELECT country, s1_id, business_name, cand_id, p, dense_rank() OVER (PARTITION BY country ORDER BY s1_id) AS r FROM k JOIN ent ON entity_id = s1_id WHERE m <= 2) SELECT country, s1_id, business_name, cand_id, p FROM r WHERE r <= 4""",
    "join_semi": f"WITH {ENTITIES}, {TRUTH} SELECT entity_id, country FROM ent WHERE entity_id IN (SELECT s1_id FROM truth)",
    "join_anti": f"WITH {ENTITIES}, {TRUTH} SELECT entity_id, country FROM ent WHERE starts_with(entity_id, 'S1-') AND entity_id NOT IN (SELECT s1_id FROM truth)",
    "union_diagonal": "SELECT n_name AS name, n_regionkey AS region, NULL::DOUBLE AS balance FROM nation UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier",
    "running_pairs": f"WITH {pairs_of(*ENABLED)}, c AS (SELECT s1_id, count(*) AS n FROM pairs GROUP BY 1) SELECT s1_id, sum(n) OVER (ORDER BY s1_id)::BIGINT AS running FROM c",
    "ext_event_windows": "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL",
}
