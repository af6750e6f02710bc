"""URL filtering: explicit rules first, then empirical-Bayes host reputation.

Labelled pages give every host, registered domain and public suffix its counts of good and bad pages.
A level's beta-binomial prior has its parent's posterior mean and a strength estimated over all of
the level's members by the method of moments; so a host with few labels is judged by its domain, a domain with few
by its suffix, a suffix by the whole. A url is blocked when the lower bound of its host's bad
share, ``z`` standard deviations below the posterior mean, is above ``limit``.

Everything is a DataFrame expression. Pages meet the table of hosts in one join by host, whose
skew (one host with a third of all pages) Spark splits, as nothing after it needs that partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Public suffixes of two labels that are told from registered domains.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "or.jp", "com.br", "com.cn", "com.mx", "co.in", "co.za", "com.tr")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``text``: a host, then a path beginning, like ``net/de/``; it fits the host and its subdomains."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.when(url.contains("://"), F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    return F.when(url.contains("://"), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise("")


def suffix_of(host: Column) -> Column:
    name = F.regexp_replace(host, r":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column) -> Column:
    name = F.regexp_replace(host, r":[0-9]*$", "")
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(two)


def shrink(nodes: DataFrame) -> DataFrame:
    """``nodes`` (n labelled pages, bad of them, mean of the parent) with the posterior's ``a`` and ``b``.

    The strength solves sum n(p - m)^2 / m(1 - m) = sum 1 + (n - 1) rho over members with labels, rho
    being 1 / (strength + 1), held between 0.001 and 0.9.
    """
    share = F.col("bad") / F.col("n")
    row = nodes.where("n > 0").agg(
        F.sum(F.col("n") * (share - F.col("mean")) ** 2 / (F.col("mean") * (1 - F.col("mean")))).alias("spread"),
        F.count("*").alias("members"),
        F.sum(F.col("n") - 1).alias("extra"),
    ).first()
    rho = (row["spread"] - row["members"]) / row["extra"] if row["extra"] else 0.0
    strength = 1 / min(0.9, max(0.001, rho)) - 1
    return nodes.withColumns({"a": F.col("mean") * strength + F.col("bad"), "b": (1 - F.col("mean")) * strength + F.col("n") - F.col("bad")})


def host_reputation(pages: DataFrame, outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """One row per host of ``pages`` (page_id, host): host, bound (lower bound of its bad share).

    ``outcomes``: page_id and bad (0 or 1); null ids and outcomes are left out, repeated ones count each.
    Hosts without labels have their domain's posterior; without any labels the bad share is one half.
    """
    labelled = outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL")
    counts = pages.join(labelled, "page_id").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").cast("long").alias("bad"))
    hosts = pages.groupBy("host").agg(F.count("*").alias("pages")).join(counts, "host", "left").select("host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad"), domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    hosts = common.saved(hosts, "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)

    def level(key: str) -> DataFrame:
        return hosts.groupBy(key).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.min("suffix").alias("of"))

    posterior = (F.col("a") / (F.col("a") + F.col("b"))).alias("mean")
    suffixes = common.saved(shrink(level("suffix").withColumn("mean", F.lit(mean))).select(F.col("suffix").alias("of"), posterior), "suffixes")
    domains = common.saved(shrink(level("domain").join(suffixes, "of")).select("domain", posterior), "domains")
    judged = shrink(common.saved(hosts.join(domains, "domain"), "judged"))
    m = F.col("a") / (F.col("a") + F.col("b"))
    return judged.select("host", (m - z * F.sqrt(m * (1 - m) / (F.col("a") + F.col("b") + 1))).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], z: float = 1.645, limit: float = 0.5) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A null url, or one without ``://``, has an empty host and path; empty hosts are one host without a
    domain. ``rules`` are a list on the driver; the longest that fits wins (ties: by spelling).
    Null page ids are judged by their host. Repeated rows give a row each; an empty table gives no rows.
    """
    parsed = pages.select("page_id", F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"), F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"))
    bounds = host_reputation(parsed, outcomes, z).withColumnRenamed("host", "__host")
    rule, verdict = F.lit(None).cast("string"), F.when(F.col("bound") > limit, "block").otherwise("allow")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is looked at first
        fits = r.fits(F.col("host"), F.col("path"))
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return parsed.join(bounds, F.col("host") == F.col("__host")).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


RULES = [Rule("block", "com/en/"), Rule("allow", "example.com/en/7"), Rule("allow", "net/de/"), Rule("block", "example.net/de/8"), Rule("block", "org/es/")]


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's outcome is the quality label of the document with its number."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return judge_urls(pages, labels.select(F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad")), RULES)


def _sql() -> str:
    suffixes = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    cases = {"rule": "", "verdict": ""}
    for r in sorted(RULES, key=lambda r: (-len(r.text), r.text)):
        name, slash, rest = r.text.partition("/")
        fit = f"(host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}')"
        cases["rule"] += f" WHEN {fit} THEN '{r.text}'"
        cases["verdict"] += f" WHEN {fit} THEN '{r.verdict}'"

    def strength(table: str) -> str:
        return f"""(SELECT 1 / least(0.9, greatest(0.001, coalesce((sum(n * (bad / n - mean) ** 2 / (mean * (1 - mean))) - count(*)) / nullif(sum(n - 1), 0), 0))) - 1 FROM {table} WHERE n > 0)"""

    return rf"""
WITH p AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), '{_UPPER}', '{_LOWER}') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's') ELSE '' END AS path
  FROM pages
), pd AS (
  SELECT *, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS parts FROM p
), ps AS (
  SELECT page_id, host, path, CASE WHEN array_to_string(parts[-2:], '.') IN ({suffixes}) THEN array_to_string(parts[-2:], '.') ELSE parts[-1] END AS suffix,
         CASE WHEN array_to_string(parts[-2:], '.') IN ({suffixes}) THEN array_to_string(parts[-3:], '.') ELSE array_to_string(parts[-2:], '.') END AS domain
  FROM pd
), h AS (
  SELECT host, any_value(domain) AS domain, any_value(suffix) AS suffix, count(quality) AS n, coalesce(sum(1 - quality), 0) AS bad
  FROM ps LEFT JOIN labels ON doc_id = page_id GROUP BY host
), s0 AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM h) AS mean FROM h GROUP BY suffix
), s AS (SELECT suffix, (mean * {strength("s0")} + bad) / ({strength("s0")} + n) AS mean FROM s0
), d0 AS (
  SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain
), d1 AS (SELECT d0.*, s.mean FROM d0 JOIN s USING (suffix)
), d AS (SELECT domain, (mean * {strength("d1")} + bad) / ({strength("d1")} + n) AS mean FROM d1
), h1 AS (SELECT h.*, d.mean FROM h JOIN d USING (domain)
), h2 AS (SELECT host, mean * {strength("h1")} + bad AS a, (1 - mean) * {strength("h1")} + n - bad AS b FROM h1
), h3 AS (SELECT host, a / (a + b) - 1.645 * sqrt(a / (a + b) * (b / (a + b)) / (a + b + 1)) AS bound FROM h2
)
SELECT page_id, host, path, CASE{cases["rule"]} ELSE NULL END AS rule, CASE{cases["verdict"]} WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM p JOIN h3 USING (host)
"""


OP3_SQL = _sql()
