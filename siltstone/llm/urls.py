"""URL filters: prefix rules first, then an empirical-Bayes host reputation.

Rules: each names a host and a path prefix; it fits its host and all its
subdomains where the url's path starts with its path, and the longest fitting
rule (of host, then path) decides.  Hosts without a rule are judged by the
outcomes of their labelled pages, shrunk through beta-binomial priors: a
suffix's good share towards the overall share, a registered domain's towards
its suffix's, a host's towards its domain's.  Each level's prior weight is
estimated from the data by the method of moments over that level's groups, and
is no more than the evidence that the level above has.  A
url is blocked if the upper posterior bound of its host's good share (mean plus
``SIGMAS`` posterior deviations) is under ``BELOW`` of the overall share: hosts that
are clearly worse than the rest go, hosts of which little is known are let pass.

A host's suffix is its last label, or its last two where the last is a country's
(two letters) and the one before it names a registry's class (``SECOND``: co.uk,
com.br); its registered domain is the label before the suffix with it.  Ports and
user names are left out of that; an address in numbers is a domain of its own.

An outcome of a page is the quality label (1 good, 0 bad) of the document whose
number ends the page's path; pages without one have none.

Defined cases: a null url, or one without ``://``, has an empty host and path;
the empty host has no outcomes and takes the overall share; without labels
every url that no rule blocks is allowed; no pages give no rows.  Repeated rows
stay; label rows for the same document count once (the smallest quality); a url of
any length is read whole; columns besides page_id, url, doc_id and quality are not
read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm import common

SIGMAS, BELOW = 2.0, 0.75
#: Bounds of a prior's weight, in pages.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1000.0


# Labels under which countries' registries register names.
SECOND = ("ac", "co", "com", "edu", "gen", "go", "gob", "gouv", "gov", "govt", "gr", "ltd", "me", "mil", "ne", "net", "nhs", "nom", "or", "org", "plc", "police", "sch")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def first_rule(rules: tuple[Rule, ...], host: Column, path: Column, value: str) -> Column:
    """The name or verdict of the longest fitting rule, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host), len(r.path), r.name)):
        out = F.when(fits(r, host, path), F.lit(getattr(r, value))).otherwise(out)
    return out


def prior_weight(groups: DataFrame) -> float:
    """The weight of a level's prior, in pages, by the method of moments: with ``v`` the variance of the groups' shares about
    their prior means (weighted by pages, less the sampling part), it is ``mean(p(1-p)) / v - 1``, within bounds; a level
    of fewer than two groups with outcomes says nothing about their variance and has the least weight."""
    share, p, n = F.col("good") / F.col("n"), F.col("prior_mean"), F.col("n")
    m = groups.where("n > 0").agg(F.sum(n * (share - p) * (share - p)).alias("spread"), F.sum(p * (1 - p)).alias("chance"), F.sum(n * p * (1 - p)).alias("scale"), F.sum(n).alias("pages"), F.count("*").alias("groups")).first()
    if m["groups"] < 2:
        return LEAST_WEIGHT
    between = max((m["spread"] - m["chance"]) / m["pages"], 1e-9)
    return min(max(m["scale"] / m["pages"] / between - 1, LEAST_WEIGHT), MOST_WEIGHT)


def shrunk(groups: DataFrame, key: str) -> DataFrame:
    """(key, n, good, prior_mean, prior_evidence) to the posterior mean of each group and the pages of evidence behind it; a prior weighs no more than the pages that it rests on."""
    weight = F.least(F.lit(prior_weight(groups)), F.col("prior_evidence"))
    return groups.select(key, "n", "good", ((F.col("good") + weight * F.col("prior_mean")) / (F.col("n") + weight)).alias("mean"), (F.col("n") + weight).alias("evidence"))


BARE = r"^[^@]*@|:[0-9]*$"
NUMERIC = r"^([0-9]+[.][0-9]+[.][0-9]+[.][0-9]+|\[.*\])$"
TWO_LEVEL = rf"(^|[.])({'|'.join(SECOND)})[.][a-z][a-z]$"


def suffix_of(host: Column) -> Column:
    bare = F.regexp_replace(host, BARE, "")
    return F.when(bare.rlike(NUMERIC), bare).when(bare.rlike(TWO_LEVEL), F.substring_index(bare, ".", -2)).otherwise(F.substring_index(bare, ".", -1))


def domain_of(host: Column) -> Column:
    bare = F.regexp_replace(host, BARE, "")
    return F.when(bare.rlike(NUMERIC), bare).when(bare.rlike(TWO_LEVEL), F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))


def reputation(hosts: DataFrame) -> DataFrame:
    """(host, n, good) counts of labelled outcomes to (host, mean, upper, overall): the posterior mean, its upper bound and the overall share."""
    host = F.col("host")
    named = hosts.withColumn("domain", domain_of(host)).withColumn("suffix", suffix_of(host))
    domains = named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    every = suffixes.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((every["good"] or 0) + 1) / ((every["n"] or 0) + 2)
    above = lambda d, key: d.select(key, F.col("mean").alias("prior_mean"), F.col("evidence").alias("prior_evidence"))
    top = shrunk(suffixes.withColumn("prior_mean", F.lit(overall)).withColumn("prior_evidence", F.lit(float((every["n"] or 0) + 2))), "suffix")
    middle = shrunk(domains.join(above(top, "suffix"), "suffix"), "domain")
    low = shrunk(named.select("host", "domain", "n", "good").join(above(middle, "domain"), "domain"), "host")
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("evidence") + 1))
    return low.select("host", "n", "mean", (F.col("mean") + SIGMAS * spread).alias("upper"), F.lit(overall).alias("overall"))


def outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n, good): every host of the pages with its labelled pages and the good ones among them."""
    seen = pages.select(host_of(F.col("url")).alias("host"), F.expr("try_cast(nullif(regexp_extract(path, '([0-9]+)[^0-9/]*/?$', 1), '') as bigint)").alias("number"))
    named = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    joined = seen.join(named, seen.number == named.doc_id, "left")
    return joined.groupBy("host").agg(F.count("quality").alias("n"), F.coalesce(F.sum(F.when(F.col("quality") > 0, 1).otherwise(0).cast("long")), F.lit(0)).alias("good"))


def judge(pages: DataFrame, labels: DataFrame, rules: tuple[Rule, ...] = RULES, below: float = BELOW) -> DataFrame:
    """One row a page: page_id, host, path, the rule that fits (else null), the verdict, and the host's posterior mean and bound."""
    url = F.col("url")
    cut = common.pick(pages, "page_id", "url").select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    known = reputation(common.stash(outcomes(cut, common.pick(labels, "doc_id", "quality")), "url-hosts"))
    host, path = F.col("host"), F.col("path")
    ruled = cut.withColumn("rule", first_rule(rules, host, path, "name")).withColumn("by_rule", first_rule(rules, host, path, "verdict"))
    method = F.when(F.col("upper") < F.lit(below) * F.col("overall"), F.lit("block")).otherwise(F.lit("allow"))
    joined = ruled.join(known, "host", "left")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("by_rule", method).alias("verdict"), F.col("mean").alias("reputation"), "upper")


def oracle_sql(rules: tuple[Rule, ...] = RULES, below: float = BELOW) -> str:
    """page_id, host, path, rule and verdict over pages and labels, in DuckDB."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    longest_first = sorted(rules, key=lambda r: (len(r.host), len(r.path), r.name), reverse=True)
    fit = lambda r: f"(host = {quote(r.host)} OR ends_with(host, {quote('.' + r.host)})) AND starts_with(path, {quote(r.path)})"
    name = "CASE " + " ".join(f"WHEN {fit(r)} THEN {quote(r.name)}" for r in longest_first) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fit(r)} THEN {quote(r.verdict)}" for r in longest_first) + " END"
    weight = lambda t: f"""SELECT coalesce(CASE WHEN count(*) < 2 THEN {LEAST_WEIGHT} END, least(greatest(sum(n * p * (1 - p)) / sum(n) / greatest((sum(n * (good / n - p) * (good / n - p)) - sum(p * (1 - p))) / sum(n), 1e-9) - 1, {LEAST_WEIGHT}), {MOST_WEIGHT})) AS weight FROM {t} WHERE n > 0"""
    return f"""
WITH cut AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), named AS (
  SELECT doc_id, min(quality) AS quality FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), bare AS (
  SELECT host, path, regexp_replace(host, '{BARE}', '', 'g') AS b FROM cut
), parts AS (
  SELECT host, path, regexp_matches(b, '{NUMERIC}') AS numeric_, regexp_matches(b, '{TWO_LEVEL}') AS two, string_split(b, '.') AS l, b FROM bare
), hosts AS (
  SELECT host, any_value(CASE WHEN numeric_ THEN b WHEN two THEN array_to_string(l[-2:], '.') ELSE l[-1] END) AS suffix,
         any_value(CASE WHEN numeric_ THEN b WHEN two THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END) AS domain,
         count(quality) AS n, CAST(count(*) FILTER (WHERE quality > 0) AS DOUBLE) AS good
  FROM parts LEFT JOIN named ON TRY_CAST(nullif(regexp_extract(path, '([0-9]+)[^0-9/]*/?$', 1), '') AS BIGINT) = named.doc_id
  GROUP BY host
), domains AS (
  SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY domain, suffix
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good FROM domains GROUP BY suffix
), overall AS (
  SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS p, coalesce(sum(n), 0) + 2 AS e FROM suffixes
), s0 AS (SELECT suffixes.*, p, e FROM suffixes, overall
), sw AS ({weight("s0")}
), s1 AS (SELECT suffix, (good + least(weight, e) * p) / (n + least(weight, e)) AS mean, n + least(weight, e) AS evidence FROM s0, sw
), d0 AS (SELECT domains.*, s1.mean AS p, s1.evidence AS e FROM domains JOIN s1 USING (suffix)
), dw AS ({weight("d0")}
), d1 AS (SELECT domain, (good + least(weight, e) * p) / (n + least(weight, e)) AS mean, n + least(weight, e) AS evidence FROM d0, dw
), h0 AS (SELECT hosts.*, d1.mean AS p, d1.evidence AS e FROM hosts JOIN d1 USING (domain)
), hw AS ({weight("h0")}
), h1 AS (SELECT host, (good + least(weight, e) * p) / (n + least(weight, e)) AS mean, n + least(weight, e) AS evidence FROM h0, hw
)
SELECT page_id, cut.host, path, {name} AS rule,
       coalesce({verdict}, CASE WHEN mean + {SIGMAS} * sqrt(mean * (1 - mean) / (evidence + 1)) < {below} * overall.p THEN 'block' ELSE 'allow' END) AS verdict
FROM cut CROSS JOIN overall LEFT JOIN h1 ON cut.host = h1.host
""".replace("cut.host, path", "cut.host AS host, path").replace("(host = ", "(cut.host = ").replace("ends_with(host,", "ends_with(cut.host,")
