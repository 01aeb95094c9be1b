"""URL filter: explicit rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes (good or bad) are counted by host. Beta-binomial priors
shrink them level by level: a suffix (``com``) towards all pages, a registered
domain (``example.com``) towards its suffix, a host (``blog.example.com``)
towards its domain. How strongly a level shrinks is fitted from the data: the
method of moments gives the correlation of outcomes inside a group, and
``1 / correlation - 1`` is the weight of the prior in pages. A host is blocked
when even the lower bound of its posterior bad rate exceeds ``max_bad_rate``.

Counts are folded in the map tasks, so a host with a third of all pages costs
no more than another; the join back to the pages is an ordinary equi-join whose
hot partition adaptive execution splits. Three single rows (the fit of each
level) reach the driver.

Defined results: a null url, or one without ``://``, has an empty host and path
and belongs to the empty host. A page without a rule on a host without any label
gets the verdict of its domain's prior. Several outcomes of one page count
once, bad wins; null outcomes and outcomes of unknown pages do not count.
Repeated pages are judged once per row. Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, landed, query, table


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, on paths that start with ``path``."""

    host: str
    path: str
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", True), Rule("example.org", "/es/", False), Rule("example.org", "/en/1", False),
    Rule("com", "/fr/", True), Rule("com", "/de/", False),
)
#: Suffixes of two labels under which domains are registered; all others have one.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "com.br", "co.jp", "co.nz", "com.mx")
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Bounds of the fitted correlation inside a group, and its value without data.
LEAST, MOST, UNKNOWN = 0.0001, 0.5, 0.05


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, URL, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def domain_of(host: Column, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    """The label before the suffix, with the suffix; an address or a single label is its own domain."""
    ending = "|".join([s.replace(".", r"\.") for s in suffixes] + [r"[^.]+"])
    found = F.regexp_extract(host, rf"([^.]+\.(?:{ending}))$", 1)
    return F.when(host.rlike(r"^[0-9.:]+$") | (found == ""), host).otherwise(found)


def suffix_of(domain: Column) -> Column:
    return F.regexp_extract(domain, r"^[^.]+\.(.+)$", 1)


def matching_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Text of the longest rule that fits, else null."""
    whens = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        whens = F.when(fits, r.text) if whens is None else whens.when(fits, r.text)
    return F.lit(None).cast("string") if whens is None else whens


def _shrunk(groups: DataFrame) -> DataFrame:
    """``mean`` of groups with counts ``n`` and ``k`` under their ``prior``; adds ``weight``."""
    n, k, m = F.col("n"), F.col("k"), F.col("prior")
    spread = m * (1 - m)
    fit = groups.agg(
        F.sum((k - n * m) * (k - n * m)).alias("seen"),
        F.sum(n * spread).alias("chance"),
        F.sum(n * (n - 1) * spread).alias("scale"),
    ).first()
    rho = (fit["seen"] - fit["chance"]) / fit["scale"] if fit["scale"] else UNKNOWN
    rho = min(max(rho, LEAST), MOST)
    weight = F.lit((1 - rho) / rho)
    return groups.select("*", weight.alias("weight"), ((k + weight * m) / (n + weight)).alias("mean"))


def host_reputation(hosts: DataFrame, suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES, z: float = 1.645) -> DataFrame:
    """Hosts with label counts ``n`` and ``k`` (bad) -> posterior ``mean`` and ``bound``."""
    hosts = hosts.select("host", "n", "k", domain_of(F.col("host"), suffixes).alias("domain"))
    hosts = landed(hosts.select("*", suffix_of(F.col("domain")).alias("suffix")), "hosts")
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    all_pages = hosts.agg(*counts).first()
    base = ((all_pages["k"] or 0) + 1) / ((all_pages["n"] or 0) + 2)
    by_suffix = _shrunk(domains.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(base)))
    by_domain = _shrunk(domains.join(by_suffix.select("suffix", F.col("mean").alias("prior")), "suffix"))
    by_host = _shrunk(hosts.join(by_domain.select("domain", F.col("mean").alias("prior")), "domain"))
    a = F.col("k") + F.col("weight") * F.col("prior")
    b = F.col("n") - F.col("k") + F.col("weight") * (1 - F.col("prior"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return by_host.select(
        "host", "domain", "suffix", "n", "k", F.col("mean"),
        F.greatest(F.lit(0.0), F.col("mean") - z * deviation).alias("bound"),
    )


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, max_bad_rate: float = 0.5,
    suffixes: tuple[str, ...] = TWO_LABEL_SUFFIXES, z: float = 1.645,
) -> DataFrame:
    """``pages`` (page_id, url) and ``outcomes`` (page_id, bad boolean) -> a verdict for each page.

    Returns page_id, host, path, rule, verdict, n_labels, n_bad, bad_rate, bad_bound.
    """
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    known = outcomes.where(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
    known = known.groupBy("page_id").agg(F.max(F.col("bad").cast("long")).alias("bad"))
    labelled = judged.select("page_id", "host").join(known, "page_id", "left")
    hosts = labelled.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k")
    )
    reputation = host_reputation(hosts, suffixes, z)
    verdicts = reputation.select(
        "host", F.col("n").alias("n_labels"), F.col("k").alias("n_bad"),
        F.col("mean").alias("bad_rate"), F.col("bound").alias("bad_bound"),
    )
    allowed = [r.text for r in rules if r.allow]
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    by_rule = F.when(F.col("rule").isin(allowed), "allow").otherwise("block")
    by_host = F.when(F.col("bad_bound") > max_bad_rate, "block").otherwise("allow")
    return judged.join(verdicts, "host", "left").select("page_id", "host", "path", rule.alias("rule"), *verdicts.columns[1:]).select(
        "page_id", "host", "path", "rule",
        F.when(F.col("rule").isNotNull(), by_rule).otherwise(by_host).alias("verdict"),
        "n_labels", "n_bad", "bad_rate", "bad_bound",
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """The label row with a page's number is that page's outcome: bad if of poor quality or toxic."""
    return labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))


_LEVEL = """
{name}_fit AS (
  SELECT coalesce(least(0.5, greatest(0.0001, (sum((k - n * prior) * (k - n * prior)) - sum(n * prior * (1 - prior)))
    / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0))), 0.05) AS rho FROM {name}_prior),
{name}_mean AS (
  SELECT p.*, (1 - rho) / rho AS weight, (k + (1 - rho) / rho * prior) / (n + (1 - rho) / rho) AS mean
  FROM {name}_prior p, {name}_fit)"""


@query(
    r"""
WITH cut AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
known AS (
  SELECT doc_id AS page_id, max(CAST(quality = 0 OR toxic = 1 AS BIGINT)) AS bad FROM labels GROUP BY ALL),
hosts AS (
  SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS k,
    regexp_extract(host, '([^.]+\.(?:ac\.uk|co\.uk|gov\.uk|org\.uk|com\.au|net\.au|com\.br|co\.jp|co\.nz|com\.mx|[^.]+))$', 1) AS ending
  FROM cut LEFT JOIN known USING (page_id) GROUP BY host),
named AS (
  SELECT host, n, k, CASE WHEN ending = '' OR regexp_matches(host, '^[0-9.:]+$') THEN host ELSE ending END AS domain FROM hosts),
tree AS (SELECT *, regexp_extract(domain, '^[^.]+\.(.+)$', 1) AS suffix FROM named),
suffix_prior AS (
  SELECT suffix, sum(n) AS n, sum(k) AS k, (SELECT (sum(k) + 1) / (sum(n) + 2) FROM tree) AS prior FROM tree GROUP BY suffix),"""
    + _LEVEL.format(name="suffix")
    + """,
domain_prior AS (
  SELECT d.domain, d.n, d.k, s.mean AS prior
  FROM (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM tree GROUP BY ALL) d JOIN suffix_mean s USING (suffix)),"""
    + _LEVEL.format(name="domain")
    + """,
host_prior AS (SELECT t.host, t.n, t.k, d.mean AS prior FROM tree t JOIN domain_mean d USING (domain)),"""
    + _LEVEL.format(name="host")
    + """,
counts AS (
  SELECT host, n, k, mean, k + weight * prior AS a, n - k + weight * (1 - prior) AS b FROM host_mean),
judged AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN greatest(0, mean - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) > 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  CAST(n AS BIGINT) AS n_labels, CAST(k AS BIGINT) AS n_bad, round(mean, 9) AS bad_rate,
  round(greatest(0, mean - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))), 9) AS bad_bound
FROM judged JOIN counts USING (host)"""
)
def op1_url_reputation(spark, sf_dir):
    """Every page's url, judged by the stated rules and else by its host's reputation."""
    judged = judge_urls(table(spark, sf_dir, "pages"), page_outcomes(table(spark, sf_dir, "labels")))
    return judged.withColumns({c: F.round(c, 9) for c in ("bad_rate", "bad_bound")})
