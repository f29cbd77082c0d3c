"""Operator 12: URL filter by rules and, where none fits, by empirical-Bayes reputation of the host.

Labelled outcomes of pages (blocked or not) are counted per host.  A rate is shrunk along suffix, registered domain and
host: each level's prior is a beta distribution around the posterior mean of the level above, as strong as the spread
among that level's groups warrants (moments of the beta-binomial).  A page goes if even the lower bound of its host's
posterior lies above the limit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .hot_keys import lookup

#: (verdict, host and path), in the order they were given.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Labels of a registered domain, blocked share that a host may have, and confidence of the bound.
DOMAIN_LABELS, LIMIT, CONFIDENCE = 2, 0.5, 0.9
#: A prior counts as so many pages at least and at most.
WEAKEST, STRONGEST = 1.0, 1000.0
EXACT = "decimal(38,9)"


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without it."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule (struct of rule and verdict) that fits a host, or one above it, and the start of a path; null if none
    does.  Of equally long rules the one with the longer host counts, then the first."""
    order = sorted(rules, key=lambda r: (-len(r[1]), -r[1].index("/")))
    out = None
    for verdict, rule in order:
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        hit = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out


def domain_of(host: Column, labels: int = DOMAIN_LABELS) -> Column:
    return F.substring_index(host, ".", -labels)


def _level(groups: DataFrame) -> DataFrame:
    """``groups`` (pages, blocked, prior) with the posterior's ``alpha`` and ``beta``.  The prior's strength is one number for
    the level: with rho the correlation of two pages of a group, the blocked count of n pages varies around its mean by
    n m (1 - m) (1 + (n - 1) rho).  Sums are decimal, so that they do not depend on the order of the rows."""
    n, x, m = F.col("pages").cast("double"), F.col("blocked").cast("double"), F.col("prior")
    even = m * (F.lit(1.0) - m)
    seen, alone, pairs = groups.agg(
        F.sum(((x - n * m) * (x - n * m)).cast(EXACT)).cast("double"), F.sum((n * even).cast(EXACT)).cast("double"),
        F.sum((n * (n - F.lit(1.0)) * even).cast(EXACT)).cast("double")).first()
    rho = (seen - alone) / pairs if pairs else 0.0
    strength = min(max(1.0 / rho - 1.0, WEAKEST), STRONGEST) if rho > 0 else STRONGEST
    return (groups.withColumn("alpha", F.lit(strength) * m + x)
            .withColumn("beta", F.lit(strength) * (F.lit(1.0) - m) + (n - x)))


def _mean() -> Column:
    return F.col("alpha") / (F.col("alpha") + F.col("beta"))


def host_reputation(outcomes: DataFrame, hosts: DataFrame, domain_labels: int = DOMAIN_LABELS) -> DataFrame:
    """(host, alpha, beta) for every row of ``hosts`` (host, repeated or not): the posterior of the share of its pages
    that are to be blocked.

    ``outcomes``: host and ``blocked`` (boolean), one row per labelled page; rows with a null in either are left out.  A
    host without labelled pages has its domain's posterior mean as prior, and so on upwards; with no outcomes at all the
    mean is one half.  Empty tables give empty results."""
    labelled = outcomes.filter(F.col("host").isNotNull() & F.col("blocked").isNotNull())
    counts = (labelled.select("host", F.col("blocked").cast("long").alias("blocked"), F.lit(1).alias("pages"))
              .unionByName(hosts.filter(F.col("host").isNotNull()).select(
                  "host", F.lit(0).cast("long").alias("blocked"), F.lit(0).alias("pages")))
              .groupBy("host").agg(F.sum("pages").alias("pages"), F.sum("blocked").alias("blocked"))
              .withColumn("domain", domain_of(F.col("host"), domain_labels)))
    counts = stored(counts, "url-hosts")

    def rolled(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key).agg(F.sum("pages").alias("pages"), F.sum("blocked").alias("blocked"), F.count(F.lit(1)).alias("rows"))

    domains = stored(rolled(counts, "domain").withColumn("suffix", domain_of(F.col("domain"), 1)), "url-domains")
    suffixes = stored(rolled(domains, "suffix"), "url-suffixes")
    pages, blocked = suffixes.agg(F.sum("pages"), F.sum("blocked")).first()
    suffixes = _level(suffixes.withColumn("prior", F.lit((blocked + 1.0) / (pages + 2.0) if pages else 0.5)))
    domains = _level(stored(lookup(domains.select("domain", "suffix", "pages", "blocked", F.col("rows").alias("hosts")),
                                   suffixes.select("suffix", "rows", _mean().alias("prior")), "suffix", "rows"), "url-domains"))
    known = _level(stored(lookup(counts, domains.select("domain", "hosts", _mean().alias("prior")), "domain", "hosts"), "url-hosts"))
    return known.select("host", "alpha", "beta")


def lower_bound(alpha: Column, beta: Column, confidence: float = CONFIDENCE) -> Column:
    """A share that the posterior exceeds with at least ``confidence``, by the one-sided Chebyshev inequality."""
    total = alpha + beta
    spread = F.sqrt(alpha * beta / (total * total * (total + F.lit(1.0))))
    return alpha / total - F.lit((confidence / (1.0 - confidence)) ** 0.5) * spread


def judge_urls(pages: DataFrame, outcomes: DataFrame | None = None, rules=RULES, limit: float = LIMIT,
               confidence: float = CONFIDENCE, url_col: str = "url") -> DataFrame:
    """``pages`` with the new columns ``host``, ``path``, ``rule`` (null if none fits) and ``verdict`` (allow or block);
    input columns with these names are replaced.

    A page that a rule fits has the rule's verdict.  Any other goes if the lower bound of its host's posterior is above
    ``limit``.  ``outcomes`` (host, blocked) are the labelled pages; by default those that a rule has judged.  Null urls
    and urls without ``://`` have an empty host, which is a host like any other.  Repeated rows stay; an empty table gives
    an empty result."""
    old = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(F.struct(F.lit(0).alias("of"), *old).alias("row"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    if outcomes is None:
        outcomes = rows.filter("hit is not null").select("host", (F.col("hit.verdict") == "block").alias("blocked"))
    open_rows = rows.filter("hit is null")
    hosts = stored(open_rows.groupBy("host").agg(F.count(F.lit(1)).alias("open_pages")), "url-open-hosts")
    bound = lower_bound(F.col("alpha"), F.col("beta"), confidence)
    known = host_reputation(outcomes, hosts).select("host", F.when(bound > limit, "block").otherwise("allow").alias("verdict"))
    judged = lookup(open_rows, stored(hosts.join(known, "host"), "url-verdicts"), "host", "open_pages")
    columns = [*[F.col("row").getField(c).alias(c) for c in old], "host", "path"]
    return (rows.filter("hit is not null").select(*columns, "hit.rule", "hit.verdict")
            .unionByName(judged.select(*columns, F.lit(None).cast("string").alias("rule"), "verdict")))
