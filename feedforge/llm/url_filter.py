"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (1 good, 0 bad) are counted per host, registered domain
and suffix. Every level is a beta-binomial whose prior is the posterior mean of
the level above: suffix -> registered domain -> host. The strength of the prior
of a level is estimated by moments over all its groups. A host is blocked if the
upper bound of its posterior good rate, mean + z standard deviations, is below
``least_good``: the evidence must be strong enough. Rules, if given, come first.

Only built-in functions. Counts are aggregated before every shuffle, joins of
pages with hosts are equality joins that adaptive execution can split.

Defined results: a url that is null or has no ``://`` has empty host and path; an
empty host is judged like any other host, by the pages that share it. Hosts
without labelled pages have the reputation of their registered domain, suffix,
or of all pages; without any labels every page is allowed. Repeated pages are
judged each, and their outcomes count each. Pages with a null id are judged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_RULES = 200
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    part = lambda i: F.coalesce(F.regexp_extract(url, PARTS, i), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


GENERIC = ("ac", "co", "com", "edu", "gov", "net", "org")


def suffix_labels(host: Column) -> Column:
    """Labels of the public suffix: 2 for generic names below a country, else 1."""
    two = F.length(F.substring_index(host, ".", -1)) == 2
    second = F.element_at(F.split(F.substring_index(host, ".", -2), r"\."), 1)
    return F.when(two & second.isin(*GENERIC), 2).otherwise(1)


def suffix(host: Column) -> Column:
    return F.when(suffix_labels(host) == 2, F.substring_index(host, ".", -2)).otherwise(
        F.substring_index(host, ".", -1))


def registered_domain(host: Column) -> Column:
    """The suffix and the label before it."""
    return F.when(suffix_labels(host) == 2, F.substring_index(host, ".", -3)).otherwise(
        F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; null where none fits.

    Rules are literals of the plan, so there may be MAX_RULES of them.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    name = verdict = F.lit(None).cast("string")
    for where, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(start)
        name = F.when(fits, F.lit(where + start)).otherwise(name)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def _strength(groups: DataFrame, prior: str) -> float:
    """Pseudo-counts of the prior of a level, by moments over all its groups.

    For beta-binomial groups of n_i trials with k_i good ones and prior mean m_i:
    E (k_i - n_i m_i)^2 = n_i m_i (1 - m_i) (1 + (n_i - 1) rho), and the strength
    is 1 / rho - 1. rho is kept within 1/1001 and 1/2.
    """
    n, k, m = F.col("n"), F.col("k"), F.col(prior)
    spread = n * m * (1 - m)
    above, below = groups.agg(F.sum(F.pow(k - n * m, F.lit(2.0)) - spread),
                              F.sum(spread * (n - 1))).first()
    rho = above / below if below else 0.5
    return 1 / min(0.5, max(1 / 1001, rho)) - 1


def _level(groups: DataFrame, prior: str, out: str) -> DataFrame:
    """Posterior mean and evidence (trials and pseudo-counts) of every group."""
    strength = _strength(groups, prior)
    return groups.withColumn(out, (F.col("k") + strength * F.col(prior)) / (F.col("n") + strength)
                             ).withColumn("evidence", F.col("n") + strength)


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """(host, mean, sd) of the posterior good rate of hosts.

    ``outcomes`` has a row per page: host, and good (1, 0 or null).
    """
    name = F.col("host")
    hosts = stored(outcomes.groupBy("host")
                   .agg(F.count("good").cast("double").alias("n"),
                        F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"))
                   .withColumn("domain", registered_domain(name)).withColumn("suffix", suffix(name)),
                   "host-outcomes")
    counts = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*counts)
    suffixes = domains.groupBy("suffix").agg(*counts)
    n, k = hosts.agg(*counts).first()
    suffixes = _level(suffixes.withColumn("prior", F.lit(((k or 0) + 1) / ((n or 0) + 2))), "prior", "suffix_mean")
    domains = _level(domains.join(suffixes.select("suffix", "suffix_mean"), "suffix"), "suffix_mean", "domain_mean")
    hosts = _level(hosts.join(domains.select("domain", "domain_mean"), "domain"), "domain_mean", "mean")
    mean = F.col("mean")
    return hosts.select("host", "mean", F.sqrt(mean * (1 - mean) / (F.col("evidence") + 1)).alias("sd"))


def judge_urls(pages: DataFrame, outcomes: DataFrame | None = None, rules=RULES,
               least_good: float = 0.5, z: float = 1.645) -> DataFrame:
    """(page_id, host, path, rule, verdict, good_rate) of every page.

    ``outcomes``: (page_id, good) for some pages; ids may repeat or be null.
    """
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    if outcomes is None:
        seen = parsed.select("host", F.lit(None).cast("int").alias("good"))
    else:
        known = (outcomes.where(F.col("good").isin(0, 1) & F.col("page_id").isNotNull())
                 .groupBy("page_id").agg(F.min("good").alias("good"), F.max("good").alias("most"))
                 .where("good = most").select("page_id", "good"))
        seen = parsed.join(known, "page_id", "left").select("host", "good")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    upper = F.col("mean") + z * F.col("sd")
    judged = parsed.join(host_reputation(seen), "host", "left")
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(upper < least_good, "block").otherwise("allow")).alias("verdict"),
        F.col("mean").alias("good_rate"))


def outcomes_by_number(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, good): the label of the document whose number ends a page's path.

    A page is good if its document has quality 1 and is not toxic.
    """
    _, path = url_parts(F.col("url"))
    numbered = pages.select("page_id", F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1).alias("n"))
    numbered = numbered.where("n <> ''").select("page_id", F.col("n").cast("long").alias("doc_id"))
    good = F.when(F.col("quality").isNotNull() & F.col("toxic").isNotNull(),
                  ((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int"))
    marks = labels.where("doc_id is not null").select("doc_id", good.alias("good"))
    return numbered.join(marks, "doc_id").select("page_id", "good")
