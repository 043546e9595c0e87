"""Host reputation by empirical Bayes, and url rules.

Labelled page outcomes are counted by host, registered domain and public suffix.
At each level the counts are beta-binomial: the prior is centred on the posterior
mean of the level above and its weight comes from the spread of the level's own
rates (the moment estimate of their intra-class correlation). A host passes if
the lower posterior bound of its rate of good pages reaches a threshold."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Suffixes of more than one label under which domains are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
#: Lower posterior bound: so many standard deviations below the posterior mean.
DEVIATIONS = 1.645
#: Least rate of good pages, at that bound.
LEAST_GOOD = 0.5
#: The correlation estimate stays inside these, so that prior weights stay finite.
LEAST_RHO, MOST_RHO = 0.001, 0.999

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, URL, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(url, URL, 2)


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """Public suffix and registered domain of a host (its port left aside)."""
    name = F.regexp_replace(host, r":\d*$", "")
    last_two = F.substring_index(name, ".", -2)
    long = last_two.isin(*LONG_SUFFIXES)
    return (F.when(long, last_two).otherwise(F.substring_index(name, ".", -1)),
            F.when(long, F.substring_index(name, ".", -3)).otherwise(last_two))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits; null where none does.
    ``rules`` is a short list of (verdict, host/path)."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, _, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _shrunk(children: DataFrame, mean: str, centre: str) -> DataFrame:
    """``children`` (k good of n, the parent's mean in ``centre``) with the prior
    weight of the level as ``weight`` and the posterior mean as ``mean``."""
    c, spread = F.col(centre), F.col(centre) * (1 - F.col(centre))
    level = children.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - c, 2)).alias("s"),
        F.sum(spread).alias("one"), F.sum((F.col("n") - 1) * spread).alias("more")).select(
        F.coalesce(F.least(F.lit(MOST_RHO), F.greatest(F.lit(LEAST_RHO), F.when(
            F.col("more") > 0, (F.col("s") - F.col("one")) / F.col("more")))), F.lit(LEAST_RHO)).alias("rho"))
    out = children.withColumn("weight", level.select((1 - F.col("rho")) / F.col("rho")).scalar())  # one number
    return out.withColumn(mean, (F.col("k") + F.col("weight") * c) / (F.col("n") + F.col("weight")))


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of each host in ``outcomes`` (``host``, ``good`` 0, 1 or null; one
    row per page): ``host``, ``n``, ``mean`` and the lower ``bound``. Every host
    gets a row; one without labelled pages has its domain's prior."""
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = hosts.withColumn("suffix", suffix).withColumn("domain", domain)
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    whole = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("m0"))
    suffixes = _shrunk(suffixes.withColumn("m0", whole.scalar()), "m1", "m0").select("suffix", "m1")
    domains = _shrunk(domains.join(suffixes, "suffix"), "m2", "m1").select("suffix", "domain", "m2")
    hosts = _shrunk(hosts.join(domains, ["suffix", "domain"]), "mean", "m2")
    size = F.col("n") + F.col("weight")
    return hosts.select("host", "n", "mean", (
        F.col("mean") - DEVIATIONS * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (size + 1))).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], least: float = LEAST_GOOD) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and the host's ``mean``
    and ``bound`` for every row of ``pages``.

    The outcome of a page is the ``quality`` label (0 or 1) with its id; null and
    other labels are left out, of repeated ones the lowest counts. Pages without a
    url or without ``://`` share the empty host. Null ids have no outcome; repeated
    rows each count. A rule's verdict beats the host's. Empty tables give no rows,
    or every host the same prior; other columns are not read."""
    prepare(pages.sparkSession)
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    marks = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy(
        F.col("doc_id").cast("long").alias("page_id")).agg(F.min("quality").cast("long").alias("good"))
    known = reputation(rows.select("page_id", "host").join(marks, "page_id", "left").select("host", "good"))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    return rows.join(known, "host").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bound") >= least, "allow").otherwise("block")).alias("verdict"), "mean", "bound")
