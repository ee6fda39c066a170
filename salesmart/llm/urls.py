"""Host reputation by empirical Bayes, under fixed rules for hosts and paths.

Counts of good and bad page outcomes are added up by host, registered domain and suffix. Each level's rates are shrunk
towards the level above: the prior of a group is a beta distribution around its parent's posterior mean, whose strength
comes from the overdispersion that the groups of the level show (method of moments for beta-binomial counts). A host
is blocked where even the upper bound of its posterior is low.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.llm.storage import written
from salesmart.operators.joins import splittable_join

#: Posterior bound: mean plus so many standard deviations; hosts with a bound under ``LEAST_GOOD`` are blocked.
DEVIATIONS, LEAST_GOOD = 2.0, 0.5
#: Suffixes of more than one label; all others are the last label.
LONG_SUFFIXES = ("co.uk", "com.au", "co.jp", "com.br")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL without one. A rule is (verdict, host and path)."""
    rule = verdict = None
    for said, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        at, slash, start = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + start)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, said) if verdict is None else verdict.when(fits, said)
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def suffix_of(host: Column) -> Column:
    bare = F.regexp_replace(host, r":[0-9]*$", "")
    long = F.array_join(F.slice(F.split(bare, r"\."), -2, 2), ".")
    return F.when((F.size(F.split(bare, r"\.")) > 1) & long.isin(*LONG_SUFFIXES), long).otherwise(F.element_at(F.split(bare, r"\."), -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it; the host itself where there is none."""
    labels = F.split(F.regexp_replace(host, r":[0-9]*$", ""), r"\.")
    n = F.least(F.size(labels), F.size(F.split(suffix, r"\.")) + 1)
    return F.array_join(F.slice(labels, F.size(labels) - n + 1, n), ".")


def _strength(groups: DataFrame, mean: str) -> float:
    """Weight of a prior, as a number of outcomes: small where groups differ from ``mean`` more than chance has them."""
    spread = F.col(mean) * (1 - F.col(mean))
    row = groups.agg(
        F.sum(F.pow(F.col("good") - F.col("n") * F.col(mean), 2)).alias("seen"), F.sum(F.col("n") * spread).alias("chance"),
        F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("pairs")).first()
    if not row.pairs:
        return 1.0
    share = min(max((row.seen - row.chance) / row.pairs, 1e-4), 0.999)
    return 1 / share - 1


def reputations(outcomes: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """``outcomes`` has ``host`` and ``good`` (1, 0 or NULL where a page has no label), a row per page.

    Returns per host: ``n`` labelled pages, posterior ``mean``, its upper ``bound``. Pages are counted before the
    shuffle, so a host with most of the pages costs one row a task.
    """
    hosts = outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"))
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    hosts = written(hosts, "hosts")
    domains = written(hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good")), "domains")
    total = domains.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = ((total.good or 0) + 1) / ((total.n or 0) + 2)

    def shrunk(groups: DataFrame, mean: str, to: str) -> DataFrame:
        weight = _strength(groups, mean)
        return groups.withColumn("weight", F.lit(weight)).withColumn(to, (F.col("good") + weight * F.col(mean)) / (F.col("n") + weight))

    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("parent", F.lit(overall))
    suffixes = shrunk(suffixes, "parent", "mean").select("suffix", F.col("mean").alias("parent"))
    domains = shrunk(splittable_join(domains, suffixes, ["suffix"], "inner"), "parent", "mean").select("suffix", "domain", F.col("mean").alias("parent"))
    hosts = shrunk(splittable_join(hosts, domains, ["suffix", "domain"], "inner"), "parent", "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("weight") + 1))
    return hosts.select("host", "n", "mean", (F.col("mean") + deviations * deviation).alias("bound"))


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], *, id_column: str = "page_id", url_column: str = "url", good_column: str = "good",
               least_good: float = LEAST_GOOD, deviations: float = DEVIATIONS) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, and the host's ``n``, ``mean`` and ``bound``.

    ``pages`` has the labelled outcome in ``good_column`` (1, 0 or NULL). A url that is NULL or has no ``://`` has an
    empty host and path; all of these share one reputation, as a host does. Rules go before reputations. Rows that
    repeat are judged, and counted, one by one. Other columns are dropped.
    """
    rows = pages.select(F.col(id_column).alias("id"), host_of(F.col(url_column)).alias("host"), path_of(F.col(url_column)).alias("path"), F.col(good_column).alias("good"))
    known = reputations(rows.select("host", "good"), deviations)
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    judged = splittable_join(rows.drop("good"), known, ["host"], "inner")
    own = F.when(F.col("bound") < least_good, "block").otherwise("allow")
    return judged.select(F.col("id").alias(id_column), "host", "path", rule.alias("rule"), F.coalesce(said, own).alias("verdict"), "n", "mean", "bound")
