"""URL filter: rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes (1: good) are counted by host, registered domain and suffix. Each level's rate is shrunk
through a beta-binomial prior towards the level above: a suffix towards the rate of all labelled pages, a registered
domain towards its suffix, a host towards its domain. A level's prior weight (pages that the prior is worth) is
estimated once from the spread of its observed rates by the method of moments. A page is allowed if the lower bound
of its host's posterior rate, mean - Z standard deviations, reaches MIN_GOOD.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from swathbook.llm.shared import write_table

#: Standard deviations below the posterior mean.
Z = 1.645
#: Smallest lower bound of the share of good pages.
MIN_GOOD = 0.5
#: Range of a prior's weight; the largest stands for levels whose rates differ no more than chance.
WEIGHTS = (1.0, 1000.0)
# Second-level labels below which names are registered, as in co.uk
SECOND_LEVEL = ["ac", "co", "com", "edu", "gov", "net", "org"]

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    """Last label, with the one before it for suffixes such as co.uk."""
    labels = F.split(host, r"\.")
    last, second = F.element_at(labels, -1), F.try_element_at(labels, F.lit(-2))
    two = (F.size(labels) > 2) & (F.length(last) == 2) & second.isin(SECOND_LEVEL)
    return F.when(two, F.concat_ws(".", second, last)).otherwise(last)


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    more = F.size(F.split(suffix_of(host), r"\.")) + 1
    return F.when(F.size(F.split(host, r"\.")) >= more, _last(host, more)).otherwise(host)


def _last(host: Column, n: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n), ".")


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Longest rule (host and path, as text) that fits and its verdict, else null.

    ``rules`` are (host, path, verdict), at most some thousands. A rule fits its host and all subdomains if the path
    starts with the rule's.
    """
    name = verdict = None
    for rule_host, rule_path, result in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path) if name is None else name.when(fits, rule_host + rule_path)
        verdict = F.when(fits, result) if verdict is None else verdict.when(fits, result)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def _moments(counts: DataFrame, parent: str) -> Column:
    """Prior weight k of a level: the excess of the squared deviations from the parent's rate over binomial chance.

    With n pages and parent rate m, E[(x / n - m) ** 2] = m (1 - m) (1 / n + (1 - 1 / n) / (k + 1)).
    """
    n, spread = F.col("n").cast("double"), F.col(parent) * (1 - F.col(parent))
    seen = F.sum(n * (F.col("good") / n - F.col(parent)) * (F.col("good") / n - F.col(parent)))
    chance, more = F.sum(spread), F.sum(spread * (n - 1))
    share = (seen - chance) / F.when(more > 0, more)
    low, high = WEIGHTS
    weight = F.least(F.greatest(1 / F.when(share > 0, share) - 1, F.lit(low)), F.lit(high))
    return F.coalesce(weight, F.lit(high)).alias("weight")


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of every labelled host: host, domain, suffix, n, good, rate, low, from rows (host, outcome 0/1).

    ``suffix_rate`` and ``domain_rate`` are the rates a host without own labels falls back on. Rows with a null or empty
    host or a null outcome do not count. Counts are aggregated before any join: each level is one row per name.
    """
    used = outcomes.where("host <> '' and outcome is not null")
    hosts = used.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("outcome").cast("long")).alias("good"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    whole = suffixes.agg((F.sum("good") / F.sum("n")).alias("all_rate"))

    def shrunk(level: DataFrame, parent: str, rate: str) -> DataFrame:
        weight = level.agg(_moments(level, parent))
        mean = (F.col("good") + F.col("weight") * F.col(parent)) / (F.col("n") + F.col("weight"))
        return level.join(F.broadcast(weight), how="inner").withColumn(rate, mean)

    suffixes = shrunk(suffixes.join(F.broadcast(whole), how="inner"), "all_rate", "suffix_rate").select("suffix", "suffix_rate", "all_rate")
    domains = shrunk(domains.join(suffixes, "suffix"), "suffix_rate", "domain_rate").select("domain", "suffix_rate", "domain_rate")
    hosts = shrunk(hosts.join(domains, "domain"), "domain_rate", "rate")
    total = F.col("n") + F.col("weight")
    low = F.col("rate") - Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1))
    return hosts.withColumn("low", low).select("host", "domain", "suffix", "n", "good", "suffix_rate", "domain_rate", "weight", "rate", "low")


def judge_urls(pages: DataFrame, labels: DataFrame, rules: list[Rule], id: str = "page_id", url: str = "url", label_id: str = "doc_id", outcome: str = "outcome", min_good: float = MIN_GOOD) -> DataFrame:
    """One row for each page: id, host, path, rule, verdict (allow or block), rate, low.

    ``labels`` has outcomes (0/1) of some pages. A host without labelled pages takes the rate of its domain, else of
    its suffix, else of all pages, with the bound of a prior that has seen nothing more. rate and low are null where no
    page at all is labelled; such pages are allowed. Null urls and urls without ``://`` have an empty host and path, no
    rule, and the rate of all pages. A label whose id is null or unknown does not count; a page with several labels,
    and a repeated page, counts each time. An empty table gives no rows. Other columns are not read.
    """
    keyed = pages.select(F.col(id).alias("id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    marks = labels.select(F.col(label_id).alias("id"), F.col(outcome).alias("outcome")).where("id is not null and outcome is not null")
    known = write_table(reputation(keyed.select("id", "host").join(marks, "id")), "reputation")  # read four times below
    levels = _fallbacks(known)
    hosts = keyed.select("host").distinct().withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    own = known.select("host", F.col("rate").alias("own_rate"), F.col("weight").alias("own_weight"), "n")
    domain = known.groupBy("domain").agg(F.min("domain_rate").alias("domain_rate"))
    suffix = known.groupBy("suffix").agg(F.min("suffix_rate").alias("suffix_rate"))
    hosts = write_table(hosts, "hosts")
    judged = hosts.join(own, "host", "left").join(domain, "domain", "left").join(suffix, "suffix", "left").join(F.broadcast(levels), how="inner")
    rate = F.coalesce("own_rate", "domain_rate", "suffix_rate", "all_rate")
    total = F.coalesce("n", F.lit(0)) + F.coalesce("own_weight", "host_weight")
    judged = judged.withColumn("rate", rate).withColumn("low", F.col("rate") - Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (total + 1)))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    fallback = F.when(F.col("low") < min_good, "block").otherwise("allow")
    return keyed.join(judged.select("host", "rate", "low"), "host").select(
        F.col("id").alias(id), "host", "path", rule.alias("rule"), F.coalesce(verdict, fallback).alias("verdict"), "rate", "low"
    )


def _fallbacks(known: DataFrame) -> DataFrame:
    """One row: rate of all labelled pages, and the weight of a host's prior."""
    return known.agg((F.sum("good") / F.sum("n")).alias("all_rate"), F.coalesce(F.max("weight"), F.lit(WEIGHTS[1])).alias("host_weight"))
