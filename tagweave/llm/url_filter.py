"""URL filter: rules by host and path first, else the reputation of the host by empirical Bayes.

Outcomes of pages (1 good, 0 bad) are summed by host, registered domain and suffix. A beta-binomial
prior runs down these levels: the rate of all pages shrinks that of a suffix, this that of a domain,
this that of a host. How strongly is estimated at each level from how far the children spread beyond
chance (method of moments). A page without a rule is blocked where even the upper bound of its
host's posterior is below ``LEAST_GOOD``.

Pages are joined once, to one row for each host, which holds its verdict and the rules that its
names can fit. That join has the form that adaptive execution splits when one host is large. Only
DataFrame functions are used; the driver gets one row of sums for each level.

Defined results: a null url, or one without ``://``, has an empty host and path, which form one host
of their own; a host without outcomes takes the prior of its domain; outcomes that are null, neither
0 nor 1, or of no page are left out; rows that repeat a page each give a row; of rules that fit, the
longest wins, and a rule given twice with two verdicts is an error; without pages the result is empty,
and without outcomes all hosts have the same reputation; further columns are not read.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import stage

LEAST_GOOD, WIDTH = 0.5, 1.645
#: Suffixes of two labels; all others have one.
LONG_SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")
LEVELS = ("suffix", "domain", "host")


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(url, pattern, 2)


def _labels_of(name: Column, n: int) -> Column:
    return F.substring_index(name, ".", -n)


def _named_levels(hosts: DataFrame) -> DataFrame:
    name = F.regexp_replace("host", "^.*@|:[0-9]*$", "")
    long = _labels_of(name, 2).isin(*LONG_SUFFIXES)
    suffix = F.when(long, _labels_of(name, 2)).otherwise(_labels_of(name, 1))
    domain = F.when(long, _labels_of(name, 3)).otherwise(_labels_of(name, 2))
    return hosts.select("*", suffix.alias("suffix"), domain.alias("domain"))


def _strength(children: DataFrame) -> float:
    """Pseudo-count of the prior: 1 / rho - 1, where rho is the children's excess spread."""
    chance = F.col("prior") * (1 - F.col("prior"))
    excess = F.pow(F.col("good") - F.col("n") * F.col("prior"), 2.0) - F.col("n") * chance
    sums = children.filter("n > 0").agg(F.sum(excess).alias("over"), F.sum(F.col("n") * (F.col("n") - 1) * chance).alias("room")).first()
    rho = sums["over"] / sums["room"] if sums["room"] else 0.0
    return 1 / min(max(rho, 0.001), 0.999) - 1


def host_reputation(outcomes: DataFrame, least_good: float = LEAST_GOOD, width: float = WIDTH) -> DataFrame:
    """host, mean and bound of its rate of good pages, and a verdict; ``outcomes`` has host and good.

    A row with a null ``good`` only says that there is such a host.
    """
    good = F.when(F.col("good").isin(0, 1), F.col("good").cast("long"))
    counted = outcomes.select("host", good.alias("good")).groupBy("host")
    counted = counted.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("n"))
    hosts = stage(_named_levels(counted), "hosts")
    total = hosts.agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    above, prior = None, F.lit((total["good"] + 1) / (total["n"] + 2))
    for level in LEVELS:
        # A domain lies in one suffix, and a host in one domain.
        keys = LEVELS[: LEVELS.index(level) + 1]
        rows = hosts.groupBy(*keys).agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
        rows = rows.withColumn("prior", prior) if above is None else rows.join(above, list(keys[:-1]))
        rows = stage(rows, level)
        strength = _strength(rows)
        weight = F.col("n") + strength
        mean = (F.col("good") + strength * F.col("prior")) / weight
        rows = rows.select(*keys, mean.alias("mean"), weight.alias("weight"))
        above = rows.select(*keys, F.col("mean").alias("prior"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    bound = F.col("mean") + width * spread
    verdict = F.when(bound < least_good, "block").otherwise("allow")
    return rows.select("host", "mean", bound.alias("bound"), verdict.alias("by_reputation"))


def _rules_of_hosts(hosts: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """For each host the rules of its names, the longest first."""
    if not rules:
        return hosts.select("host", F.lit(None).cast("array<struct<first:int,start:string,rule:string,verdict:string>>").alias("rules"))
    if len({rule for rule, _ in rules}) < len(set(rules)):
        raise ValueError("a rule has two verdicts")
    split = [(r[: r.index("/")], r[r.index("/") :], r, v) for r, v in sorted(set(rules))]
    columns = ("name", "start", "rule", "verdict")
    literals = F.array(*(F.struct(*(F.lit(x).alias(c) for c, x in zip(columns, row))) for row in split))
    table = hosts.sparkSession.range(1).select(F.inline(literals))
    parts = F.split("host", r"\.", -1)
    names = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    fitting = hosts.select("host", F.explode(names).alias("name")).join(table, "name").groupBy("host")
    order = F.struct((-F.length("rule")).alias("first"), "start", "rule", "verdict")
    return fitting.agg(F.sort_array(F.collect_list(order)).alias("rules"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], **options) -> DataFrame:
    """page_id, host, path, rule and verdict for each page; ``outcomes`` has page_id and good."""
    host, path = host_and_path(F.col("url"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    labelled = outcomes.select(F.col("page_id").alias("labelled_id"), "good")
    judged = pages.join(labelled, F.col("page_id") == F.col("labelled_id"), "left").select("host", "good")
    hosts = host_reputation(judged, **options)
    hosts = stage(hosts.join(_rules_of_hosts(hosts.select("host"), rules), "host", "left"), "verdicts")
    rule = F.get(F.filter("rules", lambda r: F.col("path").startswith(r["start"])), F.lit(0))
    found = pages.join(hosts, "host").withColumn("fit", rule)
    verdict = F.coalesce(F.col("fit.verdict"), F.col("by_reputation"))
    return found.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"))
