"""URL filters: allow and block rules first, then empirical-Bayes host reputation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandweave.llm.common import ascii_lower, cut, stored

#: Verdict, host, start of the path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Public suffixes are the last label, or the last two if they are one of these before a country's.
SECOND_LEVEL = "ac|co|com|edu|gob|gouv|gov|mil|ne|net|nom|or|org|sch"
#: A page is blocked if its host's rate of bad pages is above MAX_BAD with a posterior probability of SURE, which is to
#: say if the beta posterior's quantile of 1 - SURE is above MAX_BAD.
MAX_BAD = 0.5
SURE = 0.9
#: Bounds of a prior's strength, in pages.
STRENGTH = (1.0, 1000.0)
#: The suffix of hosts that are addresses.
ADDRESS = "address"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else null; of equally long ones that with the longer host."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def domain_of(host: Column) -> Column:
    """The registered domain: the public suffix and one label more, without user and port; an address is its own."""
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(:[0-9]*|\.)$", "")
    many = F.substring_index(name, ".", -2).rlike(rf"^({SECOND_LEVEL})\.[a-z]{{2}}$")
    domain = F.when(many, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return F.when(is_address(name), name).otherwise(domain)


def is_address(name: Column) -> Column:
    return name.rlike(r"^[0-9.]*[0-9]$|^\[")


def suffix_of(domain: Column) -> Column:
    return F.when(is_address(domain), ADDRESS).when(domain.contains("."), F.regexp_replace(domain, r"^[^.]*\.", "")).otherwise(domain)


def _log_gamma(z: Column) -> Column:
    """By Stirling's series ten steps up, from where it is good to 13 digits."""
    y, down = z + 10, F.lit(0.0)
    for k in range(10):
        down = down + F.log(z + k)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - down


def _tail(a: Column, b: Column, x: Column) -> Column:
    """The incomplete beta function I_x(a, b) for x below (a + 1) / (a + b + 2), by its continued fraction.

    The number of terms grows with the root of a + b, which is what it needs.
    """
    start = F.struct(F.lit(1e300).alias("c"), F.lit(1.0).alias("d"), F.lit(1.0).alias("h"))

    def term(k: Column) -> Column:
        m = F.floor(k / 2)
        return F.when(k % 2 == 0, m * (b - m)).otherwise(-(a + m) * (a + b + m)) * x / ((a + k - 1) * (a + k))

    def step(at: Column, e: Column) -> Column:
        c, d = 1 + e / at["c"], 1 / (1 + e * at["d"])
        return F.struct(c.alias("c"), d.alias("d"), (at["h"] * c * d).alias("h"))

    terms = F.transform(F.sequence(F.lit(1), (100 + 3 * F.sqrt(a + b)).cast("int")), term)
    front = F.exp(a * F.log(x) + b * F.log(1 - x) - _log_gamma(a) - _log_gamma(b) + _log_gamma(a + b)) / a
    return front * F.aggregate(terms, start, step)["h"]


def above(limit: float, a: Column, b: Column) -> Column:
    """The probability that a rate with the posterior Beta(a, b) is above ``limit``."""
    x = F.lit(float(limit))
    return F.when(x < (a + 1) / (a + b + 2), 1 - _tail(a, b, x)).otherwise(_tail(b, a, 1 - x))


def _strength() -> Column:
    """A beta prior's strength by the method of moments, over groups with n outcomes of which bad are bad."""
    n, bad, groups = F.sum("n"), F.sum("bad"), F.count(F.when(F.col("n") > 0, 1))
    m = bad / n
    spread = F.sum(F.when(F.col("n") > 0, F.col("bad") * F.col("bad") / F.col("n"))) / n - m * m
    between = spread - m * (1 - m) * groups / n
    fitted = F.when((n > 0) & (between > 1e-9), m * (1 - m) / between - 1).otherwise(STRENGTH[1])
    return F.coalesce(F.least(F.greatest(fitted, F.lit(STRENGTH[0])), F.lit(STRENGTH[1])), F.lit(STRENGTH[1]))


def reputation(pages: DataFrame, outcomes: DataFrame, max_bad: float = MAX_BAD) -> DataFrame:
    """One row per host of ``pages`` (page_id, url): host, n, bad, bad_rate, p_bad.

    ``outcomes`` (page_id, bad) labels some pages; a page with several labels
    is bad if one says so; labels with nulls count for nothing.  Hosts draw
    their prior from the registered domain, domains from the suffix, suffixes
    from all pages.  ``p_bad`` is the posterior probability that the host's
    rate is above ``max_bad``.  Without any label the rate is 0.5.
    """
    labels = (
        outcomes.where("page_id is not null and bad is not null")
        .groupBy(F.col("page_id").alias("labelled"))
        .agg(F.max(F.col("bad").cast("int")).alias("bad"))
    )
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"))
    hosts = cut(
        seen.join(labels, F.col("page_id") == F.col("labelled"), "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .withColumn("domain", domain_of(F.col("host")))
        .withColumn("suffix", suffix_of(F.col("domain")))
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = cut(hosts.groupBy("domain", "suffix").agg(*sums))
    suffixes = cut(domains.groupBy("suffix").agg(*sums))
    every = (F.coalesce(F.sum("bad"), F.lit(0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)
    of_suffix, overall = (F.lit(float(x)) for x in suffixes.agg(_strength(), every).first())  # one row
    of_host, of_domain = (F.lit(float(x.agg(_strength()).first()[0])) for x in (hosts, domains))

    def shrunk(prior: Column, strength: Column) -> Column:
        return (F.col("bad") + strength * prior) / (F.col("n") + strength)

    suffixes = suffixes.select("suffix", shrunk(overall, of_suffix).alias("suffix_rate"))
    domains = domains.join(suffixes, "suffix").select(
        "domain", shrunk(F.col("suffix_rate"), of_domain).alias("domain_rate")
    )
    a = F.col("bad") + of_host * F.col("domain_rate")
    b = F.col("n") - F.col("bad") + of_host * (1 - F.col("domain_rate"))
    return hosts.join(domains, "domain").select(
        "host", "n", "bad", F.round(shrunk(F.col("domain_rate"), of_host), 6).alias("bad_rate"), F.round(above(max_bad, a, b), 6).alias("p_bad")
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, max_bad: float = MAX_BAD, sure: float = SURE) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, bad_rate, p_bad.

    A null url or one without ``://`` has an empty host and path, and shares
    the reputation of all such pages.  Repeated rows are judged alike, and a
    page's label counts for each of its rows.  Without pages there is no row.
    Other columns of ``pages`` and ``outcomes``, whatever their names, stay out.
    """
    # written first, so that a host of many pages can be split in the join
    known = stored(reputation(pages, outcomes, max_bad).select(F.col("host").alias("known"), "bad_rate", "p_bad"), "hosts")
    rule, verdict = by_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("p_bad") > sure, "block").otherwise("allow")
    return (
        pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .join(known, F.col("host") == F.col("known"), "left")
        .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_method).alias("verdict"), "bad_rate", "p_bad")
    )


def outcomes_of(labels: DataFrame) -> DataFrame:
    """Outcomes from ``labels``, whose ids are taken for page ids: bad if toxic or of low quality."""
    return labels.select(
        F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")
    )
