"""URL filter by empirical-Bayes host reputation (DataFrame functions only).

Labelled page outcomes (bad or good) are counted per host and shrunk through
beta-binomial priors along the host's own names: the suffix (last label) is
shrunk towards the global rate, the registered domain (last two labels)
towards its suffix, the host towards its domain. The strength of each prior is
estimated from how far the groups of that level scatter beyond binomial noise
(method of moments). A host is blocked when the lower bound of its posterior
rate of bad pages, ``mean - z * sd`` of the beta posterior, exceeds
``max_bad``; a host without labelled pages has its domain's posterior. Fixed
rules (a host with its subdomains, and a path prefix) go first, the longest
one wins.

Hosts are counted with map-side partial aggregates; verdicts come back over
joins on the host that Spark may split when a host is hot. The driver sees
three rates and strengths.

Edge cases: a null url or one without ``://`` has an empty host and path (the
empty host is a host like any other); null and repeated labels count once per
page by their smallest value; pages with null ids have no label; repeated
pages count each; without labels nothing is blocked; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Z, MAX_BAD = 1.645, 0.5
#: prior strengths lie between one page's worth and a very strong prior
LEAST_RHO, MOST_RHO = 1e-4, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    return F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), UPPER, LOWER), F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """Longest fitting rule and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, word).otherwise(verdict)
    return rule, verdict


def host_counts(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``host, domain, suffix, n, bad``; ``pages(page_id, host)``, ``outcomes(page_id, bad)``."""
    counts = (pages.join(outcomes, "page_id", "left").groupBy("host")
              .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")))
    numeric = F.col("host").rlike(r"^[0-9.:]*$")
    return counts.select(
        "host", F.when(numeric, F.col("host")).otherwise(F.substring_index("host", ".", -2)).alias("domain"),
        F.when(numeric, "").otherwise(F.substring_index("host", ".", -1)).alias("suffix"), "n", "bad")


def prior_strength(groups: DataFrame) -> float:
    """Beta strength for groups ``(n, bad, parent)`` around their parent's rate, by moments."""
    p = F.col("parent")
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * (F.col("bad") / F.col("n") - p) ** 2 / (p * (1 - p))).alias("s"),
        F.count("*").cast("double").alias("k"), F.sum("n").cast("double").alias("total"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares")).head()
    if not row["k"] or row["k"] < 2:
        rho = MOST_RHO
    else:
        room = row["total"] - row["squares"] / row["total"] - (row["k"] - 1)
        rho = (row["s"] - (row["k"] - 1)) / room if room > 0 else MOST_RHO
    rho = min(MOST_RHO, max(LEAST_RHO, rho))
    return 1 / rho - 1


def _shrunk(groups: DataFrame, name: str) -> DataFrame:
    m = prior_strength(groups)
    return groups.withColumn(name, (F.col("bad") + m * F.col("parent")) / (F.col("n") + m))


def reputations(counts: DataFrame, z: float = Z, max_bad: float = MAX_BAD) -> DataFrame:
    """``host, n, bad, posterior, bound, verdict``."""
    counts = cut_lineage(counts, "host-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).head()
    rate = ((total["bad"] or 0) + 0.5) / ((total["n"] or 0) + 1)
    suffixes = counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("parent", F.lit(float(rate)))
    suffixes = _shrunk(suffixes, "suffix_rate").select("suffix", "suffix_rate")
    domains = counts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = _shrunk(domains.join(suffixes, "suffix").withColumnRenamed("suffix_rate", "parent"), "domain_rate")
    domains = cut_lineage(domains.select("domain", "domain_rate"), "domain-rates")
    hosts = counts.join(domains, "domain").withColumnRenamed("domain_rate", "parent")
    m = prior_strength(hosts)
    a, b = F.col("bad") + m * F.col("parent"), F.col("n") - F.col("bad") + m * (1 - F.col("parent"))
    hosts = hosts.withColumn("posterior", a / (a + b)).withColumn("bound", F.col("posterior") - z * F.sqrt(a * b / ((a + b) ** 2 * (a + b + 1))))
    verdict = F.when((F.lit((total["n"] or 0) > 0)) & (F.col("bound") > max_bad), "block").otherwise("allow")
    return hosts.select("host", "n", "bad", "posterior", "bound", verdict.alias("verdict"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = (), z: float = Z,
                max_bad: float = MAX_BAD) -> DataFrame:
    """``page_id, host, path, rule, verdict, posterior, bound`` of every page; ``outcomes(page_id, bad)``, bad 0 or 1."""
    host, path = host_and_path(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path"))
    marks = outcomes.where("page_id is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = reputations(host_counts(seen.select("page_id", "host"), marks), z, max_bad).withColumnRenamed("verdict", "learned")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return seen.join(known, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("learned")).alias("verdict"), "posterior", "bound")
