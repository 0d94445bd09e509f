"""URL filters: rules first, then a host's reputation by beta-binomial shrinkage. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from partysieve.sources.stages import StageArea

#: Second-level labels under which two-letter suffixes are registered (example.co.uk), unless a caller has a list of its own.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gob", "gov", "net", "org")
#: A host is blocked if its bad share exceeds LEVEL at this many standard deviations.
LEVEL, DEVIATIONS = 0.5, 1.645
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for a null or one without `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return (F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), _UPPER, _LOWER),
            F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; nulls if none does.

    A rule (verdict, host and path) fits its host and all its subdomains, if the path starts with the
    rule's. At equal length a block wins, then the lesser text.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", [-ord(c) for c in r[1]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def domain_of(host: Column, second_level: Sequence[str] = SECOND_LEVEL) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without its port; a numeric address is its own domain."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    last, second = F.element_at(labels, -1), F.when(n > 1, F.element_at(labels, -2))
    two = F.coalesce((F.length(last) == 2) & second.isin(*second_level) & (n > 2), F.lit(False))
    numeric = name.rlike(r"^[0-9.]+$")

    def tail(k: int) -> Column:
        return F.concat_ws(".", F.slice(labels, F.greatest(n - k + 1, F.lit(1)), F.lit(k)))

    return (F.when(numeric, name).when(two, tail(3)).otherwise(tail(2)),
            F.when(numeric, "").when(two, tail(2)).otherwise(last))


def concentration(groups: DataFrame) -> float:
    """Strength of the beta prior around `mean` that explains how n, bad vary, by moments."""
    spread = F.col("mean") * (1 - F.col("mean"))
    off = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), 2) / spread - 1
    row = groups.where("n > 0 AND mean > 0 AND mean < 1").agg(F.sum(off), F.sum(F.col("n") - 1)).first()
    share = (row[0] or 0.0) / row[1] if row[1] else 0.5
    return 1 / min(max(share, 0.02), 0.9) - 1


def reputation(outcomes: DataFrame, stages: StageArea | None = None, second_level: Sequence[str] = SECOND_LEVEL) -> DataFrame:
    """Per host: host, n, bad, mean, bound, from labelled outcomes.

    outcomes: host, and bad (1, 0 or null: not labelled); every host of them gets a row. The bad share of
    all labelled outcomes is the prior of the suffixes; a suffix's posterior mean is that of its domains,
    a domain's that of its hosts. Each level's prior strength comes from the data. A host
    without labels has its domain's mean, one of an unknown suffix the mean of all. bound is the
    posterior mean less DEVIATIONS standard deviations, which are wide where a level has few
    labels, as what is uncertain about a suffix or domain is passed on. Without any label the mean is 1/2.

    A hot host is summed on the map side. What is joined back to hosts or their rows is written first, so that Spark can split
    a domain with very many hosts, or a host with very many pages. Besides three strengths and the overall share, nothing reaches the driver.
    """
    stages = stages or StageArea(outcomes.sparkSession)
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    domain, suffix = domain_of(F.col("host"), second_level)
    hosts = stages.cut(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    share = (bad + 0.5) / (n + 1)
    suffixes = suffixes.withColumns({"mean": F.lit(share), "variance": F.lit(share * (1 - share) / (n + 2))})
    above = suffixes.select("suffix", *_posterior(suffixes))
    domains = domains.join(above, "suffix")
    above = stages.cut(domains.select("domain", *_posterior(domains)), "domains")
    hosts = hosts.join(above, "domain")
    judged = hosts.select("host", "n", "bad", *_posterior(hosts))
    bound = F.col("mean") - DEVIATIONS * F.sqrt("variance")
    return stages.cut(judged.select("host", "n", "bad", "mean", bound.alias("bound")), "reputation")


def _posterior(groups: DataFrame) -> tuple[Column, Column]:
    """Mean and variance of a level's shares; part of the variance above stays, by the prior's weight."""
    m = concentration(groups)
    total = F.col("n") + m
    mean = (F.col("mean") * m + F.col("bad")) / total
    return (mean.alias("mean"),
            (mean * (1 - mean) / (total + 1) + F.pow(m / total, 2) * F.col("variance")).alias("variance"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], page_id: str = "page_id", url: str = "url",
          labelled: DataFrame | None = None, stages: StageArea | None = None, second_level: Sequence[str] = SECOND_LEVEL) -> DataFrame:
    """Per page page_id, host, path, rule, verdict, and what is known of its host: mean_ppm, bound_ppm (millionths).

    The longest fitting rule decides. Other pages are allowed or blocked by their host's reputation,
    learned from the page outcomes in `labelled` (url, and bad: 1, 0 or null): blocked if the bound
    of the bad share is over LEVEL. Hosts without outcomes have their domain's or suffix's; without any
    outcome all such pages are allowed. A null url or one without `://` has an empty host and path, which is a
    host like any other. Rows with null or repeated ids are rows like any other; other columns
    are ignored, whatever their names. An empty table gives an empty one.
    """
    stages = stages or StageArea(pages.sparkSession)
    host, path = parts(F.col(url))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = (pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumns({"rule": rule, "verdict": verdict}))
    outcomes = rows.select("host", F.lit(None).cast("long").alias("bad"))
    if labelled is not None:
        outcomes = outcomes.unionByName(labelled.select(parts(F.col("url"))[0].alias("host"), F.col("bad").cast("long").alias("bad")))
    hosts = reputation(outcomes, stages, second_level)
    learned = F.when(F.col("bound") > LEVEL, "block").otherwise("allow")
    return rows.join(hosts.select("host", "mean", "bound"), "host").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", learned).alias("verdict"),
        F.round(F.col("mean") * 1_000_000).cast("long").alias("mean_ppm"), F.round(F.col("bound") * 1_000_000).cast("long").alias("bound_ppm"))
