"""URL filtering by empirical-Bayes host reputation (native DataFrame operations only).

A labelled page is a trial and a bad label a success. Success rates are shrunk down
a chain of beta-binomial priors: all pages -> public suffix -> registered domain ->
host. At each level the prior's mean is the posterior mean of the level above, and
its strength (pseudo-count) is estimated from the data of that level by the method
of moments. A host is blocked if the lower bound of its posterior exceeds a limit,
so little evidence never blocks. A host without labelled pages has its domain's posterior mean
as its own (else its suffix's, else the overall one) with no trials. Explicit rules go before reputation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, split_join, without

#: Suffixes of two labels under which names are registered: fixed values.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "gov.uk", "net.au", "org.au", "org.uk")
BLOCK_ABOVE = 0.5
Z = 1.645
WEAKEST, STRONGEST = 1.0, 1000.0
#: A host with more than this share of all pages is joined without moving them.
HOT_SHARE = 1 / 256
ADDED = ("host", "path", "rule", "verdict", "posterior_mean", "posterior_low", "labelled_pages")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to /, ?, # or end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """Registered domain: the public suffix and one label more; numeric addresses stay whole."""
    two = F.substring_index(host, ".", -2)
    named = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)
    return F.when(host.rlike(r"^[0-9.]+(:[0-9]+)?$"), host).otherwise(named)


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, action) of the longest fitting rule, nulls if none fits; ties go to the earlier rule."""
    hit, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, what in sorted(rules, key=lambda x: len(x[0])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        hit, action = F.when(fits, F.lit(rule)).otherwise(hit), F.when(fits, F.lit(what)).otherwise(action)
    return hit, action


def _posterior(level: DataFrame) -> DataFrame:
    """Add ``m``, the moment estimate of the prior strength over the groups of a level, and the posterior mean ``q``.

    For groups of n trials with rate y/n around prior mean p, a beta-binomial has
    E[(y - np)^2] = np(1-p) (1 + (n-1) rho) with rho = 1 / (m + 1); summed over groups
    this is solved for rho. Two sums a level reach the driver.
    """
    noise = F.col("n") * F.col("p") * (1 - F.col("p"))
    sums = level.agg(
        F.sum(F.pow(F.col("y") - F.col("n") * F.col("p"), 2) - noise).alias("extra"),
        F.sum(noise * (F.col("n") - 1)).alias("room"),
    ).first()
    rho = max(sums["extra"] / sums["room"], 1e-9) if sums["room"] else 1.0
    m = min(max(1 / rho - 1, WEAKEST), STRONGEST)
    return level.withColumn("m", F.lit(m)).withColumn("q", (F.col("p") * m + F.col("y")) / (m + F.col("n")))


def host_reputation(outcomes: DataFrame, z: float = Z, hosts_too: DataFrame | None = None) -> DataFrame:
    """Posterior of every labelled host, and of the other hosts of ``hosts_too(host)`` if given.

    ``outcomes(host, bad)`` holds one row per labelled page, ``bad`` 0 or 1. Returns
    ``host, labelled_pages, posterior_mean, posterior_low``; the bound is the mean less
    ``z`` posterior standard deviations. Rows with null bad do not count. Hosts that are not
    labelled get the prior of a new host, with 0 labelled pages; without any outcome none gets one.
    """
    hosts = (
        outcomes.filter(F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count("*").cast("double").alias("n"), F.sum("bad").cast("double").alias("y"))
        .select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "y")
    )
    hosts = materialise(hosts, "hosts")  # every level reads it
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    # Everything starts from a uniform Beta(1, 1) over the overall rate.
    overall = hosts.agg(F.coalesce(F.sum("y"), F.lit(0.0)).alias("y"), F.coalesce(F.sum("n"), F.lit(0.0)).alias("n")).first()
    rate = F.lit((overall["y"] + 1) / (overall["n"] + 2))
    by_suffix = _posterior(suffixes.withColumn("p", rate))
    by_suffix = by_suffix.select("suffix", F.col("q").alias("p"))
    by_domain = _posterior(domains.join(by_suffix, "suffix")).select("suffix", "domain", F.col("q").alias("p"))
    scored = _posterior(hosts.join(by_domain, ["suffix", "domain"]))
    if hosts_too is not None and overall["n"]:
        m = scored.select("m").first()["m"]
        new = hosts_too.select("host").distinct().join(hosts, "host", "left_anti")
        new = new.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
        new = new.join(by_domain.withColumnRenamed("p", "dp"), ["suffix", "domain"], "left")
        new = new.join(by_suffix.withColumnRenamed("p", "sp"), "suffix", "left")
        new = new.select("host", F.lit(0.0).alias("n"), F.coalesce("dp", "sp", rate).alias("q"), F.lit(m).alias("m"))
        scored = scored.select("host", "n", "q", "m").unionByName(new)
    spread = F.sqrt(F.col("q") * (1 - F.col("q")) / (F.col("m") + F.col("n") + 1))
    return scored.select(
        "host",
        F.col("n").cast("long").alias("labelled_pages"),
        F.col("q").alias("posterior_mean"),
        F.greatest(F.col("q") - z * spread, F.lit(0.0)).alias("posterior_low"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    url_col: str = "url",
    id_col: str = "page_id",
    block_above: float = BLOCK_ABOVE,
    z: float = Z,
) -> DataFrame:
    """All rows and columns of ``pages`` plus host, path, rule, verdict and the posterior.

    ``outcomes(id_col, bad)`` labels some pages (several labels of one page all count).
    Null or scheme-less urls have empty host and path; the empty host is
    allowed unless a rule fits, as nothing can be known of it. Hosts without
    labelled pages are judged by their domain, else their suffix, else all pages. Input columns with the names of added ones are replaced,
    except ``url_col``.
    """
    keep = [c for c in ADDED if c != url_col]
    judged = without(pages, *keep).withColumn("host", host_of(F.col(url_col))).withColumn("path", path_of(F.col(url_col)))
    labelled = judged.select(F.col(id_col), "host").filter("host <> ''").join(
        outcomes.select(F.col(id_col).alias("__tl_id"), "bad"), F.col(id_col) == F.col("__tl_id")
    )
    # Pages a host: the hosts to rate, and those few whose pages must not meet in one task.
    sizes = materialise(judged.groupBy("host").agg(F.count("*").alias("__tl_n")), "sizes")
    rated = host_reputation(labelled.select("host", "bad"), z, sizes.filter("host <> ''"))
    pages_in_all = sizes.agg(F.coalesce(F.sum("__tl_n"), F.lit(0))).first()[0]
    hot = sizes.filter(F.col("__tl_n") > pages_in_all * HOT_SHARE)
    rule, action = rule_columns(F.col("host"), F.col("path"), rules)
    out = split_join(judged, rated, "host", hot).select(*[F.col(f"`{c}`") for c in judged.columns], "labelled_pages", "posterior_mean", "posterior_low")
    blocked = F.coalesce(F.col("posterior_low") > block_above, F.lit(False))
    return out.withColumn("rule", rule).withColumn(
        "verdict", F.coalesce(action, F.when(blocked, F.lit("block")).otherwise(F.lit("allow")))
    )
