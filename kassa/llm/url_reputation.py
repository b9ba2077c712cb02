"""Operator 4: URL filter by rules and empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted for each host, its registered
domain, its suffix, and over all. Each level shrinks to the one above it by a
beta-binomial prior: the prior's mean is the posterior mean of the level above
and its strength is fitted to how much the groups of that level differ (the
intra-class correlation of the outcomes). A host is blocked when the lower
bound of its bad rate's posterior is above the limit: few outcomes shrink to
the domain and never block alone.

All aggregates combine map-side; page rows meet only the table of blocked
hosts, so a host with a third of all pages is no hot key of an aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kassa.llm.common import fresh, stash

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# --- fixed values: the rules (verdict, host, path) ----------------------------
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# --- fixed values: public suffixes of two labels that are kept together -------
TWO_LABEL_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "com.cn"]
Z = 1.645           # one-sided 95 %
MAX_BAD = 0.5       # block when the bad rate is above this with that certainty


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and the label before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null.

    Among rules of equal length the longer host wins, then ``block``.
    """
    best = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("len"), F.lit(len(h)).alias("h"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
            for v, h, p in rules]
    return F.greatest(*best) if len(best) > 1 else best[0]


def strength(groups: DataFrame) -> DataFrame:
    """One row ``k``: prior strength of groups (n, s), by the ANOVA estimate of their correlation."""
    t = groups.agg(F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum("s").alias("s"),
                   F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss"), F.sum((F.col("n") * F.col("n")).cast("double")).alias("nn"))
    between = "(ss - s * s / n) / (g - 1)"
    within = "(s - ss) / (n - g)"
    each = "((n - nn / n) / (g - 1))"
    rho = f"(({between}) - ({within})) / (({between}) + ({each} - 1) * ({within}))"
    return t.select(F.expr(f"""CASE WHEN g < 2 OR n <= g OR s = 0 OR s = n THEN 100.0D
        ELSE 1 / least(0.99D, greatest(0.001D, coalesce({rho}, 0.001D))) - 1 END""").alias("k"))


def host_reputation(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``host, n, s, mean, lower``: posterior of the bad rate of each host with outcomes.

    ``outcomes`` has ``id_col`` and ``bad`` (0 or 1, null: no outcome); an id's
    contradicting outcomes count as bad. Pages with null urls share the empty host.
    """
    known = outcomes.where(F.col("bad").isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max("bad").alias("bad"))
    seen = pages.select(F.col(id_col).alias("_id"), url_host(F.col(url_col)).alias("host"))
    hosts = stash(seen.join(known, "_id").groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("bad").cast("long")).alias("s"))
                      .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = suffixes.agg(((F.sum("s") + 1) / (F.sum("n") + 2)).alias("m"))
    # one-row tables: the overall mean and the strength of each level
    suffixes = (suffixes.join(F.broadcast(total)).join(F.broadcast(strength(suffixes)))
                        .select("suffix", F.expr("(k * m + s) / (k + n)").alias("m")))
    domains = (domains.join(suffixes, "suffix").join(F.broadcast(strength(domains)))
                      .select("domain", "suffix", F.expr("(k * m + s) / (k + n)").alias("m")))
    post = (hosts.join(domains, ["domain", "suffix"]).join(F.broadcast(strength(hosts)))
                 .select("host", "n", "s", F.expr("k * m + s").alias("a"), F.expr("k * (1 - m) + n - s").alias("b")))
    mean, sd = "a / (a + b)", "sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))"
    return post.select("host", "n", "s", F.expr(mean).alias("mean"), F.expr(f"{mean} - {Z}D * {sd}").alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
               max_bad: float = MAX_BAD) -> DataFrame:
    """Per page: ``host, path, rule, verdict`` added to ``pages``.

    The longest rule that fits decides; else the host's posterior: ``block``
    when its lower bound is above ``max_bad``, ``allow`` otherwise (unknown
    hosts too). Null urls and urls without ``://`` have empty host and path.
    Every row gets a row, repeated ones too.
    """
    clash = [c for c in ("host", "path", "rule", "verdict") if c in pages.columns]
    if clash:
        raise ValueError(f"columns {clash} exist")
    r, b = fresh(pages, "_rule"), fresh(pages, "_blocked")
    blocked = stash(host_reputation(pages, outcomes, id_col, url_col).where(F.col("lower") > max_bad).select(F.col("host").alias(b)))
    out = pages.withColumn("host", url_host(F.col(url_col))).withColumn("path", url_path(F.col(url_col)))
    out = out.withColumn(r, rule_of(F.col("host"), F.col("path"), rules)).join(blocked, F.col("host") == F.col(b), "left")
    by_method = F.when(F.col(b).isNotNull(), "block").otherwise("allow")
    return (out.withColumn("rule", F.col(f"{r}.rule")).withColumn("verdict", F.coalesce(F.col(f"{r}.verdict"), by_method))
               .drop(r, b))


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Outcomes from the label table: a page is bad when labelled low quality or toxic."""
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    return labels.select(F.col("doc_id").alias("page_id"), F.when(known, bad.cast("int")).alias("bad"))


def url_verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict``."""
    return judge_urls(pages.select("page_id", "url"), page_outcomes(labels)).select("page_id", "host", "path", "rule", "verdict")
