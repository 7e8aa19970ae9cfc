"""URL filter: host reputation by empirical-Bayes shrinkage of labelled page outcomes.

Outcomes (bad or good) of labelled pages are counted by host, registered domain and suffix.
Each level is a beta-binomial whose prior is the posterior mean of the level above, with a
strength fitted by moments over that level's groups; a host without labels falls back to its
domain, that to its suffix, that to the overall rate.  A host is blocked when even the lower
bound of its posterior bad rate is above a limit.  Everything is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakelens.llm.common import prepare

# --- fixed values: suffixes of two labels under which domains are registered
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "ne.jp",
                      "or.jp", "com.br", "com.cn", "net.cn", "org.cn", "co.in", "co.kr", "co.za", "com.mx", "com.tr")
# ---

#: z of the one-sided 95 % posterior bound, and the bad rate that blocks
Z, LIMIT = 1.6448536269514722, 0.5
#: prior strength of a level: bounds, and the value used where its groups cannot tell
MIN_STRENGTH, MAX_STRENGTH, DEFAULT_STRENGTH = 1.0, 1000.0, 10.0


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


# --- fixed values: the rules
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)
# ---

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    col = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.translate(F.regexp_extract(col, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: str | Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    col = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(col, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does."""
    chain = F
    for r in sorted(rules, key=lambda r: (-len(str(r)), str(r))):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chain = chain.when(fits, F.struct(F.lit(str(r)).alias("rule"), F.lit(r.verdict).alias("verdict")))
    return chain.otherwise(F.lit(None)) if rules else F.lit(None).cast("struct<rule: string, verdict: string>")


def suffix_of(host: Column) -> Column:
    """Public suffix: the last label, or the last two where domains are registered under both."""
    name = F.regexp_replace(host, r"(^[^@]*@)|(:[0-9]*$)", "")
    two = F.substring_index(name, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column, suffix: Column) -> Column:
    """Registered domain: the suffix and one label more (the host itself if it has none)."""
    name = F.regexp_replace(host, r"(^[^@]*@)|(:[0-9]*$)", "")
    dots = F.length(suffix) - F.length(F.replace(suffix, F.lit("."), F.lit("")))
    return F.when(dots == 1, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def strength(groups: DataFrame, above: str) -> float:
    """Beta-binomial prior strength of a level, by moments (one row to the driver).

    ``groups``: n, bad and the prior mean ``above`` of each group.  With S the sum of squared
    deviations of bad counts from n * m, E[S] = sum n m (1 - m) (1 + (n - 1) rho), rho = 1 / (k + 1).
    """
    m = F.col(above)
    base = F.col("n") * m * (1 - m)
    sums = groups.agg(F.sum((F.col("bad") - F.col("n") * m) * (F.col("bad") - F.col("n") * m)).alias("s"),
                      F.sum(base).alias("a"), F.sum(base * (F.col("n") - 1)).alias("b"))
    rho = F.try_divide(F.col("s") - F.col("a"), F.col("b"))
    k = F.when(rho > 0, 1 / rho - 1)
    return sums.select(F.coalesce(F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), k)),
                                  F.lit(DEFAULT_STRENGTH))).first()[0]


def reputation(outcomes: DataFrame, prior_rate: float = 0.5) -> tuple[DataFrame, DataFrame, DataFrame, tuple[float, float]]:
    """Posterior bad-rate tables by host, domain and suffix, and the overall alpha and beta.

    ``outcomes``: host and bad (0/1) of labelled pages.  Each table has alpha and beta, the
    posterior beta parameters of its groups, and is cut to the checkpoint folder.  Without outcomes
    the overall pair is the prior.
    """
    suffix = suffix_of(F.col("host"))
    counts = (outcomes.groupBy("host").agg(F.count(F.lit(1)).cast("double").alias("n"),
                                           F.sum("bad").cast("double").alias("bad"))
              .withColumn("suffix", suffix).withColumn("domain", domain_of(F.col("host"), F.col("suffix"))).checkpoint())
    overall = counts.agg(F.coalesce(F.sum("n"), F.lit(0.0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad"))
    overall = overall.select((F.col("bad") + prior_rate * 2).alias("alpha"),
                             (F.col("n") - F.col("bad") + (1 - prior_rate) * 2).alias("beta"))

    def level(groups: DataFrame, mean: Column) -> DataFrame:
        based = groups.withColumn("m", mean)
        k = F.lit(strength(based, "m"))
        return (based.withColumn("alpha", F.col("bad") + k * F.col("m"))
                .withColumn("beta", F.col("n") - F.col("bad") + k * (1 - F.col("m"))).drop("n", "bad", "m").checkpoint())

    def total(*keys: str) -> DataFrame:
        return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def prior(table: DataFrame, key: str) -> DataFrame:
        return table.select(key, (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("prior"))
    alpha, beta = overall.first()
    by_suffix = level(total("suffix"), F.lit(alpha / (alpha + beta)))
    by_domain = level(total("domain", "suffix").join(prior(by_suffix, "suffix"), "suffix"), F.col("prior"))
    by_host = level(counts.select("host", "domain", "n", "bad").join(prior(by_domain, "domain"), "domain"), F.col("prior"))
    return by_host.select("host", "alpha", "beta"), by_domain.select("domain", "alpha", "beta"), \
        by_suffix.select("suffix", "alpha", "beta"), (alpha, beta)


def lower_bound(alpha: Column, beta: Column, z: float = Z) -> Column:
    """Lower posterior bound of the bad rate: mean minus z standard deviations, at least 0."""
    n = alpha + beta
    return F.greatest(F.lit(0.0), alpha / n - z * F.sqrt(alpha * beta / (n * n * (n + 1))))


def judge_urls(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: tuple[Rule, ...] = RULES, limit: float = LIMIT, z: float = Z) -> DataFrame:
    """id, host, path, rule, bad_rate_bound (null where a rule decides) and verdict of every row of ``pages``.

    The longest fitting rule decides; else a host is blocked if the lower bound of its
    posterior bad rate exceeds ``limit``.  Null urls and urls without ``://`` have an empty
    host and path and are judged by the overall rate like any host without labels.  Repeated
    rows and null ids stay; other columns are not read; an empty table gives an empty result.
    Reputation is looked up for each distinct host once and joined back on the host, whose
    skew AQE splits; pages a rule decides do not take part in that join.
    """
    prepare(pages.sparkSession)
    by_host, by_domain, by_suffix, overall = reputation(outcomes)
    parsed = (pages.select(F.col(id_col).alias("id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
              .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)))
    ruled, open_ = parsed.filter(F.col("fit").isNotNull()), parsed.filter(F.col("fit").isNull())
    hosts = open_.select("host").distinct().withColumn("suffix", suffix_of(F.col("host")))
    named = hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix")))

    def bound(table: DataFrame) -> DataFrame:
        return table.withColumn("bound", lower_bound(F.col("alpha"), F.col("beta"), z)).drop("alpha", "beta")
    for key, table in (("host", by_host), ("domain", by_domain), ("suffix", by_suffix)):
        named = named.join(bound(table).withColumnRenamed("bound", f"b_{key}"), key, "left")
    judged = named.select("host", F.coalesce("b_host", "b_domain", "b_suffix", lower_bound(*map(F.lit, overall), z)).alias("bound"))
    verdict = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return (ruled.select(F.col("id").alias(id_col), "host", "path", "fit.rule",
                         F.lit(None).cast("double").alias("bad_rate_bound"), "fit.verdict")
            .unionByName(open_.join(judged, "host").select(
                F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"),
                F.round("bound", 6).alias("bad_rate_bound"), verdict.alias("verdict"))))
