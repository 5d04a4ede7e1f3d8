"""URL filters: host and path rules, and empirical-Bayes host reputation for the rest.

Labelled page outcomes (bad or not) are counted per host and shrunk through beta-binomial priors
down the hierarchy all pages > suffix > registered domain > host: each level's prior has the mean
of the level above and a strength estimated from how much the level's own rates spread (the
moment estimator of the beta-binomial). A url is blocked if the lower posterior bound of its
host's bad rate is above ``max_bad_rate`` or, if ``times_corpus`` is given, above that multiple of the bad
rate of all labelled pages; a host without labels has its domain's posterior.

Outcomes are counted per host with partial sums; the levels above are sums of host rows, so a hot
host is one row. One row of sums for each level's prior is all that reaches the driver. An IP address
is a domain of its own under one suffix for all addresses; ports, user names and trailing dots count in
the host of the result, not in its levels.

Defined results: a null url or one without ``://`` has an empty host and path, which no rule
fits, and is judged by its own (empty) host's reputation; repeated rows get equal results, one
each; several labels of one page count as bad if any is; without labels everything unruled is
allowed; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftgate.session import written

#: (host, path, verdict); a rule fits its host and all subdomains where the path starts so.
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
MAX_BAD_RATE = 0.5
BOUND_Z = 1.645  # one-sided 95 %
#: Second-level labels under which names are registered, for two-letter country suffixes.
SECOND_LEVEL = ("ac", "co", "com", "edu", "go", "gov", "mil", "ne", "net", "or", "org")
#: Further suffixes under which different owners hold names. Others may be passed, the
#: whole public list too; of up to ``MAX_LABELS`` labels each.
SUFFIXES = (
    "appspot.com", "azurewebsites.net", "blogspot.com", "firebaseapp.com", "github.io", "gitlab.io", "herokuapp.com",
    "netlify.app", "pages.dev", "vercel.app", "web.app", "wordpress.com", "workers.dev",
)
MAX_LABELS = 4
#: The suffix of hosts that are IP addresses; each address is a domain of its own.
ADDRESS = "[ip]"
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    after = F.coalesce(F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))), F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    rest = F.substring(after, F.length(host) + 1, F.length(after))
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, r"^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict (null: none), as conditional expressions."""
    name = verdict = None
    for h, p, v in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name = F.when(fits, h + p) if name is None else name.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    none = F.lit(None).cast("string")
    return (none, none) if name is None else (name, verdict)


def levels(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, its user, port and trailing dots left out: the longest of
    ``suffixes`` that the host ends with, else a country's second level, else the last label, and
    for the domain one label more."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.*(:[0-9]*)?$", "")
    tail = lambda k: F.substring_index(bare, ".", -k)
    address = bare.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$") | bare.startswith("[")
    suffix, domain = F.when(address, ADDRESS), F.when(address, bare)
    for k in range(MAX_LABELS, 0, -1):
        own = [x for x in suffixes if x.count(".") == k - 1]
        if own:
            suffix, domain = suffix.when(tail(k).isin(own), tail(k)), domain.when(tail(k).isin(own), tail(k + 1))
        if k == 2:
            deep = bare.rlike(r"[^.]\.(%s)\.[a-z]{2}$" % "|".join(SECOND_LEVEL))
            suffix, domain = suffix.when(deep, tail(2)), domain.when(deep, tail(3))
    return domain.otherwise(tail(2)), suffix.otherwise(tail(1))


def strength(groups: DataFrame, prior: str) -> float:
    """The strength of a level's prior from the groups' (n, bad) and their prior means."""
    p = F.col(prior)
    chance = F.col("n") * p * (1 - p)  # what the spread would be by chance alone
    squares = (F.col("bad") - F.col("n") * p) ** 2
    row = groups.agg(F.sum(squares).alias("s"), F.sum(chance).alias("c"), F.sum(F.col("n") * (F.col("n") - 1) * p * (1 - p)).alias("w")).first()
    rho = (row.s - row.c) / row.w if row.w else 0.0  # correlation of outcomes within a group
    return MAX_STRENGTH if rho <= 0 else min(MAX_STRENGTH, max(MIN_STRENGTH, 1 / rho - 1))


def reputation(pages: DataFrame, outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """``pages`` (page_id, host), ``outcomes`` (page_id, bad 0/1): one row per host of the pages
    with its posterior (n, bad, alpha, beta) and the bad rate of all (corpus). No labels: no rows."""
    truth = outcomes.groupBy("page_id").agg(F.max("bad").alias("bad")).filter(F.col("bad").isNotNull())
    domain, suffix = levels(F.col("host"), suffixes)
    marked = pages.join(truth, "page_id", "left")
    hosts = marked.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = written(hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not total.n:
        return hosts.select("host", "n", "bad", F.lit(0.0).alias("alpha"), F.lit(0.0).alias("beta"), F.lit(0.0).alias("corpus")).limit(0)
    mean = F.lit((total.bad + 0.5) / (total.n + 1.0))

    def level(key: str, above: DataFrame | None, up: str | None) -> DataFrame:
        keys = [key] + ([up] if up else [])
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        groups = groups.withColumn("prior", mean) if above is None else groups.join(above, up)
        k = strength(groups, "prior")
        rate = (F.col("bad") + k * F.col("prior")) / (F.col("n") + k)
        return groups.select(*keys, rate.alias("prior"))

    domains = level("domain", level("suffix", None, None), "suffix").select("domain", "prior")
    rated = hosts.join(domains, "domain")
    k = strength(rated, "prior")
    return rated.select(
        "host", "n", "bad", (F.col("bad") + k * F.col("prior")).alias("alpha"),
        (F.col("n") - F.col("bad") + k * (1 - F.col("prior"))).alias("beta"),
        F.lit(total.bad / total.n).alias("corpus"),
    )


def lower_bound(z: float = BOUND_Z) -> Column:
    """The lower bound of the bad rate: the beta posterior's mean less ``z`` deviations."""
    a, b = F.col("alpha"), F.col("beta")
    return F.greatest(F.lit(0.0), a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))))


def judge(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, max_bad_rate: float = MAX_BAD_RATE, times_corpus: float | None = None, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """One row per page: (id, host, path, rule, verdict, host_labels, bad_rate_bound)."""
    host, path = url_parts(F.col(url_col))
    thin = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    known = reputation(thin, outcomes, suffixes).select("host", F.col("n").alias("host_labels"), lower_bound().alias("bound"), "corpus")
    most = F.lit(max_bad_rate) if times_corpus is None else F.lit(times_corpus) * F.col("corpus")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bound") > most, "block").otherwise("allow")
    out = thin.join(known, "host", "left")
    return out.select(
        F.col("page_id").alias(id_col), "host", "path", name.alias("rule"), F.coalesce(verdict, learned).alias("verdict"),
        F.coalesce("host_labels", F.lit(0)).cast("long").alias("host_labels"), F.round(F.coalesce("bound", F.lit(0.0)), 6).alias("bad_rate_bound"),
    )
