"""URL filters by host reputation.

Labelled pages give each host a number of outcomes and of good ones. A host's share of good pages is shrunk, by a
beta-binomial model, towards that of its registered domain, the domain's towards that of its suffix, and the
suffix's towards that of all pages; how far is estimated from the spread at each level (empirical Bayes). A host is
allowed if the lower bound of its posterior is high enough. Rules for hosts and paths take precedence.

Only DataFrame functions are used.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

# (host, path, verdict)
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# Suffixes of two labels; a parameter, since the full public list isn't part of this repository.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in")
# Posterior standard deviations below the mean, and the least good share, of an allowed host.
DEVIATIONS, LEAST_GOOD = 1.645, 0.5
# Bounds of the estimated correlation of outcomes under one parent.
CORRELATION = (1e-4, 0.5)


def parse(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path; both empty if url is null or has no '://'."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, parts, i), F.lit("")) for i in (1, 2))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def registered(host: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without port and user; a bare address is its own domain."""
    name = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    n = F.when(F.substring_index(name, ".", -2).isin(*two_label), 2).otherwise(1) if two_label else F.lit(1)
    address = name.rlike(r"^[0-9.]+$|:")
    labels = F.split(name, r"\.")
    last = lambda k: F.array_join(F.slice(labels, F.greatest(F.size(labels) - k + 1, F.lit(1)), k), ".")
    return F.when(address, name).otherwise(last(n + 1)), F.when(address, F.lit("")).otherwise(last(n))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in one, and its verdict; null where none fits."""
    name = verdict = F
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    for rule_host, rule_path, says in ordered:
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name, verdict = name.when(fits, rule_host + rule_path), verdict.when(fits, says)
    return (name, verdict) if ordered else (F.lit(None).cast("string"),) * 2


def outcomes(pages: DataFrame, labels: DataFrame, page: str, url: str, label_page: str, good: str) -> DataFrame:
    """host, n (labelled outcomes), y (good ones) of every host; pages without a label count nothing."""
    each = labels.where(F.col(good).isNotNull()).groupBy(F.col(label_page).alias("page")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col(good) == 1, 1).otherwise(0)).alias("y")
    )
    host, _ = parse(F.col(url))
    seen = pages.select(F.col(page).alias("page"), host.alias("host")).join(each, "page", "left")
    return seen.groupBy("host").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("y"))


def _strength(children: DataFrame) -> float:
    """Prior observations that a parent's mean is worth, from the spread of its children (method of moments)."""
    chance = F.col("mean") * (1 - F.col("mean"))
    got = children.agg(
        F.sum(F.pow(F.col("y") - F.col("n") * F.col("mean"), 2) - F.col("n") * chance).alias("extra"),
        F.sum(F.col("n") * (F.col("n") - 1) * chance).alias("scale"),
    ).first()
    rho = got.extra / got.scale if got.scale else CORRELATION[0]
    return 1 / min(max(rho, CORRELATION[0]), CORRELATION[1]) - 1


def reputation(hosts: DataFrame) -> DataFrame:
    """host, n, y, mean and bound: the posterior mean of a host's good share and its lower bound.

    Without any labelled page all hosts have mean and bound null.
    """
    domain, suffix = registered(F.col("host"))
    hosts = written(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = written(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y")), "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("y").alias("y"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("y").alias("y")).first()
    if not total.n:
        empty = F.lit(None).cast("double")
        return hosts.select("host", "n", "y", empty.alias("mean"), empty.alias("bound"))
    level = written(suffixes.withColumn("mean", F.lit((total.y + 0.5) / (total.n + 1))), "suffixes")
    for children, key in ((domains, "suffix"), (hosts, "domain")):
        strength = _strength(level)
        posterior = (F.col("mean") * strength + F.col("y")) / (strength + F.col("n"))
        parent = level.select(key, posterior.alias("mean"))
        level = written(children.join(parent, key), f"of-{key}")
    strength = _strength(level)
    a = F.col("mean") * strength + F.col("y")
    b = (1 - F.col("mean")) * strength + F.col("n") - F.col("y")
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return level.select("host", "n", "y", mean.alias("mean"), (mean - DEVIATIONS * deviation).alias("bound"))


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    page: str = "page_id",
    url: str = "url",
    label_page: str = "doc_id",
    good: str = "quality",
) -> DataFrame:
    """Per row of pages: page, host, path, rule, verdict (allow or block), mean and bound of the host.

    The rule's verdict holds; where none fits, a host is blocked if its bound is below LEAST_GOOD. All is allowed
    where nothing is labelled. Null and odd urls share the empty host. Several labels of a page are several
    outcomes, null ones none. Repeated rows and null page ids give a row each; other columns aren't read.
    """
    known = written(reputation(outcomes(pages, labels, page, url, label_page, good)), "reputation")
    host, path = parse(F.col(url))
    parsed = pages.select(F.col(page).alias("page"), host.alias("host"), path.alias("path"))
    # one host may hold much of the pages: its side is either broadcast, being small, or split by adaptive execution
    joined = parsed.join(known.select("host", "mean", "bound"), "host", "left")
    rule, says = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") < LEAST_GOOD, "block").otherwise("allow")
    return joined.select(
        F.col("page").alias(page), "host", "path", rule.alias("rule"), F.coalesce(says, own).alias("verdict"), "mean", "bound"
    )


def oracle_sql() -> str:
    """The query's columns in DuckDB SQL."""
    two = ", ".join(f"'{x}'" for x in TWO_LABEL_SUFFIXES)
    fits = [
        (f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))", h + p, v)
        for h, p, v in sorted(RULES, key=lambda r: (-len(r[0] + r[1]), r))
    ]
    rule = " ".join(f"WHEN {f} THEN '{name}'" for f, name, _ in fits)
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, _, v in fits)
    strength = (
        f"1 / least(greatest(coalesce(sum(power(y - n * mean, 2) - n * mean * (1 - mean))"
        f" / nullif(sum(n * (n - 1) * mean * (1 - mean)), 0), {CORRELATION[0]}), {CORRELATION[0]}), {CORRELATION[1]}) - 1"
    )
    return f"""
    WITH parsed AS (
      SELECT page_id,
             translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
      FROM pages),
    each AS (SELECT doc_id, count(*) AS n, sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS y FROM labels
             WHERE quality IS NOT NULL GROUP BY doc_id),
    counted AS (SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(y), 0) AS y FROM parsed LEFT JOIN each ON page_id = doc_id GROUP BY host),
    named AS (SELECT *, regexp_replace(host, '^.*@|:[0-9]*$', '', 'g') AS name FROM counted),
    cut AS (SELECT *, string_split(name, '.') AS parts, regexp_matches(name, '^[0-9.]+$|:') AS address FROM named),
    sized AS (SELECT *, CASE WHEN array_to_string(parts[-2:], '.') IN ({two}) THEN 2 ELSE 1 END AS k FROM cut),
    hosts AS (SELECT host, n, y,
                     CASE WHEN address THEN name ELSE array_to_string(parts[greatest(len(parts) - k, 1):], '.') END AS domain,
                     CASE WHEN address THEN '' ELSE array_to_string(parts[greatest(len(parts) - k + 1, 1):], '.') END AS suffix
              FROM sized),
    domains AS (SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM hosts GROUP BY ALL),
    total AS (SELECT sum(n) AS n, sum(y) AS y FROM domains),
    l0 AS (SELECT suffix, sum(d.n) AS n, sum(d.y) AS y, any_value((t.y + 0.5) / (t.n + 1)) AS mean FROM domains d, total t GROUP BY suffix),
    s0 AS (SELECT {strength} AS m FROM l0),
    l1 AS (SELECT d.domain, d.n, d.y, (l0.mean * m + l0.y) / (m + l0.n) AS mean FROM domains d JOIN l0 USING (suffix), s0),
    s1 AS (SELECT {strength} AS m FROM l1),
    l2 AS (SELECT h.host, h.n, h.y, (l1.mean * m + l1.y) / (m + l1.n) AS mean FROM hosts h JOIN l1 USING (domain), s1),
    s2 AS (SELECT {strength} AS m FROM l2),
    ab AS (SELECT host, mean * m + y AS a, (1 - mean) * m + n - y AS b FROM l2, s2),
    known AS (SELECT host, a / (a + b) - {DEVIATIONS} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM ab)
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {verdict} WHEN bound < {LEAST_GOOD} AND (SELECT n FROM total) > 0 THEN 'block' ELSE 'allow' END AS verdict
    FROM parsed LEFT JOIN known USING (host)"""
