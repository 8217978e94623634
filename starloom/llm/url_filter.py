"""URL filters: rules, and an empirical-Bayes host reputation where no rule fits.

Every page of a host is a trial, and one that a rule blocks is a bad outcome;
pages that no rule decides are trials without a bad outcome, so a host is not
condemned by the pages of it that a rule happens to name. The share of bad
pages of a host is shrunk towards its registered domain (the last two labels),
that one's towards its suffix (the last label), and a suffix starts even. How
strongly is read off the data: each level's overdispersion against its parent
gives the weight of the beta-binomial prior. A host is blocked when the lower
posterior bound of its share passes a threshold.

A null url, or one without ``://``, has an empty host and path; its reputation
is even. Without outcomes nothing is blocked. Repeated urls
are pages each on their own; columns other than id and url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bounds of the overdispersion: a parent weighs as 1 to 99 pages.
LEAST, MOST = 0.01, 0.5
Z, THRESHOLD = 1.645, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"\A[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)


def with_rule(urls: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` of the longest rule that fits ``host`` and ``path``."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, host, path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, host + path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return urls.withColumns({"rule": rule, "rule_verdict": verdict})


def _share(n: Column, k: Column, mean: Column, weight: float) -> Column:
    return (k + weight * mean) / (n + weight)


def _weight(groups: DataFrame, mean: Column) -> float:
    """Prior weight from the overdispersion of groups ``(n, k)`` against their parents' ``mean``."""
    spread = mean * (1 - mean)
    row = groups.where("n > 0").agg(
        F.sum(F.col("n") * (F.col("k") / F.col("n") - mean) ** 2 - spread).alias("over"),
        F.sum((F.col("n") - 1) * spread).alias("scale")).first()
    rho = row["over"] / row["scale"] if row["scale"] else LEAST
    return 1 / min(MOST, max(LEAST, rho)) - 1


def reputation(labelled: DataFrame, hosts: DataFrame, z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """``host``, posterior bound ``block_bound`` and ``blocked`` for each distinct host.

    ``labelled`` has ``host`` and ``bad`` (0 or 1); it is summed by host first,
    so a host with very many pages is one row afterwards.
    """
    counts = labelled.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("k"))
    label = F.split("host", r"\.")
    table = hosts.select("host").distinct().join(counts, "host", "left").select(
        "host", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("k", F.lit(0)).alias("k"),
        F.element_at(label, -1).alias("suffix"),
        F.array_join(F.slice(label, F.when(F.size(label) >= 2, -2).otherwise(-1), F.lit(2)), ".").alias("domain"))
    sums = lambda key, *more: table.groupBy(key, *more).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffix = sums("suffix").select("suffix", _share(F.col("n"), F.col("k"), F.lit(0.5), 2).alias("suffix_mean"))
    domain = sums("domain", "suffix").join(suffix, "suffix")
    weight = _weight(domain, F.col("suffix_mean"))
    domain = domain.select("domain", _share(F.col("n"), F.col("k"), F.col("suffix_mean"), weight).alias("domain_mean"))
    judged = table.join(domain, "domain")
    weight = _weight(judged, F.col("domain_mean"))
    a = F.col("k") + weight * F.col("domain_mean")
    b = F.col("n") - F.col("k") + weight * (1 - F.col("domain_mean"))
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    bound = F.round(F.greatest(bound, F.lit(0.0)), 6)
    return judged.select("host", bound.alias("block_bound"), (bound > threshold).alias("blocked"))


def judge(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", rules=RULES,
          labelled: DataFrame | None = None) -> DataFrame:
    """Verdict on every page: the rule's, else its host's reputation.

    ``labelled`` gives the outcomes (``host``, ``bad``); by default every page
    is one, bad where a rule blocks it.
    """
    host, path = host_and_path(F.col(url_column))
    urls = with_rule(pages.select(F.col(id_column).alias("page_id"), host.alias("host"), path.alias("path")), rules)
    if labelled is None:
        labelled = urls.select("host", F.expr("rule_verdict <=> 'block'").cast("long").alias("bad"))
    known = reputation(labelled, urls)
    return urls.join(known, "host").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"), "block_bound")


def oracle() -> str:
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    longest = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for _, h, p in longest)
    verdict = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in longest)
    weight = lambda mean, groups: f"""(SELECT 1 / least({MOST}, greatest({LEAST}, coalesce(
        sum(n * (k / n - {mean}) * (k / n - {mean}) - {mean} * (1 - {mean})) / nullif(sum((n - 1) * {mean} * (1 - {mean})), 0),
        {LEAST}))) - 1 FROM {groups} WHERE n > 0)"""  # noqa: E731
    return f"""
    WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
    split AS (SELECT page_id, translate(regexp_extract(r, '\\A[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
                  regexp_extract(r, '\\A[^/?#]*([^?#]*)', 1) AS path FROM rest),
    urls AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS said FROM split),
    hosts AS (SELECT host, string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
                  count(*)::DOUBLE AS n, (count(*) FILTER (WHERE said = 'block'))::DOUBLE AS k
              FROM urls GROUP BY host),
    s1 AS (SELECT suffix, (sum(k) + 1) / (sum(n) + 2) AS sm FROM hosts GROUP BY suffix),
    d0 AS (SELECT domain, sum(n) AS n, sum(k) AS k, any_value(sm) AS m FROM hosts JOIN s1 USING (suffix) GROUP BY domain),
    d1 AS (SELECT domain, (k + w * m) / (n + w) AS dm FROM d0, (SELECT {weight('m', 'd0')} AS w)),
    h0 AS (SELECT host, n, k, dm AS m FROM hosts JOIN d1 USING (domain)),
    h1 AS (SELECT host, k + w * m AS a, n - k + w * (1 - m) AS b FROM h0, (SELECT {weight('m', 'h0')} AS w)),
    h2 AS (SELECT host, round(greatest(a / (a + b) - {Z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 0.0), 6) AS bound FROM h1)
    SELECT page_id, host, path, rule, coalesce(said, CASE WHEN bound > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict,
        bound AS block_bound
    FROM urls JOIN h2 USING (host)"""
