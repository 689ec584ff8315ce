"""URL verdicts: rules first, then the reputation of the host.

A rule (host and path start) decides what it fits.  The pages that rules decide
are the labelled outcomes of their hosts; every other page is judged by its
host's rate of blocked pages, an empirical-Bayes estimate: the rate of a host
is shrunk towards that of its registered domain, the domain's towards its
suffix, the suffix's towards all pages, each by a beta-binomial prior whose
strength is fitted to how much the rates below one parent differ.  A page is
blocked where even the lower posterior bound of its host reaches ``BLOCK_AT``.

Everything is counts by host: pages are read once for the counts and once for
the verdicts, and meet their host's verdict in an equi-join.

Defined results: a url that is null or has no ``://`` has an empty host and an
empty path, fits no rule, and is judged by the rate of such pages (allowed
unless they are labelled); null ids and repeated rows pass through, each row
judged by itself; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: (verdict, host, path start): a rule fits its host and all subdomains; the longest that fits decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Rate of blocked pages that the lower bound must reach, and the bound's distance in standard deviations.
BLOCK_AT, BOUND = 0.5, 1.645
#: Public suffixes of more than one label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.kr", "co.nz", "com.br", "com.cn", "co.in", "co.za")
#: Bounds of the fitted likeness of siblings (1 / (strength + 1)).
LEAST_LIKE, MOST_LIKE = 0.001, 0.999

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as text, verdict) of the longest rule that fits; null where none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, h + p).otherwise(text), F.when(fits, v).otherwise(verdict)
    return text, verdict


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    """The public suffix and the registered domain of a host (its port left out); a bare address is its own."""
    name = F.regexp_replace(host, r":\d*$", "")
    short = F.substring_index(name, ".", -1)
    address = short.rlike(r"^\d+$") | name.contains(":")
    long = F.substring_index(name, ".", -2).isin(*LONG_SUFFIXES)
    suffix = F.when(address, name).when(long, F.substring_index(name, ".", -2)).otherwise(short)
    domain = F.when(address, name).when(long, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return suffix, domain


def _strength(children: DataFrame) -> float:
    """The beta prior's strength from children (n, k, parent mean m), by the method of moments."""
    spread = F.col("m") * (1 - F.col("m"))
    rate = F.col("k") / F.col("n") - F.col("m")
    row = children.where("n > 0").agg(F.sum(F.col("n") * rate * rate - spread).alias("a"), F.sum((F.col("n") - 1) * spread).alias("b")).first()
    like = row["a"] / row["b"] if row["a"] is not None and row["b"] else MOST_LIKE
    like = min(max(like, LEAST_LIKE), MOST_LIKE)
    return 1 / like - 1


def host_rates(pages: DataFrame) -> DataFrame:
    """host, mean, bound: the shrunken rate of blocked pages and its lower bound; pages: host, verdict (null if unlabelled)."""
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = saved(pages.groupBy("host").agg(F.count("verdict").alias("n"), F.count(F.when(F.col("verdict") == "block", 1)).alias("k"))
                  .withColumns({"suffix": suffix, "domain": domain}), "hosts")
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    m = whole["k"] / whole["n"] if whole["n"] else 0.0
    top = float(whole["n"] or 0)

    def shrunk(level: DataFrame, *keep: str) -> DataFrame:
        """Posterior mean and weight of each row of (n, k) below a parent of mean ``m`` and weight ``t``."""
        s = _strength(level)
        prior = F.lit(s) * F.col("t") / (F.lit(s) + F.col("t"))  # a prior is no surer than the parent's rate
        mean = F.try_divide(prior * F.col("m") + F.col("k"), prior + F.col("n"))
        return level.select(*keep, F.coalesce(mean, "m").alias("m"), (prior + F.col("n")).alias("t"))

    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    suffixes = shrunk(hosts.groupBy("suffix").agg(*sums).withColumns({"m": F.lit(m), "t": F.lit(top)}), "suffix")
    domains = shrunk(hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix"), "suffix", "domain")
    rates = shrunk(hosts.join(domains, ["suffix", "domain"]), "host")
    mean = F.col("m")
    return rates.select("host", mean.alias("mean"), (mean - BOUND * F.sqrt(mean * (1 - mean) / (F.col("t") + 1))).alias("bound"))


def judged(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict of every row."""
    rows = pages.select(F.col(id_col).alias("page_id"), url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    rates = host_rates(rows).select("host", (F.col("bound") >= BLOCK_AT).alias("bad"))
    by_host = F.when(F.col("bad"), "block").otherwise("allow")
    return rows.join(rates, "host", "left").select("page_id", "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"))


def oracle(rules=RULES) -> str:
    """The same in DuckDB's SQL."""
    order = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1]))
    fits = [(v, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for v, h, p in order]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for _, t, c in fits) + " END"
    verdict = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for v, _, c in fits) + " END"
    long = ", ".join(f"'{s}'" for s in LONG_SUFFIXES)

    def strength(table: str) -> str:
        like = f"sum(n * (k / n - m) * (k / n - m) - m * (1 - m)) / nullif(sum((n - 1) * m * (1 - m)), 0)"
        return f"(SELECT 1 / least(greatest(coalesce({like}, {MOST_LIKE}), {LEAST_LIKE}), {MOST_LIKE}) - 1 AS s FROM {table} WHERE n > 0)"

    return f"""
WITH cut AS (SELECT page_id,
    coalesce(translate(regexp_extract(url, '{_URL}', 1), '{_UPPER}', '{_LOWER}'), '') AS host,
    coalesce(regexp_extract(url, '{_URL}', 2), '') AS path FROM pages),
rows AS (SELECT *, {rule} AS rule, {verdict} AS ruled FROM cut),
hosts AS (SELECT host, name, count(ruled) AS n, count(*) FILTER (ruled = 'block') AS k,
    string_split(name, '.') AS p FROM (SELECT *, regexp_replace(host, ':\\d*$', '') AS name FROM rows) GROUP BY ALL),
placed AS (SELECT host, n, k,
    CASE WHEN regexp_matches(p[-1], '^\\d+$') OR contains(name, ':') THEN name
         WHEN array_to_string(p[-2:], '.') IN ({long}) THEN array_to_string(p[-2:], '.') ELSE p[-1] END AS suffix,
    CASE WHEN regexp_matches(p[-1], '^\\d+$') OR contains(name, ':') THEN name
         WHEN array_to_string(p[-2:], '.') IN ({long}) THEN array_to_string(p[-3:], '.') ELSE array_to_string(p[-2:], '.') END AS domain FROM hosts),
top AS (SELECT coalesce(sum(k) / nullif(sum(n), 0), 0) AS m, sum(n)::DOUBLE AS t FROM placed),
l1 AS (SELECT suffix, sum(n) AS n, sum(k) AS k, any_value(top.m) AS m, any_value(top.t) AS t FROM placed, top GROUP BY suffix),
m1 AS (SELECT suffix, coalesce((s * t / (s + t) * m + k) / nullif(s * t / (s + t) + n, 0), m) AS m, s * t / (s + t) + n AS t FROM l1, {strength("l1")}),
l2 AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k, any_value(m1.m) AS m, any_value(m1.t) AS t FROM placed JOIN m1 USING (suffix) GROUP BY suffix, domain),
m2 AS (SELECT suffix, domain, coalesce((s * t / (s + t) * m + k) / nullif(s * t / (s + t) + n, 0), m) AS m, s * t / (s + t) + n AS t FROM l2, {strength("l2")}),
l3 AS (SELECT host, n, k, m2.m AS m, m2.t AS t FROM placed JOIN m2 USING (suffix, domain)),
m3 AS (SELECT host, coalesce((s * t / (s + t) * m + k) / nullif(s * t / (s + t) + n, 0), m) AS mean, s * t / (s + t) + n AS total FROM l3, {strength("l3")})
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN mean - {BOUND} * sqrt(mean * (1 - mean) / (total + 1)) >= {BLOCK_AT} THEN 'block' ELSE 'allow' END) AS verdict
FROM rows LEFT JOIN m3 USING (host)
"""
