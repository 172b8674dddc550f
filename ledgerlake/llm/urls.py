"""URL filters: expressions of a url joined to rules by short hashes.

A url is expanded into (host suffix, path prefix) expressions.  Rules and
expressions meet in an equi-join on the first eight hex digits of a
SHA-256; the whole digest confirms a meeting, and the longest confirmed
rule decides.  DataFrame functions only.

Urls are judged once for each distinct (host, path), then joined back.
Host suffixes start at the host and after each dot.  Path prefixes are
taken at the lengths that the rules' paths have; those lengths are bounded
by the longest path in the rules, not by their number.

Defined results: a null url or one without ``://`` has an empty host and
path, fits no rule and gets the default verdict; among fitting rules the
one with most characters wins, then the longer host, then block; rules with
a null part are ignored, repeated ones count once; an empty rule set gives
every url the default.  Other columns of the table pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, fresh

#: (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
SHORT = 8


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (text of the rule that decides, else
    null) and verdict.  ``rules``: host, path, verdict."""
    host, path, rule, verdict, h, p, best = fresh(pages, "host", "path", "rule", "verdict", "of_host", "of_path", "best")
    parsed = pages.withColumns({host: host_of(F.col(url)), path: path_of(F.col(url))})

    r = rules.where("host is not null and path is not null and verdict is not null").select("host", "path", "verdict").distinct()
    r = r.select(F.concat("host", "path").alias("rule"), F.length("host").alias("host_len"), F.col("verdict").alias("rule_verdict"), F.length("path").alias("path_len"), digest(F.col("host"), F.col("path")).alias("rule_digest"))
    r = r.withColumn("rule_short", F.substring("rule_digest", 1, SHORT))
    lengths = sorted(x[0] for x in r.select("path_len").distinct().collect())  # at most as many as a path has characters

    distinct = parsed.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    labels = F.split("h", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.array_distinct(F.filter(F.transform(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: F.when(F.length("p") >= n, F.substring(F.col("p"), F.lit(1), n))), lambda x: x.isNotNull()))
    e = distinct.select("h", "p", F.explode(suffixes).alias("s"), prefixes.alias("prefixes")).select("h", "p", "s", F.explode("prefixes").alias("q"))
    e = e.withColumn("d", digest(F.col("s"), F.col("q"))).withColumn("short", F.substring("d", 1, SHORT))
    met = e.join(r, F.col("short") == F.col("rule_short")).where(F.col("d") == F.col("rule_digest"))
    longest = F.max(F.struct(F.length("rule").alias("n"), "host_len", (F.col("rule_verdict") == "block").alias("block"), "rule", "rule_verdict"))
    decided = met.groupBy(F.col("h").alias(h), F.col("p").alias(p)).agg(longest.alias(best))

    out = parsed.join(decided, (F.col(host) == F.col(h)) & (F.col(path) == F.col(p)), "left")
    return out.select(*pages.columns, host, path, F.col(f"{best}.rule").alias(rule), F.coalesce(f"{best}.rule_verdict", F.lit(default)).alias(verdict))


#: The query in DuckDB's SQL.
JUDGE_SQL = r"""
WITH u AS (
  SELECT page_id, url, strpos(url, '://') AS start FROM pages),
v AS (SELECT page_id, CASE WHEN start > 0 THEN substr(url, start + 3) ELSE '' END AS rest FROM u),
w AS (SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS host0, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM v),
p AS (SELECT page_id, translate(host0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM w),
rules(h, p, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow'))
SELECT page_id, host, path,
       (SELECT r.h || r.p FROM rules r WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p) ORDER BY length(r.h || r.p) DESC LIMIT 1) AS rule,
       coalesce((SELECT r.verdict FROM rules r WHERE (p.host = r.h OR ends_with(p.host, '.' || r.h)) AND starts_with(p.path, r.p) ORDER BY length(r.h || r.p) DESC LIMIT 1), 'allow') AS verdict
FROM p
"""
