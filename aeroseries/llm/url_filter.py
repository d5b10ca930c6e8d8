"""URL filters: pattern rules indexed by their rarest literal token (operator 7).

Two kinds of rules, both turned into regular expressions:

- list rules ``host/path``: the host and its subdomains, paths that start so;
  the longest that fits decides (on a tie block, then the lesser text);
- pattern rules, searched in the lower-cased url: ``*`` is any text, ``^`` any
  character but a letter or digit, or the end, ``|`` at an end anchors.  Where
  no list rule fits they decide the same way; where none matches, allow.

A rule's literal tokens are its runs of letters and digits that must be whole
tokens of a matching url.  Every rule is filed under the one of them that the
fewest urls have (rules without any under the empty token, which each url has).
A url's tokens fetch the rules filed there, and only those run their regular
expressions.  Different urls are judged once.

At most ``MOST_RULES`` rules, so their index may be broadcast.

Defined results: a null url, or one without ``://``, has empty host and path;
a null url meets no rule and is allowed; repeated rows get equal results; other
columns pass through unread.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MOST_RULES = 1_000_000
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BLOCK, ALLOW = "block", "allow"
LISTED = [("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW)]
PATTERNS = [
    ("/login^", BLOCK), ("/signup^", BLOCK), ("/cart^", BLOCK), ("/checkout^", BLOCK), ("/wp-login.php", BLOCK), ("/cgi-bin/", BLOCK),
    ("?page=*&ref=", BLOCK), ("://blog.*?page=*&ref=", ALLOW), ("://ads.", BLOCK), ("*.exe|", BLOCK), ("*.zip|", BLOCK),
]


def list_rule(rule: str) -> tuple[str, list[str]]:
    """(regular expression on host + path, whole tokens) of ``host/path``."""
    return rf"^(?:[^/]*\.)?{re.escape(rule)}", re.findall(r"[a-z0-9]+(?=[^a-z0-9])", rule.lower())


def pattern_rule(rule: str) -> tuple[str, list[str]]:
    """(regular expression on the lower-cased url, whole tokens) of a pattern."""
    body = rule.lower()
    start, end = body.startswith("|"), body.endswith("|")
    body = body.strip("|")
    parts = {"*": ".*", "^": "(?:[^a-z0-9]|$)"}
    regex = ("^" if start else "") + "".join(parts.get(c, re.escape(c)) for c in body) + ("$" if end else "")
    # A token is whole if a literal separator or an anchor stands at both its ends.
    closed = ("|" if start else "*") + body + ("|" if end else "*")
    return "(?s)" + regex, re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", closed)


def compiled(spark, listed: list[tuple[str, str]], patterns: list[tuple[str, str]]) -> DataFrame:
    """(rule, action, listed, regex, tokens)."""
    if len(listed) + len(patterns) > MOST_RULES:
        raise ValueError("too many rules to broadcast")
    rows = [(r, a, True, *list_rule(r)) for r, a in listed] + [(r, a, False, *pattern_rule(r)) for r, a in patterns]
    return spark.createDataFrame(rows, "rule string, action string, listed boolean, regex string, tokens array<string>")


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(F.coalesce(at, F.lit(0)) > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower()), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def tokens_of(text: Column) -> Column:
    """The different tokens of a lower-cased url, and the empty one."""
    return F.array_distinct(F.concat(F.split(text, "[^a-z0-9]+"), F.array(F.lit(""))))


def filed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """Every rule with ``token``: its token that the fewest urls have, or the empty one."""
    own = rules.select("rule", "listed", "action", F.explode("tokens").alias("token")).distinct()
    wanted = F.broadcast(own.select("token").distinct())
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").agg(F.count("*").alias("c"))
    best = own.join(counts, "token", "left").groupBy("rule", "listed", "action").agg(F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "token")).alias("best"))
    keys = ["rule", "listed", "action"]
    return rules.join(best, keys, "left").select(*keys, "regex", F.coalesce("best.token", F.lit("")).alias("token"))


def judge(pages: DataFrame, listed: list[tuple[str, str]] = LISTED, patterns: list[tuple[str, str]] = PATTERNS) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, pattern (the pattern rule that decided, or null)."""
    rules = compiled(pages.sparkSession, listed, patterns)
    low = F.translate("url", UPPER, UPPER.lower())
    urls = pages.where("url is not null").select("url").distinct().withColumn("tokens", tokens_of(low))
    index = F.broadcast(filed(rules, urls))
    host, path = host_and_path(F.col("url"))
    candidates = urls.select("url", F.explode("tokens").alias("token")).join(index, "token")
    candidates = candidates.withColumn("text", F.when(F.col("listed"), F.concat(host, path)).otherwise(low)).where(F.expr("text rlike regex"))
    # The greatest decides: list rules, then longer ones, then block, then the lesser text.
    order = F.struct(F.col("listed"), F.length("rule"), F.col("action") == BLOCK, F.transform(F.split("rule", ""), lambda c: -F.ascii(c)))
    decided = candidates.groupBy("url").agg(F.max_by(F.struct("rule", "listed", "action"), order).alias("best"))
    found = pages.select("page_id", "url").join(decided, "url", "left")
    return found.select(
        "page_id", F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"), F.when(F.col("best.listed"), F.col("best.rule")).alias("rule"),
        F.coalesce("best.action", F.lit(ALLOW)).alias("verdict"), F.when(~F.col("best.listed"), F.col("best.rule")).alias("pattern"),
    )


SQL = r"""
WITH p AS (SELECT page_id, url, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
q AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
      translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM p),
r AS (SELECT *, CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
             CASE WHEN regexp_matches(low, '(?s)://blog\..*\?page=.*&ref=') THEN '://blog.*?page=*&ref='
                  WHEN contains(low, '/wp-login.php') THEN '/wp-login.php'
                  WHEN regexp_matches(low, '(?s)\?page=.*&ref=') THEN '?page=*&ref='
                  WHEN regexp_matches(low, '/checkout([^a-z0-9]|$)') THEN '/checkout^'
                  WHEN contains(low, '/cgi-bin/') THEN '/cgi-bin/'
                  WHEN regexp_matches(low, '/signup([^a-z0-9]|$)') THEN '/signup^'
                  WHEN regexp_matches(low, '/login([^a-z0-9]|$)') THEN '/login^'
                  WHEN contains(low, '://ads.') THEN '://ads.'
                  WHEN ends_with(low, '.exe') THEN '*.exe|'
                  WHEN ends_with(low, '.zip') THEN '*.zip|'
                  WHEN regexp_matches(low, '/cart([^a-z0-9]|$)') THEN '/cart^' END AS matched FROM q)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN matched IS NULL OR starts_with(matched, '://blog') THEN 'allow' ELSE 'block' END AS verdict,
       CASE WHEN rule IS NULL THEN matched END AS pattern FROM r
"""
