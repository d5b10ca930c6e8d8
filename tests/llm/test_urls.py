"""Operator 7 against every rule run on every url."""

import re

import pytest

from aeroseries.llm import url_filter as U

URLS = [
    None, "", "no scheme", "http://", "https://net", "https://net/", "http://a.example.net", "http://a.example.net/en/x", "http://EXAMPLE.net/en/x", "http://example.net/EN/x",
    "http://notexample.net/en/x", "https://x.example.com/de/1?page=2&ref=x", "https://x.example.com/fr/1?page=2&ref=x", "https://blog.example.com/fr/1?page=2&ref=x", "https://a.org/fr/1", "https://a.org/fr",
    "https://a.org/login", "https://a.org/login?x", "https://a.org/loginx", "https://ads.a.com/x", "http://a.com/file.exe", "http://a.com/file.exe?x", "http://user@b.net:80/x", "ftp://c.net/q#f", "http://d.com/a\nb/cart", "http://d.com/cart/",
    "http://é.net/ü", "x://y://z.net/", "http://a.net//en/", "http://a.com/" + "p/" * 3000 + "login",
]


def plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for rule, action in U.LISTED:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or ((), "", ""), ((len(rule), action == U.BLOCK, [-ord(c) for c in rule]), rule, action))
    if best:
        return host, path, best[1], best[2], None
    low = re.sub("[A-Z]", lambda m: m[0].lower(), url or "")
    for rule, action in U.PATTERNS:
        if url is not None and re.search(U.pattern_rule(rule)[0], low):
            best = max(best or ((), "", ""), ((len(rule), action == U.BLOCK, [-ord(c) for c in rule]), rule, action))
    return host, path, None, best[2] if best else U.ALLOW, best[1] if best else None


def test_every_rule_on_every_url(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(3, URLS[5]), (None, URLS[5])]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    have = sorted((tuple(r) for r in got), key=str)
    assert have == sorted(((i, *plain(u)) for i, u in rows), key=str)


def test_clashing_and_empty(spark):
    rows = [(1, "http://a.example.net/en/x", "n", "n", "n", "n", "n")]
    got = U.judge(spark.createDataFrame(rows, "page_id long, url string, host string, rule string, tokens string, token string, best string"))
    assert [tuple(r) for r in got.collect()] == [(1, "a.example.net", "/en/x", "example.net/en/", "allow", None)]
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    assert {r["verdict"] for r in U.judge(spark.createDataFrame([(1, "http://b.net/")], "page_id long, url string"), [], []).collect()} == {"allow"}


def test_rules_lie_under_their_rarest_token(spark):
    urls = spark.createDataFrame([(["", "net", "en"],), (["", "net"],), (["", "example", "net"],)], "tokens array<string>")
    rules = U.compiled(spark, [("net/", "block"), ("example.net/en/", "allow")], [("*.exe|", "block"), ("a*b", "block")])
    got = {r["rule"]: r["token"] for r in U.filed(rules, urls).collect()}
    assert got == {"net/": "net", "example.net/en/": "en", "*.exe|": "exe", "a*b": ""}


@pytest.mark.parametrize("rule, tokens", [("/login^", ["login"]), ("ab/cd*ef/gh", ["cd"][:0]), ("|http://x.", ["http", "x"]), ("://blog.*?page=*&ref=", ["blog", "page", "ref"])])
def test_whole_tokens(rule, tokens):
    assert U.pattern_rule(rule)[1] == tokens
