import random

import pytest

from txscore.llm.url_rules import (
    ALLOW,
    BLOCK,
    Rule,
    build_trie,
    judge_urls,
    longest_match,
    split_url,
)

RULES = [
    Rule("net", "/", BLOCK),
    Rule("example.net", "/en/", ALLOW),
    Rule("example.net", "/en/private", BLOCK),
    Rule("a.example.net", "/", ALLOW),
    Rule("Org", "/fr/", ALLOW),
    Rule("org", "/fr/", BLOCK),
]
URLS = [
    None,
    "",
    "no scheme.net/en/",
    "http://",
    "http://net",
    "http://net/",
    "HTTPS://WWW.Example.NET/en/x?y#z",
    "https://example.net/english",
    "https://example.net/en",
    "https://example.net/en/privateer",
    "https://b.a.example.net/en/private",
    "https://notexample.net/en/x",
    "ftp://org/fr/",
    "ftp://x.org/fr/a#b?c://d",
    "http://a?b://net/",
    "https://net/" + "long/" * 5000,
]


def brute(host, path):
    fit = [
        r
        for r in RULES
        if (host == r.host.lower() or host.endswith("." + r.host.lower())) and path.startswith(r.path)
    ]
    key = lambda r: (r.host.count("."), len(r.path), r.verdict == BLOCK)
    best = max(fit, key=key, default=None)
    return (best.text, best.verdict) if best else None


def test_split_follows_the_first_mark():
    assert split_url("http://a?b://net/") == ("a", "")
    assert split_url("HTTPS://WWW.Example.NET/En/x?y#z") == ("www.example.net", "/En/x")
    assert split_url(None) == split_url("plain") == split_url("x:/y/") == ("", "")


def test_trie_equals_brute_force():
    top, dice = build_trie(RULES), random.Random(3)
    hosts = ["net", "example.net", "a.example.net", "x.a.example.net", "org", "q.org", "rg", ""]
    paths = ["", "/", "/en", "/en/", "/en/private/x", "/en/privat", "/fr/", "//fr/", "/fr"]
    for _ in range(300):
        host, path = dice.choice(hosts), dice.choice(paths)
        assert longest_match(top, host, path) == brute(host, path)


@pytest.mark.parametrize("limit", [1 << 20, 0], ids=["trie", "join"])
def test_both_ways_judge_every_row(spark, limit):
    urls = [*URLS, *URLS[5:8]]
    pages = spark.createDataFrame(
        [(i, url, "x", "y") for i, url in enumerate(urls)],
        "page_id long, url string, host string, verdict string",
    )
    found = {r.page_id: r for r in judge_urls(pages, RULES, max_trie_chars=limit).collect()}
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        host, path = split_url(url)
        rule, verdict = brute(host, path) or (None, ALLOW)
        row = found[i]
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict)


def test_empty_table(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, RULES).count() == 0
    assert judge_urls(pages, RULES, max_trie_chars=0).count() == 0


def test_rule_without_a_path_is_refused():
    with pytest.raises(ValueError, match="not a rule"):
        build_trie([Rule("net", "", BLOCK)])
