import random

import pytest

from tidegauge.llm import urls as U


def brute(rules, host, path):
    fitting = [r for r in rules if (not r.host or host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: (len(r.host) + len(r.path), len(r.host), r.verdict == "block"), default=None)


def test_against_brute_force():
    draw = random.Random(1)
    labels, segments = ["a", "b", "com", "ab"], ["", "x", "y", "xy"]
    host = lambda n: ".".join(draw.choice(labels) for _ in range(draw.randrange(n)))
    path = lambda n: "".join("/" + draw.choice(segments) for _ in range(draw.randrange(n)))
    for _ in range(60):
        rules = [U.Rule(draw.choice(["allow", "block"]), host(4), path(4)) for _ in range(12)]
        trie = U.RuleTrie(rules)
        for _ in range(80):
            h, p = host(5), path(5)
            want, got = brute(rules, h, p), trie.match(h, p)
            assert (want and want[:]) == (got and got[:]), (rules, h, p)


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("HTTP://WWW.Example.COM/en/1?q#f", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
        ("http://example.com", "example.com", "", None, "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        ("//example.com/en/", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("x://y://example.com/", "y:", "//example.com/", None, "allow"),
        ("a\nb://É.com/x\ny?z", "É.com", "/x\ny", "com/", "allow"),
        ("http://a.net/fr", "a.net", "/fr", None, "allow"),
        ("http://a.net/fr/", "a.net", "/fr/", "net/fr/", "block"),
        ("http://a.net?x=/fr/", "a.net", "", None, "allow"),
    ],
)
def test_verdicts(spark, url, host, path, rule, verdict):
    from tidegauge.llm.queries import URL_RULES

    pages = spark.createDataFrame([(1, url, "x", "y")], "page_id long, url string, host string, rule string")
    got = U.judge_urls(pages, URL_RULES).first()
    assert tuple(got.url_verdict) == (host, path, rule, verdict) and got.host == "x"
    assert U.judge_urls(pages.limit(0), URL_RULES).count() == 0


def test_the_join_gives_the_verdicts_of_the_trie(spark):
    draw = random.Random(4)
    labels, segments = ["a", "b", "com", "ab"], ["", "x", "y", "xy", "é"]
    host = lambda n: ".".join(draw.choice(labels) for _ in range(draw.randrange(n)))
    path = lambda n: "".join("/" + draw.choice(segments) for _ in range(draw.randrange(n)))
    rules = [U.Rule(draw.choice(["allow", "block"]), host(4), path(4)) for _ in range(150)]
    rows = [(i, None if i % 40 == 0 else f"http://{host(5)}{path(6)}?q", "old") for i in range(400)]
    pages = spark.createDataFrame([*rows, *rows[:3], (900, "no url", "x"), (901, "http://a/" + "x/" * 3000, "x")], "page_id long, url string, url_verdict string")
    results = [U.judge_urls(pages, rules), U.judge_urls(pages, rules, most_rules=10), U.judge_urls(pages, spark.createDataFrame(rules))]
    want, *others = [sorted(map(repr, r.select("page_id", "url", "url_verdict").collect())) for r in results]
    assert others == [want, want] and len(want) == 405
    for r in results[1].collect():
        v = r.url_verdict
        found = brute(rules, v.host, v.path)
        assert (v.rule, v.verdict) == ((found.host + found.path, found.verdict) if found else (None, "allow"))


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([("http://a/b",), (None,)], "url string")
    got = [r.url_verdict for r in U.judge_urls(pages, none, default="block").collect()]
    assert [(v.rule, v.verdict) for v in got] == [(None, "block")] * 2
    assert U.judge_urls(pages.limit(0), none).count() == 0
