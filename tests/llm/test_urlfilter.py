import re

import pytest

from dimstar.llm.urlfilter import HOST_RULES, PATTERNS, HostRule, Pattern, from_table, judge

URLS = [
    "http://a.example.com/en/x?q#f", "https://www.example.com/en/", "https://EXAMPLE.com/en/1", "https://example.com/EN/1", "//example.com/en/",
    "http://example.com", "http://example.com?x=/en/", "http://x.net/es/1", "http://net/fr/", "http://xnet/fr/", "ftp://user@x.net:80/fr/1",
    "http://a.net/poker/1", "http://free-bets.example.net/de/1", "http://free.bets", "http://freebets.org/", "http://bets-free.org/",
    None, "", "://", "a://b://c.com/", "http://com/", "http://.com/", "http://spam\n.example.net/", "http://Ästhetik.com/", "http://x.org/casino",
    "http://x.org/Casino/", "http://x.org/a/FREE-Bets", "http://x.net/ES/1", "http://x.org/" + "long/" * 20_000 + "Poker",
]


def brute(url, rules, patterns):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.name), default=None)
    words = [w for w in re.split("[^A-Za-z0-9]+", re.sub("[A-Z]", lambda m: m[0].lower(), host + path))]
    hit = min((p.name for p in patterns if any(words[i : i + len(p.words)] == p.tokens for i in range(len(words)))), default=None)
    return host, path, rule and rule.name, rule.verdict if rule else "block" if hit else "allow", hit


@pytest.mark.parametrize("rules, patterns", [(HOST_RULES, PATTERNS), (HOST_RULES, ()), ((), PATTERNS), ((), ()),
                                             ((HostRule("block", "example.com", "/e"), HostRule("allow", "a.example.com", "")), (Pattern("block", ("x",)),))])
def test_every_rule_on_every_url(spark, rules, patterns):
    rows = [(i, u, "p", "h") for i, u in enumerate(URLS)] + [(0, URLS[0], "p", "h"), (None, URLS[1], "p", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, path string, host string")
    got = sorted((tuple(r) for r in judge(pages, rules=rules, patterns=patterns).collect()), key=repr)
    assert got == sorted(((i, *brute(u, rules, patterns)) for i, u, _, _ in rows), key=repr)


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_open_end_of_a_path_is_no_token():
    assert HostRule("block", "example.com", "/e").tokens == ["example", "com"]


def test_patterns_are_blind_to_case(spark):
    pages = spark.createDataFrame([(1, "http://x.org/Casino/"), (2, "http://x.org/casinos")], "page_id long, url string")
    assert {r["page_id"]: r["verdict"] for r in judge(pages).collect()} == {1: "block", 2: "allow"}


def test_rules_of_a_table(spark):
    table = spark.createDataFrame([("block", "Example.com", "/en/", None), ("allow", "a.example.com", None, None), ("block", None, None, "Free-Bets")],
                                  "verdict string, host string, path string, words string")
    rules, patterns = from_table(table)
    assert rules == (HostRule("allow", "a.example.com", ""), HostRule("block", "example.com", "/en/"))
    assert patterns == (Pattern("block", ("Free", "Bets")),)
    rows = [(i, u) for i, u in enumerate(URLS)]
    got = sorted((tuple(r) for r in judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules, patterns=patterns).collect()), key=repr)
    assert got == sorted(((i, *brute(u, rules, patterns)) for i, u in rows), key=repr)
    with pytest.raises(ValueError):
        from_table(table.withColumn("verdict", table.host))


def test_no_python_on_the_main_path(spark):
    pages = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string").repartition(2)
    plan = judge(pages)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and plan.count("LogicalRDD") == 2  # the pages alone, read on either side
