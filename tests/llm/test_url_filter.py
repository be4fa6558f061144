from __future__ import annotations

import random
import re

from tallyhouse.llm.url_filter import OpenRules, judge_urls


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_equals_brute_force(spark):
    draw = random.Random(1)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "com", "xa.com", "net", "A.Com", "a.com:80", "", "bücher.de", "..a.com"]
    paths = ["", "/", "/x", "/x/", "/x/y", "/x/y/z", "/X/", "/x y", "/é", "?q", "#f", "/x?//a.com/"]
    rules = [("a.com", "/", "block"), ("a.com", "/x", "allow"), ("a.com", "/x/y", "block"), ("com", "/x/", "block")]
    rules += [("b.a.com", "/x/", "allow"), ("net", "/", "block"), ("de", "/é", "block"), ("com", "/x/y/z", "allow")]
    urls = [f"{draw.choice(['http', 'https'])}://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(300)]
    urls += [None, "", "no scheme", "://", "x://a.com/x/y", "http://a.com/x/y://net/", "http://a.com\n/x"]
    rows = [(i, u, "h", "p") for i, u in enumerate(urls)] + [(0, urls[0], "h", "p"), (None, urls[1], None, None)]
    table = spark.createDataFrame(rows, "page_id long, url string, host string, path string")
    with_bad = [*rules, (None, "/", "block"), ("com", None, "block"), ("a.com", "/", "block")]
    held = spark.createDataFrame(with_bad, "host string, path string, verdict string")
    got = judge_urls(table, held, ranges=7).collect()
    want = [(i, *brute(u, rules)) for i, u, _, _ in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_hosts_nest_on_the_stack():
    rules = OpenRules()
    rules.add("com\x01", "/", "com/", "allow")
    rules.add("com\x01example\x01", "/en/", "example.com/en/", "block")
    rules.add("com\x01example\x01www\x01", "/en/", "www.example.com/en/", "allow")
    assert rules.find("com\x01example\x01www\x01", "/en/x") == ("www.example.com/en/", "allow")
    assert [host.key.count("\x01") for host in rules.stack] == [1, 2, 3]
    assert rules.find("com\x01example\x01www\x01m\x01", "/x") == ("com/", "allow") and len(rules.stack) == 3
    assert rules.find("com\x01example\x01wwx\x01", "/en/") == ("example.com/en/", "block") and len(rules.stack) == 2
    assert rules.find("com\x01examples\x01", "/en/") == ("com/", "allow") and len(rules.stack) == 1
    assert rules.find("net\x01", "/") is None and not rules.stack


def test_a_hot_host_over_many_ranges(spark):
    """Its rules, and those of its parents, are open in every range it is spread over."""
    draw = random.Random(4)
    rules = [("hot.com", f"/{'a' * n}", draw.choice(["allow", "block"])) for n in range(30)]
    rules += [("com", "/b", "block"), ("com", "/ab", "allow"), ("x.hot.com", "/a", "allow"), ("hot.co", "/", "block")]
    urls = [f"http://{draw.choice(['hot.com', 'hot.com', 'hot.com', 'x.hot.com', 'z.com', 'hot.co'])}/" + "".join(draw.choices("ab", k=draw.randrange(12))) for _ in range(600)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    held = spark.createDataFrame(rules, "host string, path string, verdict string")
    for ranges in (1, 16):
        got = sorted(map(tuple, judge_urls(pages, held, ranges=ranges).collect()))
        assert got == [(i, *brute(u, rules)) for i, u in enumerate(urls)]


def test_block_wins_and_empty_tables(spark):
    rules = spark.createDataFrame([("a", "/", "allow"), ("a", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "x://a/")], "page_id long, url string")
    assert judge_urls(pages, rules).first().verdict == "block"
    assert judge_urls(pages, rules.limit(0), default="block").first().verdict == "block"
    assert judge_urls(pages.limit(0), rules).count() == 0
