"""The automaton against regular expressions and plain rules."""

from __future__ import annotations

import random
import re

from roadpulse.llm.registry import URL_RULES
from roadpulse.llm.url_rules import HOST_GLOBS, Automaton, Rule, judge_urls, split_url


def test_automaton_against_regular_expressions():
    r = random.Random(4)
    globs = [
        "".join(r.choices(["a", "b", "ab", "*", "**", "\0", "."], k=r.randint(1, 7)))
        for _ in range(120)
    ]
    texts = ["".join(r.choices("ab\0.", k=r.randint(0, 9))) for _ in range(300)] + ["ab" * 5000]
    got = Automaton([g.encode() for g in globs]).match([t.encode() for t in texts])
    assert Automaton([g.encode() for g in globs]).words > 4
    for j, g in enumerate(globs):
        pattern = ""
        for part in re.findall(r"\*\*|\*|[^*]", g):
            pattern += {"**": "[^§]*", "*": "[^\0]*"}.get(part, re.escape(part))
        for i, t in enumerate(texts[:-1]):
            assert got[i, j] == bool(re.fullmatch(pattern, t)), (g, t)


URLS = {
    "https://Blog.Example.NET/en/7?x#y": ("blog.example.net", "/en/7", "example.net/en/", "allow"),
    "http://example.net/de/": ("example.net", "/de/", "net/", "block"),
    "http://net": ("net", "", None, "allow"),
    "http://net/": ("net", "/", "net/", "block"),
    "http://internet/x": ("internet", "/x", None, "allow"),
    "http://a.example.com/de/1": ("a.example.com", "/de/1", "example.com/de/", "block"),
    "http://a.example.com/de": ("a.example.com", "/de", None, "allow"),
    "http://badexample.com/de/1": ("badexample.com", "/de/1", None, "allow"),
    "http://x.org/fr/": ("x.org", "/fr/", "org/fr/", "allow"),
    "http://a.com/x.net/": ("a.com", "/x.net/", None, "allow"),
    "http://casino.org?net/": ("casino.org", "", None, "block"),
    "http://casino.org/fr/x": ("casino.org", "/fr/x", "org/fr/", "allow"),
    "http://ÄX.net/É#": ("Äx.net", "/É", "net/", "block"),
    "no-scheme/net/": ("", "", None, "allow"),
    "http:///net/": ("", "/net/", None, "allow"),
    "http://a\0b.net/\0": ("a\0b.net", "/\0", "net/", "block"),
    "": ("", "", None, "allow"),
}


def test_rules(spark):
    pages = spark.createDataFrame(list(enumerate([*URLS, None])), "page_id long, url string")
    got = judge_urls(pages, URL_RULES).collect()
    want = [(i, *v) for i, v in enumerate([*URLS.values(), ("", "", None, "allow")])]
    assert sorted(tuple(r) for r in got) == want


def test_first_of_equally_long_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c/d")], "page_id long, url string")
    rules = [Rule("block", "a.b", "/"), Rule("allow", "b", "/c/")]
    assert judge_urls(pages, rules).first().rule == "a.b/"
    assert judge_urls(pages, rules[::-1]).first().rule == "b/c/"


def test_very_long_and_many(spark):
    urls = ["http://a.net/" + "x" * 300_000, *(f"http://s{i}.com/" for i in range(3000))]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = judge_urls(pages, URL_RULES).groupBy("rule").count().collect()
    assert {r["rule"]: r["count"] for r in got} == {"net/": 1, None: 3000}


def test_edge_cases(spark):
    rows = [(None, "http://a.net/"), (1, None), (1, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("rule", _lit("x"))
    got = sorted(judge_urls(pages, URL_RULES).collect(), key=str)
    assert [(r.page_id, r.verdict) for r in got] == [(1, "allow"), (1, "allow"), (None, "block")]
    assert judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert split_url(None) == ("", "") and len(HOST_GLOBS) < 20


def _lit(x):
    from pyspark.sql import functions as F

    return F.lit(x)
