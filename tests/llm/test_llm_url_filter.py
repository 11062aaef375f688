"""URL entries against plain matching of every entry, by the trie and by joins."""

import random

import pytest

from tributary.llm import url_filter

RULES = [
    ("org", "allow"), ("org/", "block"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("example.org/en/12/x", "allow"),
    ("com/fr/", "allow"), ("com/de/", "block"), ("A.Example.COM/De/a", "allow"), ("a.com", "block"), ("a.com", "allow"), ("a.com", "allow"),
    (None, "block"), ("net/", None), ("net/", "other"), ("example.org/en/", "allow"), ("b.org//", "allow"), ("b.org/x/", "block"),
]
URLS = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "HTTP://EXAMPLE.org/es/1", "http://x.example.org/en/1", "http://example.org/en/12/x?y#z",
    "http://example.org/en/2", "http://notexample.org/es/", "http://a.com", "http://b.a.com/fr/q", "http://acom/", "http://x.com/FR/", "http://x.com/fr", "http://x.com/de/#a",
    "http://x.com?/de/", "http://x.com#/de/", "http://a.example.com/De/abc", "http://user@x.com:80/de/", "http://b.org//", "http://b.org/x/y", "http://..org/", "http://.com/de/",
    "http://x.com/a://b.org/", "http://b.org/" + "s/" * 3000,
] + ["http://x.org/de/1"] * 3


def plain(url, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for rule, verdict in RULES:
        if rule is None or verdict not in ("allow", "block"):
            continue
        own, slash, tail = rule.partition("/")
        own = own.lower()
        if (host == own or host.endswith("." + own)) and path.startswith(slash + tail):
            found = (len(own), len(slash + tail), verdict, own + slash + tail)
            best = max(best or found, found)
    return host, path, best and best[3], best[2] if best else default


@pytest.fixture(scope="module")
def rules(spark):
    return spark.createDataFrame(RULES, "rule string, verdict string")


def shown(df):
    return [tuple(r) for r in df.orderBy("page_id").collect()]


@pytest.mark.parametrize("most", [1000, 0])
def test_equals_plain_matching(spark, rules, most):
    rng = random.Random(7)
    hosts, parts = ["example.org", "a.com", "x.a.com", "b.org", "com", "q.example.com", "a.example.com"], ["en", "es", "de", "fr", "1", "12", "x", "De", "a", ""]
    urls = URLS + [f"http://{rng.choice(hosts)}/{'/'.join(rng.choices(parts, k=rng.randint(0, 4)))}" for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.with_verdicts(rows, rules, most_entries=most).select("row.page_id", "host", "path", "rule", "verdict")
    assert shown(got) == [(k, *plain(u)) for k, u in enumerate(urls)]


@pytest.mark.parametrize("most", [1000, 0])
def test_rows_stay_whole(spark, rules, most):
    rows = spark.createDataFrame([(u, "h", "p", "r", "v", None, 1) for u in URLS], "url string, host string, path string, rule string, verdict string, row string, found int")
    kept = url_filter.with_verdicts(rows, rules, default="block", most_entries=most).where("verdict = 'allow'").select("row.*")
    assert kept.columns == rows.columns
    assert sorted(r.url for r in kept.collect()) == sorted(u for u in URLS if plain(u, "block")[3] == "allow")
    assert url_filter.allowed(rows, rules).columns == rows.columns


@pytest.mark.parametrize("most", [1000, 0])
def test_nothing_to_judge_or_to_judge_by(spark, rules, most):
    rows = spark.createDataFrame([(1, "http://a.com/x"), (None, None)], "page_id long, url string")
    assert url_filter.with_verdicts(rows.limit(0), rules, most_entries=most).count() == 0
    got = url_filter.with_verdicts(rows, rules.limit(0), most_entries=most - 1)
    assert sorted((r.host, r.rule, r.verdict) for r in got.collect()) == [("", None, "allow"), ("a.com", None, "allow")]


def test_many_entries_on_one_host(spark):
    """Every page of a site as an entry: a URL meets the lengths that occur, not the entries."""
    rules = spark.range(3000).selectExpr("concat('site.org/p', id) AS rule", "if(id % 2 = 0, 'block', 'allow') AS verdict")
    rows = spark.range(3000).selectExpr("id AS page_id", "concat('http://site.org/p', id, '/x') AS url")
    by_trie, by_joins = (shown(url_filter.with_verdicts(rows, rules, most_entries=m).select("row.page_id", "rule", "verdict")) for m in (10_000, 10))
    assert by_trie == by_joins == [(k, f"site.org/p{k}", "allow" if k % 2 else "block") for k in range(3000)]
