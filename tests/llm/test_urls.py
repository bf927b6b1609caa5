"""URL verdicts against plain Python, both ways of looking rules up, and odd rows."""

import random
import re

import pytest
from corpus_fixtures import SMALL

from tidemark.llm import urls
from tidemark.llm.queries import SITE_RULES

PAGE = "page_id long, url string, html string, host string, path string, rule string, verdict string, token string, _best long, _address string, _site string"


@pytest.fixture(scope="module")
def pages(spark):
    return lambda *rows: spark.createDataFrame([(i, u, None, "h", "p", "r", "v", "t", 1, "a", "s") for i, u in rows], PAGE)


def split(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return low, re.match(r"[^?#]*", rest[len(host) :]).group(), low + rest[len(host) :]


def site_fits(rule, host, path):
    want, slash, tail = rule.partition("/")
    want = want.lower()
    return (host == want or host.endswith("." + want)) and path.startswith(slash + tail)


def pattern_regex(rule):
    start, end, body = "", "", rule
    if body.startswith("||"):
        start, body = urls.LABEL_START, body[2:]
    elif body.startswith("|"):
        start, body = "^", body[1:]
    if body.endswith("|"):
        end, body = r"\Z", body[:-1]
    parts = {"*": ".*", "^": r"(?:[^A-Za-z0-9_.%-]|\A|\Z)"}
    return re.compile(start + "".join(parts.get(c, re.escape(c)) for c in body) + end, re.S | re.I)


def brute(rows, sites, patterns, default="allow"):
    out = []
    for i, u in rows:
        host, path, address = split(u)
        fit = [(len(r), v, r) for r, v in sites if site_fits(r, host, path)]
        if fit:
            _, verdict, rule = max(fit)
            out.append((i, host, path, rule, verdict, None))
            continue
        fit = [(v == "allow", v, r) for r, v in patterns if pattern_regex(r).search(address)]
        best = max(fit) if fit else (None, default, None)
        out.append((i, host, path, None, best[1], best[2]))
    return out


ODD = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://a.com"), (6, "http://a.com/"), (6, "http://a.com/"), (None, "http://a.net/es/x"),
    (7, "HTTP://WWW.Example.COM/en/1"), (8, "http://example.com/EN/1"), (9, "http://notexample.com/en/1"), (10, "x://y://z.net/fr/"),
    (11, "http://u@a.com:80/x"), (12, "http://a.net?u=/es/"), (13, "http://a.net#/es/"), (14, "http://a.org/Doorway/é/x.HTML"),
    (15, "http://cheap-pills.example.org/?a"), (16, "http://mcheap-pills.example.org/"), (17, "http://a.org/click-farm"), (18, "http://a.org/click-farms"),
    (19, "http://" + "a-b." * 100_000 + "org/"), (20, "http://a.org/x\n/adserver/"), (21, "http://free-bets.com.org/"),
]
PATTERNS = [(p, "block") for p in urls.BLOCK_PATTERNS] + [("||good.cheap-pills.", "allow"), ("|a.org/kept", "allow"), ("*", "block")]


def key(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("index_bytes", [urls.INDEX_BYTES, 0])
def test_odd_urls_both_ways(spark, pages, index_bytes):
    for patterns in (PATTERNS[:-1], PATTERNS, []):
        rules = urls.rules_table(spark, SITE_RULES, patterns)
        got = urls.judge(pages(*ODD), rules, index_bytes=index_bytes)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
        assert key(got.collect()) == key(brute(ODD, SITE_RULES, patterns))


def test_random_rules(spark, pages):
    rng = random.Random(3)
    word = lambda: rng.choice(["a", "b", "ab", "ba", "com", "net", "x1"])
    rows = [(i, "http://" + ".".join(word() for _ in range(rng.randint(1, 3))) + "".join("/" + word() for _ in range(rng.randint(0, 3)))) for i in range(300)]
    sites = {(".".join(word() for _ in range(rng.randint(1, 2))) + rng.choice(["", "/", f"/{word()}", f"/{word()}/"])): rng.choice(["allow", "block"]) for _ in range(40)}
    bits = ["*", "^", "|", ".", "/", "-", "a", "b", "ab", "com"]
    patterns = {"".join(rng.choice(bits) for _ in range(rng.randint(2, 6))): rng.choice(["allow", "block"]) for _ in range(60)}
    patterns = {p: v for p, v in patterns.items() if p.strip("|")}
    rules = urls.rules_table(spark, sites.items(), patterns.items())
    want = key(brute(rows, sites.items(), patterns.items()))
    assert key(urls.judge(pages(*rows), rules).collect()) == want
    assert key(urls.judge(pages(*rows), rules, index_bytes=0).collect()) == want


def test_rule_is_indexed_by_its_rarest_token(spark, pages):
    rows = [(i, f"http://www.example.com/en/{i}") for i in range(20)] + [(99, "http://www.other.org/fr/")]
    address = pages(*rows).select(urls.F.substring("url", 8, 1000).alias("_address"))
    rules = urls.rules_table(spark, [("www.example.com/fr/", "block"), ("com/", "allow")], [("ad*", "block")])
    assert {r["rule"]: r["token"] for r in urls.rule_index(address, rules).collect()} == {"www.example.com/fr/": "fr", "com/": "com", "ad*": ""}


def test_no_rules_no_pages_and_plan(spark, pages):
    none = urls.rules_table(spark)
    assert [r["verdict"] for r in urls.judge(pages((1, "http://a.com/")), none, default="block").collect()] == ["block"]
    rules = urls.rules_table(spark, SITE_RULES, PATTERNS)
    assert urls.judge(pages().where("false"), rules).count() == 0
    assert urls.judge(pages().where("false"), rules, index_bytes=0).count() == 0
    table = spark.read.parquet(f"{SMALL}/pages.parquet")
    plan = urls.judge(table, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan and "html:string" not in plan
