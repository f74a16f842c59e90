import random
import re

import pytest

from ledgerloom.llm import url_rules
from ledgerloom.llm.url_rules import ALLOW, BLOCK, PATTERNS, pattern_rule, site_rule

SITES = (
    site_rule(ALLOW, "org", "/"),
    site_rule(BLOCK, "example.org", "/es/"),
    site_rule(BLOCK, "example.org", "/en/1"),
    site_rule(ALLOW, "com", "/fr/"),
    site_rule(BLOCK, "com", "/de/"),
)

URLS = [
    None, "", "no scheme", "http://", "://org/", "http://org", "http://org/", "HTTP://WWW.Example.ORG/es/1", "http://example.org/ES/1",
    "http://example.org/en/123?x=1", "http://example.org/en/?1", "http://notexample.org/en/1", "http://a.com/fr/#top",
    "http://com/de/", "http://xcom/de/", "http://www.cheap-pills.example.net/en/1", "http://x.net/a?u=http://org/es/",
    "http://a.net/login", "http://a.net/login/", "http://a.net/logins", "http://a.net/x?replytocom=3", "http://shop.gov/cart",
    "http://casino-royal.example.net/", "http://fan-casino.net:80/x", "http://a.net/casino-fire", "http://org:80/", "http://u@org/",
    "http://ÄÖ.example.org/es/ü\n", "http://a.net/\x00/login\n", "a://b://org/es/", "http://a.net/" + "x/" * 50_000 + "login",
]


def brute(url, sites=SITES, patterns=tuple(map(pattern_rule, PATTERNS))):
    host = path = query = ""
    if "://" in (url or ""):
        rest = url.split("://", 1)[1]
        host, tail = re.fullmatch(r"([^/?#]*)(.*)", rest, re.S).groups()
        path, query = re.fullmatch(r"([^?#]*)(.*)", tail, re.S).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule in sites:
        site, start = rule.name.split("/", 1)
        if (host == site or host.endswith("." + site)) and path.startswith("/" + start):
            fits.append((len(rule.name), rule))
    if fits:
        rule = max(fits, key=lambda fit: fit[0])[1]
        return host, path, rule.name, None, rule.verdict
    hits = [r for r in patterns if (host or path) and re.search(r.regex(), f"//{host}/" if r.host_only else f"//{host}{path}{query}")]
    if hits:
        rule = max(hits, key=lambda r: (r.kind, len(r.name), -patterns.index(r)))
        return host, path, None, rule.name, rule.verdict
    return host, path, None, None, ALLOW


def in_order(found):
    return sorted(found, key=repr)


def rows(frame):
    return in_order((str(r.page_id), r.host, r.path, r.rule, r.pattern, r.verdict) for r in frame.collect())


@pytest.fixture(scope="module")
def pages(spark):
    def build(urls):
        ids = [None if i % 7 == 3 else i // 2 for i in range(len(urls))]
        columns = "page_id long, url string, host string, `a.b` int, kind string, id string"
        return spark.createDataFrame([(i, u, "h", 1, "k", "i") for i, u in zip(ids, urls)], columns), ids

    return build


def test_equals_all_rules_on_every_url(pages):
    frame, ids = pages(URLS + URLS[5:9])
    expected = in_order((str(i), *brute(u)) for i, u in zip(ids, URLS + URLS[5:9]))
    assert rows(url_rules.judge_urls(frame, SITES)) == expected


def test_shards_change_nothing(pages):
    frame, _ = pages(URLS)
    whole = rows(url_rules.judge_urls(frame, SITES))
    assert rows(url_rules.judge_urls(frame, SITES, shard_chars=40)) == whole
    assert len(url_rules.in_shards([*SITES, *map(pattern_rule, PATTERNS)], 40)) > 5


def test_random_rules_and_urls(pages):
    chance = random.Random(3)
    words = ["a", "b1", "ads", "Img", "é", "x_y", "%20"]

    def text(n):
        return "".join(chance.choice(words) + chance.choice(["/", ".", "-", "?", "=", "", "&"]) for _ in range(n))

    patterns = []
    for _ in range(60):
        body = "".join(chance.choice([*words, "*", "^", "/", ".", "-"]) for _ in range(chance.randint(1, 5)))
        body = chance.choice(["", "||", "@@"]) + body + chance.choice(["", "|", "$host"])
        patterns.append(pattern_rule(body))
    urls = [f"http://{text(2)}{chance.choice(['/', '?', ''])}{text(4)}" for _ in range(300)]
    frame, ids = pages(urls)
    got = rows(url_rules.judge_urls(frame, SITES, patterns, shard_chars=250))
    assert got == in_order((str(i), *brute(u, SITES, tuple(patterns))) for i, u in zip(ids, urls))
    assert len({row[-2] for row in got}) > 8


def test_literal_tokens_and_the_rarest():
    assert pattern_rule("||ads-*banner.").literal_tokens() == {"ads"}
    assert pattern_rule("track").literal_tokens() == set()
    assert pattern_rule("/track|").literal_tokens() == {"track"}
    assert site_rule(BLOCK, "example.org", "/en/1").literal_tokens() == {"example", "org", "en"}
    assert url_rules.rarest_token(SITES[2], {"example": 9, "org": 3, "en": 3}) == "org"
    assert url_rules.rarest_token(pattern_rule("track"), {}) is None


def test_only_fetched_rules_run(monkeypatch):
    index = url_rules.Index([(0, SITES[0], "org"), (1, SITES[3], "fr"), (2, pattern_rule("track"), None)])
    assert index.best("a.org", "/x", "") is SITES[0]
    assert sorted(index.compiled) == [0, 2]


def test_token_counts(spark, pages):
    frame, _ = pages(["http://a.org/b", "http://a.org/a", None, "b.org"])
    parts = frame.select("page_id", "url").mapInArrow(url_rules._split, "id long, host string, path string, query string")
    assert url_rules.token_counts(parts, [{"org", "b"}, {"zzz"}]) == {"org": 2, "b": 1}


def test_empty_table(pages):
    frame, _ = pages(URLS[:1])
    assert url_rules.judge_urls(frame.limit(0), SITES).collect() == []
    assert url_rules.judge_urls(frame, [], []).first().verdict == ALLOW
