from __future__ import annotations

import random

import pytest

from keyfold.llm import url_filter as uf
from keyfold.llm.common import workers_find_package

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("allow", "com/fr/"), ("block", "com/de/"), ("block", "example.org/en/1"),
         ("allow", "a.example.org/es/x/"), ("block", "net"), ("allow", "net"), ("block", "b.net/p")]
URLS = ["http://example.org/es/1", "https://www.EXAMPLE.org/en/12?q#f", "http://example.org/en/2", "http://x.com/fr/", "http://x.com/de/a",
        "http://com/de/", "http://ample.org", "http://a.example.org/es/x/y", "http://b.net/pp", "http://b.net/", None, "", "no scheme",
        "http://", "://", "http:///p", "HTTP://U:P@Example.ORG:80/es/", "a://b://example.org/es/", "http://example.org./es/", "http://org#/es",
        "x\ny://example.org/es/z\nw", "http://example.org/en/1" + "1" * 9000]


def brute(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([i for i in (rest.find(c) for c in "?#") if i >= 0], default=len(rest))]
    best = None
    for verdict, pattern in RULES:
        h, slash, p = pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            best = max(best or ((-1,),), ((len(pattern), len(h), verdict == "block"), pattern, verdict))
    return (host, path, best[1] if best and len(best) > 1 else None, best[2] if best and len(best) > 1 else "allow")


@pytest.fixture(scope="module")
def pages(spark):
    workers_find_package(spark)
    return spark.createDataFrame([(i, u, "r", "v") for i, u in enumerate(URLS + URLS)], "page_id long, url string, rule string, host string")


@pytest.mark.parametrize("limit", [1000, 0])
def test_against_brute_force(pages, limit):
    """By the broadcast trie, and by joins where the rules are too many for it."""
    got = uf.filter_urls(pages, RULES, max_broadcast_rules=limit).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url), r.url


def test_random_rules():
    rng = random.Random(5)
    part = lambda n: "".join(rng.choice("ab/.") for _ in range(rng.randint(0, n)))
    for _ in range(300):
        rules = [(rng.choice(["allow", "block"]), *uf.split_rule(part(4) + "/" + part(5))) for _ in range(6)]
        host, path = part(6).replace("/", "a"), "/" + part(7)
        fits = [((len(h) + len(p), len(h), v == "block"), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert uf.judge(uf.build_trie(rules), host, path) == (max(fits)[1:] if fits else None)


def test_empty(pages):
    assert uf.filter_urls(pages.where("false"), RULES).count() == 0
