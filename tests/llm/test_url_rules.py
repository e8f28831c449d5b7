import random

import pytest
from tests.llm.conftest import rows_of

from candela.llm import url_rules
from candela.llm.queries import URL_RULES


def plain(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
        m = next((i for i, c in enumerate(rest[n:]) if c in "?#"), len(rest) - n)
        path = rest[n:n + m]
    fits = [(len(h + (p or "")), len(h), v == "block", h + (p or ""), v) for h, p, v in rules if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else default


@pytest.fixture(scope="module")
def urls():
    r = random.Random(4)
    hosts = ["org", "example.org", "a.example.org", "b.a.example.org", "notexample.org", "com", "x.com", "y.x.com", "net", "example.org:80", "EXAMPLE.org", "é.com", "a..com"]
    out = [f"http{'s' * (k % 2)}://{r.choice(hosts)}{r.choice(['', '/', '/es/', '/en/1', '/en/12/x', '/fr/', '/de/9', '/es', '?q=/es/', '#/es/', '/fr/?a#b', '/ü/✓'])}" for k in range(300)]
    return out + [None, "", "no scheme", "://", "a://b://c/d", "http://org\n/x", "http:///es/"] + ["https://hot.example.org/es/1"] * 200


@pytest.mark.parametrize("rules", [URL_RULES, [], [("com", "", "block"), ("x.com", "/", "allow"), ("com", "/es/aa", "allow"), ("x.com", "/es", "block"), ("x.com", "/es", "allow"),
                                                 ("", "/", "block"), (None, "/", "block"), ("Example.org", None, "block"), ("a.example.org", "/en/1", "allow")]])
@pytest.mark.parametrize("sample", [32, 1])
def test_equals_brute_force(spark, urls, rules, sample, monkeypatch):
    monkeypatch.setattr(url_rules, "SAMPLE", sample)
    rows = [(i if i % 50 else None, u, "html") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, URL string").repartition(4)
    pages = pages.toDF("page_id", "url", "URL")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    lower = [(h and h.lower(), p, v) for h, p, v in rules]
    want = sorted(((i, *plain(u, lower)) for i, u, _ in rows), key=repr)
    assert rows_of(url_rules.judge(pages, table)) == want


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(pages, spark.createDataFrame(URL_RULES, "host string, path string, verdict string")).collect() == []
