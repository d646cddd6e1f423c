import pytest

from visitledger.llm import urls

RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"),
         ("org", "/pre", "block"), ("org", "/pre", "allow"), ("", "", "block"), (None, "/", "block"), ("Deep.ORG", "/a/b/c/", "allow")]
URLS = [None, "", "no scheme", "http://", "http://a.com", "http://a.com/", "HTTPS://WWW.Example.COM/en/x?q=/es/", "http://example.com/en",
        "http://example.com/en/", "http://xexample.com/en/", "http://b.example.com/en/#f", "x://user@n.net:80/es/", "http://n.net/es/1",
        "http://n.net?/es/", "http://q.org/prefix", "http://q.org/pr", "http://x.deep.org/a/b/c/d/e", "http://com/a://b", "http://a..com/",
        "http://" + "a." * 50 + "com/" + "s/" * 300]


def brute(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url[url.index("://") + 3:]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = []
    if url and "://" in url:
        for h, p, v in rules:
            if h is not None and (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p):
                fits.append((len(h + p), v == "block", h.lower() + p, v))
    best = max(fits, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(i, u, "kept", "kept") for i, u in enumerate(URLS)] + [(0, URLS[5], "kept", "kept"), (0, URLS[6], None, None)]
    return spark.createDataFrame(rows, "page_id long, url string, judged string, short string")


def test_judge(spark, pages):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    for used, listed in ((RULES, rules), ([], rules.limit(0))):
        found = urls.judge(pages, listed)
        assert found.columns == [*pages.columns, "judged_"]
        got = sorted(((r.page_id, r.url, *r.judged_) for r in found.collect()), key=repr)
        assert got == sorted(((r.page_id, r.url, *brute(r.url, used)) for r in pages.collect()), key=repr)


def test_empty(spark, pages):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert urls.judge(pages.limit(0), rules).count() == 0
