import random

from riskloom.llm.url_filter import judge_urls

HOSTS = ["example.org", "a.example.org", "EXAMPLE.org", "org", "b.com", "x.b.com", "xb.com", "com", "", "example.org:80", "a..b.com"]


def brute(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(len(h + p), len(h), b, h + p) for h, p, b in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits) if fits else None
    return host, path, best[3] if best else None, ("block" if best[2] else "allow") if best else "allow"


def test_against_every_rule(spark):
    rng = random.Random(2)
    paths = ["", "/", "/a", "/a/b", "/a/bc?x=1#y", "?q", "#f", "/é"]
    urls = [(i, rng.choice(["http://", "https://", "x", "://"]) + rng.choice(HOSTS) + rng.choice(paths)) for i in range(300)]
    urls += [(900 + i, "http://example.org/a/b") for i in range(60)] + [(None, "http://org/"), (1000, None), (1001, ""), (1001, "")]
    rules = [(h.lower(), p, rng.random() < 0.5) for h in HOSTS if h for p in rng.sample(["", "/", "/a", "/a/b"], 2)]
    pages = spark.createDataFrame([(i, u, "x", "x", "x") for i, u in urls], "page_id long, url string, host string, rule string, key string")
    given = spark.createDataFrame(rules + [(None, "/", True), ("org", None, None)], "host string, path string, block boolean")
    for ranges in (1, 5, 40):
        got = judge_urls(pages, given, ranges=ranges).collect()
        assert sorted(map(str, [tuple(r) for r in got])) == sorted(str((i, *brute(u, set(rules)))) for i, u in urls)
    assert judge_urls(pages.limit(0), given).count() == 0
    assert {r["verdict"] for r in judge_urls(pages, given.limit(0)).collect()} == {"allow"}
