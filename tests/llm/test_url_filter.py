from __future__ import annotations

import random

from tally.llm import url_filter as U


def brute(url, rules, default="allow"):
    host, path = "", ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    return host, path, max(fits)[2], max(fits)[3]


def test_urls_equal_brute_force(spark):
    rng = random.Random(3)
    hosts = ["example.com", "WWW.Example.com", "a.b.net", "net", "x.org", "", "com", "examplexcom", "É.com", "net."]
    paths = ["", "/", "/en/", "/en/1", "/es/2", "/fr/", "/EN/", "/en", "?q=/en/", "#/en/", "/fr/?a://b"]
    rows = [(i, f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}", "h") for i in range(400)]
    rows += [(900, None, "h"), (901, "", "h"), (902, "no scheme/en/", "h"), (None, "http://net/es/", "h"),
             (903, "http://example.com/en/" + "x" * 100_000, None), (903, "http://net/fr/", "h"), (903, "http://net/fr/", "h")]
    got = U.filter_urls(spark.createDataFrame(rows, "page_id bigint, url string, host string")).collect()
    want = sorted(((i, *brute(u, U.RULES)) for i, u, _ in rows), key=repr)
    assert sorted((tuple(r) for r in got), key=repr) == want


def test_digest_collisions_are_confirmed(monkeypatch):
    monkeypatch.setattr(U.xxhash, "xxh64_intdigest", lambda b: len(b) % 3)
    rules = [(f"h{i}.com", f"/{'p' * (i % 5)}", "block" if i % 2 else "allow") for i in range(40)]
    import numpy as np
    array = U.DigestArray(np.frombuffer(U.DigestArray.pack(rules), dtype=np.uint8))
    urls = [f"http://{'s.' * (i % 2)}h{i}.com/{'p' * (i % 7)}" for i in range(50)]
    assert array.judge(urls, "allow") == [brute(u, rules) for u in urls]


def test_no_rules_and_empty_table(spark):
    empty = spark.createDataFrame([], "page_id bigint, url string")
    assert U.filter_urls(empty).count() == 0
    one = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    assert [tuple(r) for r in U.filter_urls(one, rules=()).collect()] == [(1, "a.com", "/", None, "allow")]


def test_hosts_of_very_many_labels_take_little_memory():
    import tracemalloc

    import numpy as np
    array = U.DigestArray(np.frombuffer(U.DigestArray.pack(U.RULES), dtype=np.uint8))
    urls = ["http://" + "a." * 100_000 + "www.example.com/en/1", "http://" + "a." * 100_000 + "net", "http://" + "." * 50_000,
            "http://..net/es/", "http://net./es/", "http://.example.com./en/"]
    tracemalloc.start()
    got = array.judge(urls, "allow")
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == [brute(u, U.RULES) for u in urls] and most < 10_000_000
