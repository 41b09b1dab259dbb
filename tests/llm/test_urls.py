from __future__ import annotations

import random

from devfold.llm import urls

UP = str.maketrans(urls.UPPER, urls.LOWER)


def plain(rows, rules, default="allow"):
    out = []
    for key, url, *_ in rows:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = min((rest.split(c, 1)[0] for c in "/?#"), key=len)
        path = rest[len(host) :]
        path = min((path.split(c, 1)[0] for c in "?#"), key=len)
        host = host.translate(UP)
        fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if h is not None for p in [p or ""] for h in [h.translate(UP)] if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, key=lambda f: (f[0], f[1], f[3] == "block"), default=None)
        out.append(str((key, host, path, best and best[2], best[3] if best else default)))
    return sorted(out)


def frames(spark, rows, rules):
    return spark.createDataFrame(rows, "page_id long, url string, key string, part string"), spark.createDataFrame(rules, "host string, path string, verdict string")


def judged(spark, rows, rules):
    return sorted(str(tuple(r)) for r in urls.judge(*frames(spark, rows, rules)).collect())


def test_random_hosts_and_nested_rules(spark):
    rng = random.Random(4)
    label = lambda: rng.choice(["a", "b", "net", "x-y", "ö", "a.b"])
    path = lambda: rng.choice(["", "/", "/en/", "/en/x", "/en", "/Z?q#f", "/a//b/", "?q=/en/", "#/en/"])
    rules = [(".".join(label() for _ in range(rng.randrange(1, 4))), path().split("?")[0].split("#")[0], rng.choice(["allow", "block"])) for _ in range(60)]
    rules += [(None, "/", "block"), ("net", None, "block"), ("NET", "/En", "allow"), ("", "/", "block")]
    rows = [(i, "http://" + ".".join(rng.choice([label(), label().upper()]) for _ in range(rng.randrange(1, 5))) + path(), "k", "p") for i in range(900)]
    rows += [(i, "https://hot.net/en/x", "k", "p") for i in range(500)] + [(None, "http://net/", "k", "p"), (1, None, "k", "p"), (2, "", "k", "p"), (3, "net/en", "k", "p"), (3, "a://://b", "k", "p"), (4, "http:///en/", "k", "p"), (5, "://" + "a." * 20_000 + "net/x", "k", "p")]
    assert judged(spark, rows, rules) == plain(rows, rules)


def test_parts_of_labels_do_not_fit(spark):
    rows = [(1, "http://notexample.net/en/", "", ""), (2, "http://example.net.evil/en/", "", ""), (3, "http://example.net", "", "")]
    assert [eval(r)[3] for r in judged(spark, rows, [("example.net", "/", "block")])] == [None, None, None]


def test_empty(spark):
    assert judged(spark, [], [("net", "/", "block")]) == []
    assert judged(spark, [(1, "http://a.net/", "", "")], []) == ["(1, 'a.net', '/', None, 'allow')"]
