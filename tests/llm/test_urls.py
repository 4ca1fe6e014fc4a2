import json
from itertools import combinations

from terroir.llm import urls as u
from terroir.llm.queries import URL_RULES

PAGES = "page_id long, url string, host string, verdict string, label string"
LABELS = "url string, label string"


def judged(spark, pages, labels, **options):
    frame = spark.createDataFrame([(i, x, "x", "x", "x") for i, x in pages], PAGES)
    labelled = spark.createDataFrame(labels, LABELS)
    return u.judge(frame, labelled, URL_RULES, **options)


def test_hosts_paths_and_rules(spark):
    cases = {
        "http://Blog.Example.NET/en/1?q#f": ("blog.example.net", "/en/1", "example.net/en/", "allow"),
        "http://example.net/EN/": ("example.net", "/EN/", "net/", "block"),
        "https://a.net": ("a.net", "", None, "allow"),
        "https://notexample.net/en/": ("notexample.net", "/en/", "net/", "block"),
        "x://example.com/de/9": ("example.com", "/de/9", "example.com/de/", "block"),
        "x://anexample.com/de/9": ("anexample.com", "/de/9", None, "allow"),
        "http://a.org/fr/x": ("a.org", "/fr/x", "org/fr/", "allow"),
        "http://ÀB.org?x=http://b.net/": ("Àb.org", "", None, "allow"),
        "http:///p://q": ("", "/p://q", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "http://a.net:80/x": ("a.net:80", "/x", None, "allow"),
        "http://a.net\n/x": ("a.net\n", "/x", None, "allow"),
        "http://long.net/" + "y" * 100_000: ("long.net", "/" + "y" * 100_000, "net/", "block"),
    }
    pages = [(i, url) for i, url in enumerate(cases)] + [(None, "http://a.net/"), (None, "http://a.net/")]
    rows = judged(spark, pages, []).collect()
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows if r["page_id"] is not None}
    assert got == dict(enumerate(cases.values()))
    assert len(rows) == len(pages)


def brute_rules(labelled, min_support, min_confidence, min_urls):
    sets = [frozenset(json.loads(t)) for t, _ in labelled]
    out = {}
    for size in (1, 2, 3, 4, 5):
        for found in {frozenset(c) for s in sets for c in combinations(sorted(s), size)}:
            n = sum(found <= s for s in sets)
            for label in {x for _, x in labelled}:
                both = sum(found <= s and x == label for s, (_, x) in zip(sets, labelled, strict=True))
                if both >= min_urls and both / len(sets) >= min_support and both / n >= min_confidence:
                    out[found, label] = both / n
    return {
        key: c for key, c in out.items() if not any((key[0] - {t}, key[1]) in out and out[key[0] - {t}, key[1]] >= c for t in key[0])
    }


def test_mined_rules_equal_counting(spark):
    hosts = ["spam.com", "good.com", "mixed.com", "spam.org"]
    labels = []
    for i in range(120):
        host, word = hosts[i % 4], "win" if i % 3 else "news"
        bad = host.startswith("spam") or (host == "mixed.com" and word == "win")
        labels.append((f"http://{host}/{word}/{i}", ("block" if bad else "allow") if i % 10 else None))
    frame = spark.createDataFrame(labels, LABELS)
    rules = u.mined_rules(frame, 0.05, 0.7, 5).collect()
    tokens = u.with_tokens(u.parsed(frame.filter("label is not null"))).selectExpr("to_json(tokens) t", "label").collect()
    expected = brute_rules([(r["t"], r["label"]) for r in tokens], 0.05, 0.7, 5)
    got = {(frozenset(r["tokens"]), r["label"]): r["confidence"] for r in rules}
    assert got.keys() == expected.keys() and all(abs(got[k] - expected[k]) < 1e-9 for k in got)
    pages = [(1, "http://spam.com/other"), (2, "http://mixed.com/win/77"), (3, "http://mixed.com/news/1"), (4, "http://new.info/")]
    rows = judged(spark, pages, labels, min_support=0.05, min_confidence=0.7, min_urls=5).collect()
    assert {r["page_id"]: r["verdict"] for r in rows} == {1: "block", 2: "block", 3: "allow", 4: "allow"}
    assert {r["page_id"]: r["mined"] is None for r in rows}[4]


def test_rules_that_restate_the_base_rate_are_dropped(spark):
    """Three quarters of all hosts' URLs are allowed, one host's are not: only its rule says something."""
    named = [(f"http://{'abcdefgh'[i % 8] * 3}.com/p/{i}", "block" if i // 8 % 4 == 0 else "allow") for i in range(800)]
    named += [(f"http://casino.com/p/{i}", "block") for i in range(60)]
    rules = u.mined_rules(spark.createDataFrame(named, LABELS), 0.001, 0.6, 10, 1.1, 2.75).collect()
    assert {(tuple(r["tokens"]), r["label"]) for r in rules} == {(("host:casino",), "block")}
    pages = [(1, "http://casino.com/x"), (2, "http://aaa.com/p/1"), (3, "http://new.info/")]
    rows = {r["page_id"]: (r["verdict"], r["mined"]) for r in judged(spark, pages, named).collect()}
    assert rows == {1: ("block", '["host:casino"]'), 2: ("allow", None), 3: ("allow", None)}
    alike = spark.createDataFrame([("http://a.com/x", "allow")] * 30, LABELS)
    assert u.mined_rules(alike, 0.001, 0.6, 10, 1.1, 2.75).collect() == []


def test_no_pages(spark):
    assert judged(spark, [], [("http://a.com/", "block")]).collect() == []
