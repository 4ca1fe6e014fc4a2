import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from terroir.llm import ranking
from terroir.llm.queries import RANKING_SQL

RANDOM = random.Random(5)
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORDS = [f"w{i}" for i in range(60)] + ["Élan", "élan", "naïve", "12", "x y", "ΑΒ"]


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(doc, Counter(split(text))) for doc, text in docs]
    counted = [(doc, c) for doc, c in counted if c]
    n_docs, n_terms = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    terms = {}
    for item, text in items:
        terms.setdefault(item, set()).update(split(text))
    out = []
    for item, own in terms.items():
        scored = []
        for doc, c in counted:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in own if t in c
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        out += [(item, r, doc, -s) for r, (s, _, doc) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def corpus(n):
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    return [(i, " ".join(RANDOM.choices(WORDS, weights, k=RANDOM.randint(0, 60)))) for i in range(n)]


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame([(*r, "x", 1) for r in rows], "item_id long, text string, term string, block int")

    return make


@pytest.mark.parametrize("block", [30, 100_000])
def test_against_brute_force(documents, items, monkeypatch, block):
    monkeypatch.setattr(ranking, "BLOCK_CHARACTERS", block)
    docs = corpus(300)
    docs += [(1000 + i, docs[7][1] + " w3 W59, Élan!") for i in range(40)]  # ties across blocks
    docs += [(None, "w1 w2"), (None, None), (5000, ""), (5001, None), (5002, "., -"), (3, "w1 w59"), (3, "w1 w59")]
    docs += [(6000, "long " * 200_000 + "w59")]
    asked = [(i, " ".join(RANDOM.sample(WORDS, RANDOM.randint(1, 20)))) for i in range(30)]
    asked += [(100, None), (101, ""), (102, "nowhere"), (None, "w1"), (103, "w1"), (103, "w2"), (104, docs[7][1] + " w3 w59 élan")]
    got = found(ranking.search(ranking.index(documents(docs)), items(asked), 10))
    assert got == brute(docs, asked, 10)


def test_groups_of_items_and_short_lists(documents, items, monkeypatch):
    monkeypatch.setattr(ranking, "GROUP_ITEMS", 3)
    docs, asked = corpus(50), [(i, " ".join(RANDOM.sample(WORDS, 5))) for i in range(20)]
    assert found(ranking.search(ranking.index(documents(docs)), items(asked), 3)) == brute(docs, asked, 3)


def test_empty_tables(documents, items):
    some, none = documents([("a")]), documents([])
    for docs, asked in ((none, [(1, "a")]), (some, []), (some, [(1, None)]), (documents([None, ""]), [(1, "a")])):
        assert found(ranking.search(ranking.index(docs), items(asked), 10)) == []


def cell(n=400, terms=12):
    lists = []
    for t in range(terms):
        places = np.array(sorted(RANDOM.sample(range(n), RANDOM.randint(1, n))))
        lists.append(([0], RANDOM.randint(-50, 3000), places, np.array([RANDOM.randint(1, 9) for _ in places], np.int32)))
    lists[0] = ([0], 1, lists[0][2], lists[0][3])
    return ranking.Cell(list(range(n)), np.full(n, 50), [(o, abs(w), p, c) for o, w, p, c in lists], 1000, 50_000)


def test_range_maxima():
    c = cell()
    for _ in range(300):
        i = RANDOM.randrange(len(c.starts))
        a, b = sorted(RANDOM.randint(c.starts[i], c.ends[i]) for _ in range(2))
        expected = c.table[0][a:b].max() if b > a else -1
        assert c.maxima(np.array([a]), np.array([b]))[0] == expected


def test_few_documents_are_scored():
    """One document with far greater impacts is found without looking at most others."""
    n = 4000
    places = np.arange(n)
    counts = np.ones(n, np.int32)
    counts[1234] = 500
    c = ranking.Cell(list(range(n)), np.full(n, 50), [([0], 1000, places, counts) for _ in range(5)], 4000, 200_000)
    looked = []
    inner = c.maxima
    c.maxima = lambda a, b: looked.append(len(a)) or inner(a, b)
    assert c.search(0, 1, 0, None)[0][1] == 1234
    assert sum(looked) < 100


def test_statement(spark, duck, sf):
    docs, asked = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = found(ranking.search(ranking.index(docs), asked, 10))
    assert got == sorted(duck.execute(RANKING_SQL).fetchall(), key=str) and got
