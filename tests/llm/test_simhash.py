import random
import re

import numpy as np
import pytest
import xxhash

from terroir.llm import simhash as s
from terroir.llm.components import components

SEED = random.Random(6)


def plain_fingerprint(text, words=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(keys, near):
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if near(keys[i], keys[j]):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(keys))]


def prose(n):
    return " ".join("".join(SEED.choice("abcdÉé\x1c") for _ in range(SEED.randint(1, 5))) for _ in range(n))


def near_copies():
    base = [prose(SEED.randint(200, 400)) for _ in range(8)]
    texts = []
    for text in base:
        texts.append(text)
        for _ in range(5):
            words = text.split(" ")
            for _ in range(SEED.randint(0, 4)):
                words[SEED.randrange(len(words))] = "new"
            texts.append(" ".join(words))
    pairs = list(enumerate(texts + ["", " \t\n", None, "A b", "a  B", "one two three four", "x\x0by"]))
    return pairs + [(None, texts[0]), (3, texts[3]), (None, "lonely words"), (100, texts[6])]


def test_fingerprints():
    for n in (0, 1, 3, 4, 5, 50):
        text = prose(n)
        assert s.fingerprint(text) == plain_fingerprint(text)
    text = prose(300) + " A\u00a0B\u2003C İ"
    assert s.fingerprint(text) == plain_fingerprint(text)


def test_long_texts_in_slabs(monkeypatch):
    text = prose(500)
    monkeypatch.setattr(s, "SLAB", 64)
    assert s.fingerprint(text) == plain_fingerprint(text)


def test_components_equal_brute_force(documents):
    pairs = near_copies()
    prints = [plain_fingerprint(t) for _, t in pairs]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (doc, _), root in zip(pairs, roots, strict=True):
        least[root] = min((x for x in (least.get(root), doc) if x is not None), default=None)
    expected = [(d, f"{p:016x}", least[r]) for (d, _), p, r in zip(pairs, prints, roots, strict=True)]
    rows = s.near_duplicates(documents(pairs)).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)


def test_one_row_of_each_component_stays(documents):
    pairs = near_copies()
    prints = [plain_fingerprint(t) for _, t in pairs]
    roots = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= 4)
    docs = documents(pairs)
    out = s.without_near_duplicates(docs)
    rows = out.collect()
    assert out.columns == docs.columns and len(rows) == len(set(roots))
    first = {}
    for (doc, _), root in zip(pairs, roots, strict=True):
        first[root] = min(first.get(root, 1 << 60), 1 << 59 if doc is None else doc)
    assert sorted(1 << 59 if r["doc_id"] is None else r["doc_id"] for r in rows) == sorted(first.values())


@pytest.mark.parametrize("distance", [2, 4])
def test_ball_hashing_loses_no_link(spark, distance):
    base = [SEED.getrandbits(64) for _ in range(30)]
    prints = set(base)
    for b in base:
        for _ in range(8):
            prints.add(b ^ sum(1 << i for i in SEED.sample(range(64), SEED.randint(1, 6))))
    prints = sorted(prints)
    frame = spark.createDataFrame([(s.signed(p),) for p in prints], "fp long").repartition(4)
    links = s.near_links(frame, distance)
    unsigned = lambda x: x & (1 << 64) - 1
    pairs = [(unsigned(r["a"]), unsigned(r["b"])) for r in links.collect()]
    assert all(0 < (a ^ b).bit_count() <= distance for a, b in pairs)
    expected = brute_components(prints, lambda a, b: (a ^ b).bit_count() <= distance)
    joined = set(pairs) | {(b, a) for a, b in pairs}
    got = brute_components(prints, lambda a, b: (a, b) in joined)
    assert len(set(zip(got, expected, strict=True))) == len(set(expected)) == len(set(got))


def test_all_variants_are_listed():
    assert len(s.masks(64, 2)) == 1 + 64 + 64 * 63 // 2 and len(set(s.masks(16, 2).tolist())) == 137
    assert max(np.bitwise_count(s.masks(48, 2))) == 2


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (2, 1), (-7, 2000)], "a long, b long")
    rows = {r["node"]: r["root"] for r in components(edges, "test").collect()}
    assert rows == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)} | {2000: -7}


def test_empty_table(documents):
    assert s.near_duplicates(documents([])).collect() == []
    assert s.without_near_duplicates(documents([])).collect() == []
