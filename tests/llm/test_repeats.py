import hashlib
import random
from collections import Counter

import pytest

from terroir.llm import repeats as r

SEED = random.Random(3)


def brute(texts, length):
    """Rows by counting every string of ``length`` bytes."""
    counts = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = len([x for x in bytes(gone).split(b"\0") if x])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        # The text has the characters of which all bytes stay.
        at, text = 0, ""
        for c in b.decode():
            end = at + len(c.encode())
            text += "" if any(gone[at:end]) else c
            at = end
        yield len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest(), text


def noise(n):
    return "".join(SEED.choice("abé ") for _ in range(n))


def corpus():
    shared = [noise(300) for _ in range(6)]
    texts = []
    for _ in range(60):
        text = noise(SEED.randint(0, 150))
        for _ in range(SEED.randint(0, 3)):
            at = SEED.randint(0, 200)
            text += SEED.choice(shared)[at : at + SEED.randint(20, 200)] + SEED.choice(["", "x", "qq"])
        texts.append(text)
    hot = noise(120)
    texts += [noise(40) + hot + noise(40) for _ in range(40)]
    return [*texts, "a" * 200, "a" * 150, "ab" * 100, "", texts[5], texts[5], None, "same end " + texts[7]]


@pytest.mark.parametrize(("length", "group"), [(50, r.GROUP), (50, 3), (64, r.GROUP), (100, 1)])
def test_removal_equals_counting_all_strings(documents, length, group):
    texts = corpus()
    pairs = [(i if i % 9 else None, t) for i, t in enumerate(texts)]
    expected = Counter((d, *x) for (d, _), x in zip(pairs, brute([(t or "").encode() for t in texts], length), strict=True))
    assert Counter(map(tuple, r.removal_report(documents(pairs), length, group).collect())) == expected
    assert any(x[2] for x in expected)


def test_interval_tree_equals_all_substrings():
    for _ in range(200):
        texts = [bytes(SEED.choice(b"ab") for _ in range(SEED.randint(4, 14))) for _ in range(SEED.randint(2, 6))]
        lefts = [SEED.choice([-1, 97, 98]) for _ in texts]
        order, found = r.interval_tree(texts, lefts, 3)
        got = sorted((n, tuple(sorted(order[a : b + 1]))) for n, a, b in found)
        expected = set()
        for prefix in {t[:n] for t in texts for n in range(3, len(t) + 1)}:
            members = [i for i, t in enumerate(texts) if t.startswith(prefix)]
            longest = min(len(texts[i]) for i in members)
            while longest > len(prefix) and len({texts[i][:longest] for i in members}) > 1:
                longest -= 1
            if len(members) > 1 and (len({lefts[i] for i in members}) > 1 or lefts[members[0]] < 0):
                expected.add((longest, tuple(members)))
        assert got == sorted(expected)


def test_groups_list_all_occurrences(documents):
    passage = noise(90)
    docs = documents([noise(50) + passage + noise(50) for _ in range(5)])
    groups = r.Repeats(docs, 50).groups().collect()
    assert any({o["doc_id"] for o in g["occurrences"]} == set(range(5)) for g in groups)
    assert all(g["text"].replace("�", "") in passage + " " or len(g["occurrences"]) < 5 for g in groups)


def test_slabs_do_not_change_anchors(monkeypatch):
    data = (noise(3000) + "c" * 900 + noise(500)).encode()
    whole = r.anchors(data, 100)
    monkeypatch.setattr(r, "SLAB", 177)
    assert r.anchors(data, 100) == whole
    starts = [s for _, _, a, b in whole for s in range(a, b + 1)]
    assert starts == list(range(len(data) - 99))


def test_texts_without_repeats(documents):
    same, own = noise(80), noise(60)
    docs = documents([(1, own + same), (2, same + "z"), (3, None), (None, "é" + same)])
    out = r.without_repeats(docs, 50)
    assert out.columns == docs.columns
    rows = {x["doc_id"]: x for x in out.collect()}
    assert rows[1]["text"] == own and rows[1]["n_chars"] == 60
    assert rows[2]["text"] == "z" and rows[3]["text"] is None and rows[None]["text"] == "é"


def test_a_text_of_rounds_is_few_rows(documents):
    texts = ["spam " * 4000, "one two three " * 900 + "end", "own " + "spam " * 50, "x" * 3000, noise(90)]
    found = r.Repeats(documents(texts), 60)
    assert found.repeated.count() < 20
    assert found.repeated.selectExpr(f"{r.COUNT_SQL} as n").first()["n"] > 4000
    expected = Counter((i, *x) for i, x in enumerate(brute([t.encode() for t in texts], 60)))
    assert Counter(map(tuple, r.removal_report(documents(texts), 60).collect())) == expected
    assert r.without_repeats(documents(texts), 400, words=51).filter("doc_id < 2").agg({"n_chars": "sum"}).first()[0] < 100


def test_empty_table(documents):
    assert r.removal_report(documents([])).collect() == []


def brute_words(texts, words, length):
    """Texts without repeats of ``words`` words, nor of ``length`` bytes, by counting every one of them."""
    split = [[m.span() for m in r._WORD.finditer(t)] for t in texts]
    runs = [[tuple(t[a:b] for a, b in s[i : i + words]) for i in range(len(s) - words + 1)] for t, s in zip(texts, split, strict=True)]
    counts, long = Counter(x for y in runs for x in y), Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    for t, s, own in zip(texts, split, runs, strict=True):
        gone = bytearray(len(t))
        for i in [i for i, x in enumerate(own) if counts[x] > 1]:
            gone[s[i][0] : s[i + words - 1][1]] = b"\1" * (s[i + words - 1][1] - s[i][0])
        for i in range(len(t) - length + 1):
            inside = [1 for a, b in s if a >= i + 4 and b <= i + length - 4]
            if long[t[i : i + length]] > 1 and len(inside) < words:
                gone[i : i + length] = b"\1" * length
        yield "".join(c for c, g in zip(t, gone, strict=True) if not g)


@pytest.mark.parametrize("group", [r.GROUP, 1])
def test_repeats_of_words_equal_counting_all(documents, group):
    def prose(n):
        return SEED.choice([" ", ", ", "\n"]).join("".join(SEED.choice("abcd") for _ in range(SEED.randint(1, 4))) for _ in range(n))

    shared, blob = [prose(30) for _ in range(4)], "".join(SEED.choice("abcdef") for _ in range(90))
    texts = []
    for _ in range(60):
        part = " ".join(SEED.choice(shared).split()[SEED.randint(0, 8) :][: SEED.randint(8, 30)])
        texts.append(f"{prose(SEED.randint(0, 30))} {part}{SEED.choice(['', '.', ' x ', blob])} {prose(SEED.randint(0, 9))}")
    texts += [prose(5) + " 日本語の文章がここにあります。" + prose(3) for _ in range(2)] + ["spam " * 30, ""]
    expected = list(brute_words(texts, 12, 80))
    assert [r for t, r in zip(texts, expected, strict=True) if r != t and len(r) > 20]
    rows = {x["doc_id"]: x["text"] for x in r.without_repeats(documents(texts), 80, group, 12).collect()}
    for i, t in enumerate(texts):
        # The search by bytes may take more of a string it has found, and never anything that occurs once.
        assert len(rows[i]) <= len(expected[i]), (t, rows[i], expected[i])
        assert blob in t or rows[i] == expected[i]
