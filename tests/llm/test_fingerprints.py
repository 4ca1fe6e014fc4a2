import hashlib
import random

from terroir.llm import fingerprints as f

SEED = random.Random(5)


def prose(n):
    return " ".join("".join(SEED.choice("abcdeé") for _ in range(SEED.randint(2, 9))) for _ in range(n))


def plain_ends(data):
    """Chunk ends by a byte-at-a-time gear hash."""
    ends, start = [], 0
    hashes, h = [], 0
    for b in data:
        h = ((h << 1) + int(f.GEAR[b])) & 0xFFFFFFFF
        hashes.append(h)
    while start < len(data):
        end = min(len(data), start + f.MAX_SIZE)
        for i in range(start + f.MIN_SIZE, min(len(data), start + f.MAX_SIZE)):
            bits = f.STRICT_BITS if i < start + f.NORMAL_SIZE else f.LOOSE_BITS
            if hashes[i - 1] >> (32 - bits) == 0:
                end = i
                break
        ends.append(end)
        start = end
    return ends


def test_chunks_are_those_of_a_plain_gear_hash():
    for n in (0, 1, 5, 60, 700, 3000):
        data = prose(n).encode()
        assert f.chunk_ends(data) == plain_ends(data)


def test_slabs_do_not_change_chunks(monkeypatch):
    data = prose(900).encode()
    whole = f.chunk_ends(data)
    monkeypatch.setattr(f, "SLAB", 100)
    assert f.chunk_ends(data) == whole


def test_insertions_shift_few_chunks():
    text = prose(1500)
    a, b = f.chunk_set(text.encode()), f.chunk_set(("few words " + text).encode())
    assert f.likeness(a, b) > 0.95
    assert f.likeness(a, f.chunk_set(prose(1500).encode())) < 0.1
    assert f.likeness({}, {}) == 1.0 and f.likeness(a, {}) == 0.0


def brute(pairs):
    ordered = sorted(pairs, key=lambda p: (p[0] is None, -(p[0] or 0), p[1] or ""))
    out = {}
    for i, (doc, text) in enumerate(ordered):
        text, following = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        cut = len(text) // 3
        edited = (text[: len(text) - cut] + following[:cut]).encode()
        a = f.chunk_set(text.encode())
        out.setdefault(doc, []).append(
            (
                len(text), hashlib.sha256(edited).hexdigest(), f.fingerprint(a), f.fingerprint(f.chunk_set(edited)),
                f.likeness(a, f.chunk_set(edited)), f.likeness(a, f.chunk_set(following.encode())),
            )
        )
    return {k: sorted(v) for k, v in out.items()}


def test_neighbours_across_ranges(documents):
    pairs = [(i * 7, prose(SEED.randint(0, 80))) for i in range(60)]
    pairs += [(None, "no id"), (None, None), (21, pairs[3][1]), (21, "another text"), (-5, ""), (2**60, prose(3000))]
    for parts in (1, 3, 40):
        rows = f.fingerprint_documents(documents(pairs), parts).collect()
        got = {}
        for r in rows:
            got.setdefault(r["doc_id"], []).append(tuple(r)[1:])
        assert {k: sorted(v) for k, v in got.items()} == brute(pairs)


def test_single_and_empty_tables(documents):
    row = f.fingerprint_documents(documents(["abc def ghi"])).first()
    assert row["near_next"] == 1.0
    assert f.fingerprint_documents(documents([])).collect() == []
