import zlib
from collections import Counter, defaultdict

import pytest

from terroir.llm.sharding import shard_documents


def check(rows, pairs, shards):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in pairs
    )
    counts = Counter(r["shard"] for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert set(counts) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert {r["law"] for r in rows} <= {"rows"} and all(r["grown_shard"] is None for r in rows)


def test_groups_stay_together(documents):
    pairs = [(i, f"text {i // 3}") for i in range(180)] + [(1000 + i, f"alone {i} é") for i in range(117)]
    rows = shard_documents(documents(pairs), 6).collect()
    check(rows, pairs, 6)
    homes = defaultdict(set)
    for r in rows:
        if r["doc_id"] < 180:
            homes[r["doc_id"] // 3].add(r["shard"])
    assert sum(len(h) == 1 for h in homes.values()) >= 58


@pytest.mark.parametrize("rounds", [1, 5])
def test_a_group_larger_than_shards(documents, rounds):
    pairs = [(i, "the same" if i % 2 else f"pair {i // 4}") for i in range(200)]
    pairs += [(None, None), (None, ""), (7, "the same"), (7, "the same")]
    check(shard_documents(documents(pairs), 8, rounds).collect(), pairs, 8)


def test_few_or_no_rows(documents):
    check(shard_documents(documents(["a", "a", "b"]), 24).collect(), [(0, "a"), (1, "a"), (2, "b")], 24)
    assert shard_documents(documents([]), 24).collect() == []
