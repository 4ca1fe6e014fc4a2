import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from terroir.llm import prefixes
from terroir.llm.queries import CONVERSATIONS_SQL

SCHEMA = "conv_id long, turn long, role string, text string, key string, pos long, seg long, part int"
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
RANDOM = random.Random(3)


def rebuilt(rows):
    """Sequences of (role, text) by conversation, by the contract's words."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turn_key = (turn is not None, turn or 0)
            role, text = role or "", text or ""
            size = len(text.encode())
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append((turn_key, digest, size, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (c % 5 if c >= 0 else -(-c % 5))
        out[c] = tuple(own.get(base, [])[:h] + turns[h:])
    return out


def brute(sequences):
    members = defaultdict(list)
    for c, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    rows = []
    for node, inside in members.items():
        below = [x for x in members if x[: len(node)] == node]
        children = [x for x in below if len(x) == len(node) + 1]
        leaves = [x for x in below if not any(len(y) == len(x) + 1 and y[: len(x)] == x for y in below)]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        ends = ",".join(str(c) for c in sorted(inside) if sequences[c] == node)
        rows.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside), len(children), len(leaves),
            saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(rows, key=str)


def made(spark, rows, partitions=3):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA).repartition(partitions)


def found(df):
    return sorted((tuple(r[c] for c in RESULT) for r in df.collect()), key=str)


def sample():
    rows = []
    for c in range(40):
        for t in range(RANDOM.randint(0, 12)):
            rows.append((c, t, RANDOM.choice(["user", "bot", None]), RANDOM.choice(["a", "é", "bb", "", None])))
    rows += [(c, t, "user", "same") for c in range(100, 130) for t in range(6)]
    rows += [(7, None, "user", "first"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (None, 1, "user", "nobody"), (-3, 0, "a", "b")]
    return rows


def test_against_brute_force(spark):
    rows = sample()
    assert found(prefixes.rebuilt_trie(made(spark, rows))) == brute(rebuilt(rows))


@pytest.mark.parametrize(("segment", "shard"), [(2, 3), (3, 1000), (64, 2)])
def test_segments_and_shards_change_nothing(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(prefixes, "SEGMENT", segment)
    monkeypatch.setattr(prefixes, "SHARD", shard)
    rows = sample()
    sequences = {c: s for c, s in rebuilt(rows).items()}
    nodes = brute(sequences)
    numbered = [
        (c, pos, hashlib.md5(repr(turn).encode()).hexdigest(), len(turn[1].encode()))
        for c, s in sequences.items() for pos, turn in enumerate(s)
    ]
    frame = spark.createDataFrame(numbered, "conv_id long, pos long, digest string, size long")
    convs = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    rows = frame.repartition(4)
    # The constants travel to the tasks by value: the shard is walked here, its rows come from Spark.
    zero = {"own": "0L", "behind": "0L", "leaf": "0L"}
    cut = prefixes.segments(rows, convs).selectExpr("*", *[f"{v} as {k}" for k, v in zero.items()])
    by_seg = defaultdict(list)
    for r in sorted(cut.collect(), key=lambda r: (r.seg, r.entry, r.digests, r.conv_id)):
        by_seg[r.seg].append((r.conv_id, r.entry, r.exit, r.digests, r.last, r.sizes, r.own, r.behind, r.leaf))
    members, parents = defaultdict(int), {}
    for seg, part in by_seg.items():
        for i in range(0, len(part), shard):
            for key, parent, depth, _, n, _, _, _, _ in prefixes.Shard(seg, part[i : i + shard]).nodes():
                members[depth, key] += n
                parents[key] = parent
    assert sorted((d, n) for (d, _), n in members.items()) == sorted((r[1], r[3]) for r in nodes)
    keys = {k for _, k in members}
    assert all(p is None or p in keys for p in parents.values())


def test_long_conversations_and_copies(spark):
    rows = [(c, t, "user", f"t{t % 7}") for c in range(5) for t in range(200 + (c > 2))]
    rows += [(c, t, "user", "copy") for c in range(200, 1500) for t in range(3)]
    nodes = {r for r in found(prefixes.conversation_trie(made(spark, rows, 8)))}
    sequences = defaultdict(tuple)
    for c, _, role, text in rows:
        sequences[c] += ((role, text),)
    assert sorted(nodes, key=str) == brute(sequences)


def test_empty_and_null_only(spark):
    assert found(prefixes.rebuilt_trie(made(spark, [], 1))) == []
    assert found(prefixes.rebuilt_trie(made(spark, [(None, None, None, None)], 1))) == []


def test_numbers_run_on_over_partitions(spark):
    rows = [(1, t, "u", f"{t}") for t in range(3000)] + [(2, 0, "u", "x")]
    got = sorted((r.conv_id, r.pos) for r in prefixes.numbered(prefixes.turns(made(spark, rows, 4))).collect())
    assert got == [(1, t) for t in range(3000)] + [(2, 0)]


def test_statement(spark, duck, sf):
    got = found(prefixes.rebuilt_trie(spark.read.parquet(f"{sf}/conversations.parquet")))
    rows = duck.execute(CONVERSATIONS_SQL).fetchall()
    names = [d[0] for d in duck.description]
    assert got == sorted((tuple(r[names.index(c)] for c in RESULT) for r in rows), key=str)
