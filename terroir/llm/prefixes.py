"""Prefix trie of conversations by vertical bitmaps.

A turn travels as the MD5 of its role and text with the text's UTF-8 bytes, so no text is shuffled. Conversations are
cut into segments of ``SEGMENT`` turns; a segment knows the key of the prefix before it and after it. Segments are
range-partitioned and sorted by (segment, prefix before, turns, conversation), so that equal beginnings lie together and
the copies of one conversation still spread over tasks. A task cuts its rows into shards of at most ``SHARD`` segments.

A shard is a vertical index: for each (position, turn) the bitset of the shard's conversations that have it. From the
bitset of a prefix, depth first, the least conversation not yet dealt names a turn; the intersection with that turn's
posting is a child, its population count the child's members, and members without a further turn are its end list.
Nodes of the same prefix from several shards are added up by key.

Sums over a subtree need no walk over levels. A node is owned by its least member; who owns a node owns all deeper nodes
of its own path. So what a subtree saves is the sum, over the members of its top, of the bytes of turns from there on
that the member does not own; its leaves are the members that own a childless node. Shards are walked twice: first for
members and owners, then for these sums.

The keys of prefixes at segment bounds come from sums of hashes of (position, turn), which add up over a
conversation's segments. Positions come from a global sort whose partitions tell how many rows they hold of the
conversation that runs on.

Memory: a shard; a conversation of any length is many segments. End lists are hashed as a stream: the digest of a list
is one sequence by its definition, so one task reads it, in pieces of up to ``SHARD`` ids.

Defined results: null role or text is empty; turns are ordered by ``turn`` (null first), ties by their digest and
size; repeated rows are turns of their own; rows without ``conv_id`` belong to no conversation; an empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches
from terroir.storage import written

#: Turns of a segment, and segments of a shard.
SEGMENT, SHARD = 64, 1024
#: The first turns that may be taken over from another conversation.
MOST_SHARED = 8
ROOT = hashlib.md5(b"").hexdigest()
TURN = "conv_id long, turn long, digest string, size long"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``digest`` and ``size`` of each turn."""
    rows = only(conversations, conv_id="long", turn="long", role="string", text="string").filter("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    return rows.select("conv_id", "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))


NUMBERED = pa.schema(
    [("part", pa.int32()), ("conv_id", pa.int64()), ("local", pa.int64()), ("digest", pa.string()), ("size", pa.int64())]
)


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with their partition and their place in it within their conversation."""
    part = TaskContext.get().partitionId()

    def rows():
        last, local = None, 0
        for batch in batches:
            for conv, digest, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                local = local + 1 if conv == last else 0
                last = conv
                yield part, conv, local, digest, size

    return record_batches(rows(), NUMBERED, 10_000)


def numbered(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (from 0), ``digest``, ``size``: turns in order, a long conversation over many tasks."""
    order = ["conv_id", F.col("turn").asc_nulls_first(), "digest", "size"]
    ordered = written(rows, "turns").repartitionByRange(*order).sortWithinPartitions(*order)
    local = written(
        ordered.select("conv_id", "digest", "size").mapInArrow(
            _number, "part int, conv_id long, local long, digest string, size long"
        ),
        "turns-ordered",
    )
    held = local.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A partition goes on with at most one conversation of those before it: no more rows than partitions.
    later = held.withColumn("before", F.sum("n").over(before)).filter("before is not null").drop("n")
    placed = local.join(F.broadcast(later), ["conv_id", "part"], "left")
    return placed.select("conv_id", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "size")


def shared_beginnings(rows: DataFrame, group: int = 5, most: int = MOST_SHARED) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations: the first h turns are those of conversation c - c % ``group``, h = crc32(c) % (most + 1).

    ``rows`` as from :func:`numbered`. Returns the rebuilt rows and the ids of all conversations. At most ``most`` rows
    of a conversation meet the few others that take them over.
    """
    own = rows.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % (most + 1))
    convs = own.select("conv_id", "h", (F.col("conv_id") - F.col("conv_id") % group).alias("base")).distinct()
    heads = rows.filter(F.col("pos") < most)
    lengths = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count(F.lit(1)).alias("n"))
    convs = written(
        convs.join(lengths, "base", "left").withColumn("taken", F.least("h", F.coalesce("n", F.lit(0)))).drop("n"),
        "conversations",
    )
    first = convs.join(heads.withColumnRenamed("conv_id", "base"), "base").filter("pos < h")
    moved = own.filter("pos >= h").drop("h").join(convs.select("conv_id", "h", "taken"), "conv_id")
    rebuilt = first.select("conv_id", "pos", "digest", "size").unionByName(
        moved.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "size")
    )
    return rebuilt, convs.select("conv_id")


def segments(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each segment: ``conv_id``, ``seg``, keys ``entry`` and ``exit``, ``digests``, ``sizes``, ``last``."""
    hashed = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.col("digest")))

    def half(start: int) -> F.Column:
        return F.sum(F.conv(F.substring(hashed, start, 15), 16, 10).cast("decimal(20,0)"))

    cut = rows.groupBy("conv_id", F.expr(f"pos div {SEGMENT}").alias("seg")).agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest", "size"))).alias("turns"),  # at most SEGMENT of them
        half(1).alias("a"), half(16).alias("b"),
    )
    # Conversations without a turn have one empty segment.
    all_segments = convs.join(cut, "conv_id", "left").withColumn("seg", F.coalesce("seg", F.lit(0)))
    so_far = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id").orderBy("seg")
    exit_key = F.md5(F.concat_ws(":", (F.col("seg") + 1).cast("string"), F.sum("a").over(so_far).cast("string"), F.sum("b").over(so_far).cast("string")))
    keyed = all_segments.withColumn("exit", exit_key)
    return keyed.select(
        "conv_id", "seg", F.coalesce(F.lag("exit").over(whole), F.lit(ROOT)).alias("entry"), "exit",
        F.coalesce(F.col("turns.digest"), F.expr("array()")).cast("array<string>").alias("digests"),
        F.coalesce(F.col("turns.size"), F.expr("array()")).cast("array<bigint>").alias("sizes"),
        F.lead("seg").over(whole).isNull().alias("last"),
    )


NODES = pa.schema(
    [("key", pa.string()), ("parent", pa.string()), ("depth", pa.int64()), ("conv_id", pa.int64()), ("n", pa.int64()),
     ("n_ends", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()), ("ends", pa.string())]
)
NODES_SQL = "key string, parent string, depth long, conv_id long, n long, n_ends long, leaves long, saved long, ends string"


def bits(members: int) -> Iterator[int]:
    """The places of the set bits, ascending."""
    while members:
        low = members & -members
        yield low.bit_length() - 1
        members ^= low


class Shard:
    """Vertical bitmaps over segments of one number; bits in ascending order of conversation.

    A segment is (conv_id, entry, exit, digests, last, sizes, own, behind, leaf): ``own`` is the depth of the first node
    that the conversation owns, ``behind`` the bytes behind the segment that it does not, ``leaf`` whether its last is a leaf.
    """

    def __init__(self, seg: int, rows: list[tuple]):
        self.depth = seg * SEGMENT
        self.rows = sorted(rows, key=lambda r: r[0])
        self.postings: dict[tuple[int, str], int] = {}
        self.entries: dict[str, int] = {}
        self.ends = [0] * (SEGMENT + 1)
        #: For each segment and position, the bytes from there on that the conversation does not own.
        self.unowned: list[list[int]] = []
        for i, (_, entry, _, digests, last, sizes, own, behind, _) in enumerate(self.rows):
            bit = 1 << i
            self.entries[entry] = self.entries.get(entry, 0) | bit
            for place in enumerate(digests):
                self.postings[place] = self.postings.get(place, 0) | bit
            if last:
                self.ends[len(digests)] |= bit
            # The turn at a position is the last of the node one deeper.
            kept = [x if self.depth + at + 1 < own else 0 for at, x in enumerate(sizes)]
            self.unowned.append([*accumulate(reversed(kept), initial=behind)][::-1])

    def nodes(self) -> Iterator[tuple]:
        """Node rows below the segments' entries, depth first; the root too, where it is an entry."""
        for entry, members in self.entries.items():
            if entry == ROOT:
                yield self._node(ROOT, None, 0, members)
            stack = [(entry, 0, members)]
            while stack:
                key, at, members = stack.pop()
                rest = members & ~self.ends[at]
                while rest and at < SEGMENT:
                    row = self.rows[(rest & -rest).bit_length() - 1]
                    digest = row[3][at]
                    child = rest & self.postings[at, digest]
                    rest ^= child
                    below = row[2] if at + 1 == SEGMENT else hashlib.md5((key + digest).encode()).hexdigest()
                    yield self._node(below, key, at + 1, child)
                    stack.append((below, at + 1, child))

    def _node(self, key: str, parent: str | None, at: int, members: int) -> tuple:
        rows, place = self.rows, max(at - 1, 0)
        leaves = saved = 0
        for i in bits(members):
            saved += self.unowned[i][place]
            leaves += rows[i][8]
        ended = members & self.ends[at]
        ends = ",".join([str(rows[i][0]) for i in bits(ended)]) if ended else None
        least = rows[(members & -members).bit_length() - 1][0]
        return key, parent, self.depth + at, least, members.bit_count(), ended.bit_count(), leaves, saved, ends


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        kept: list[tuple] = []
        number = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if kept and (row[0] != number or len(kept) >= SHARD):
                    yield from Shard(number, kept).nodes()
                    kept = []
                number = row[0]
                kept.append(row[1:])
        if kept:
            yield from Shard(number, kept).nodes()

    return record_batches(rows(), NODES)


def _shard_nodes(rows: DataFrame) -> DataFrame:
    order = ["seg", "entry", "digests", "conv_id"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    columns = ["seg", "conv_id", "entry", "exit", "digests", "last", "sizes", "own", "behind", "leaf"]
    return dealt.select(*columns).mapInArrow(_walk, NODES_SQL)


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by key and first id, as one digest for each key."""

    def rows():
        key, state = None, None
        for batch in batches:
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if k != key:
                    if state:
                        yield key, state.hexdigest()
                    key, state = k, hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
        if state:
            yield key, state.hexdigest()

    return record_batches(rows(), pa.schema([("key", pa.string()), ("ends_sha256", pa.string())]))


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The nodes of the prefix trie of conversations.

    ``rows`` are (conv_id, pos from 0 without gaps, digest, size), ``convs`` the ids of all conversations. Returns, for
    each node, ``conv_id`` (least member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``,
    ``saved_tokens``, ``ends_sha256``, and ``key``, ``parent_key``, which identify it.
    """
    cut = written(segments(rows, convs), "trie-segments")
    nothing = F.lit(0).cast("long")
    unweighed = cut.withColumns({"own": nothing, "behind": nothing, "leaf": nothing})
    counted = _shard_nodes(unweighed).groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), (F.sum("n") == F.sum("n_ends")).alias("leaf")
    )
    owners = written(
        counted.groupBy("conv_id").agg(F.min("depth").alias("own"), F.max(F.col("leaf").cast("int")).alias("leaf")), "trie-owners"
    )
    owned = cut.join(owners, "conv_id", "left").withColumn("own", F.coalesce("own", F.lit(1 << 62)))
    # The turns before a conversation's first own node: all but the first own - 1 positions are its own.
    before = F.slice("sizes", 1, F.least(F.greatest(F.col("own") - 1 - F.col("seg") * SEGMENT, nothing), F.lit(SEGMENT)).cast("int"))
    not_own = F.aggregate(before, nothing, lambda a, x: a + x)
    later = Window.partitionBy("conv_id").orderBy(F.desc("seg")).rowsBetween(Window.unboundedPreceding, -1)
    weighed = owned.withColumns(
        {"behind": F.coalesce(F.sum(not_own).over(later), nothing), "leaf": F.coalesce("leaf", nothing).cast("long")}
    )
    parts = written(_shard_nodes(weighed), "trie-parts")
    nodes = written(
        parts.groupBy("key").agg(
            F.min("parent").alias("parent"), F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"),
            F.sum("n").alias("n"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
        ),
        "trie-nodes",
    )
    pieces = parts.filter("ends is not null").select("key", "ends", F.split("ends", ",", 2)[0].cast("long").alias("first"))
    ends = pieces.repartition("key").sortWithinPartitions("key", "first").select("key", "ends").mapInArrow(
        _hash_ends, "key string, ends_sha256 string"
    )
    children = nodes.groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    joined = nodes.join(above, "parent", "left").join(children, "key", "left").join(ends, "key", "left")
    return joined.select(
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"), "key", F.col("parent").alias("parent_key"),
    )


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the ``conversations`` (conv_id, turn, role, text) as they are."""
    rows = written(numbered(turns(conversations)), "turns-numbered")
    return trie(rows, rows.select("conv_id").distinct())


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the ``conversations`` with beginnings taken over by :func:`shared_beginnings`."""
    return trie(*shared_beginnings(written(numbered(turns(conversations)), "turns-numbered")))
