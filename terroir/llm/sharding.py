"""Balanced label propagation: documents into shards of even row counts, linked documents together.

Documents are linked when their texts are equal; a group of equal texts is a clique that is never written out as
pairs. Labels are shards. Each document starts in the shard of a hash of its id. In a round, the documents of each
group are counted per shard (a join by group, pre-aggregated), and all its documents want the shard where most of
their neighbours are. Every shard has a quota, its exact final row count. Documents that already are where they want
to be keep their place first, then larger groups move before smaller ones, until the quota is used up. Whoever finds
no room is without a place and, in the next round, wants the shard with most of its neighbours that still has room.
After the last round, documents without links and the rest fill what room is left. So shards differ by at most one
row, and an edge is cut only where a group meets a full shard.

Everything is DataFrame functions. A group larger than a shard is cut into communities that fit. Running sums over a
shard's claims are taken per block and then over blocks (:func:`running`), so no task holds a shard's or a hot group's
rows. What the driver sees is one row per shard and round.

Defined results: a null text counts as empty; null and repeated ``doc_id`` are rows like others, as are repeated rows;
fewer rows than shards leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from terroir.llm.common import only
from terroir.storage import written

#: Blocks of a running sum; with 24 shards and 100 billion rows, one has about a million rows.
BLOCKS = 4096


def running(df: DataFrame, keys: list[str], block: Column, order: list[Column], amount: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``amount`` over the rows before each row of its key, in the order of block and ``order``.

    ``block`` is a whole number below ``BLOCKS``. Amounts are summed per key and block (map-side); the running sum of
    those sums, at most ``BLOCKS`` rows a key, is where a block starts; a window inside each block does the rest.
    """
    df = df.withColumn("_block", block).withColumn("_amount", amount)
    zero = F.lit(0).cast("long")
    sums = df.groupBy(*keys, "_block").agg(F.sum("_amount").alias("_sum"))
    outer = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*keys, "_block", F.coalesce(F.sum("_sum").over(outer), zero).alias("_start"))
    inner = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inside = df.withColumn("_inside", F.coalesce(F.sum("_amount").over(inner), zero))
    return (
        inside.join(starts, [*keys, "_block"])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_block", "_amount", "_inside", "_start")
    )


def _by_shard(values: list[int], shard: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), shard + 1)


def shard_documents(docs: DataFrame, shards: int = 24, rounds: int = 8) -> DataFrame:
    """``doc_id``, ``size`` (UTF-8 bytes and 8), ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` (null).

    The law is ``rows``: row counts of shards are at most one apart. ``rounds`` bounds the propagation; the result is
    whole after any number of rounds, more rounds cut fewer edges of groups that found no room.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    base = written(
        only(docs, doc_id="long", text="string").select(
            "doc_id",
            (F.octet_length(text) + 8).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.unhex(F.md5(text.cast("binary"))).alias("group"),
        ).withColumn("dice", F.xxhash64("doc_id", "group")),
        "shard-rows",
    )
    n = base.count()
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    # Written, so that joins have shuffles of their own on both sides and split a hot group.
    groups = written(base.groupBy("group").agg(F.count("*").alias("members")).filter("members > 1"), "shard-groups")
    # Communities: groups, or the parts of groups that are larger than a shard.
    parts = F.ceil(F.col("members") / max(1, n // shards))
    linked = base.join(groups, "group").select(
        "doc_id", "size", "text_crc32", "group", "dice",
        F.xxhash64("group", F.pmod("dice", parts)).alias("community"),
        F.pmod(F.xxhash64(F.lit("start"), "doc_id"), F.lit(shards)).cast("int").alias("shard"),
    )
    state = written(linked, "shard-state")
    room = quota
    for step in range(rounds):
        state = written(_round(state, quota, room, shards), "shard-state")
        seen = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = [q - seen.get(s, 0) for s, q in enumerate(quota)]
        if not seen.get(None):
            break
    alone = base.join(groups, "group", "left_anti").select(
        "doc_id", "size", "text_crc32", "group", "dice", F.lit(None).cast("int").alias("shard")
    )
    rest = state.filter("shard is null").select(*alone.columns).unionByName(alone)
    block = F.pmod(F.xxhash64("group"), F.lit(64)) * 64 + F.pmod("dice", F.lit(64))
    one = F.lit(1).cast("long")
    rest = running(rest, [], block, [F.col("group"), F.col("dice")], one, "place")
    filled, shard = 0, F.lit(shards - 1)
    ends = []
    for r in room:
        filled += r
        ends.append(filled)
    for s in range(shards - 2, -1, -1):
        shard = F.when(F.col("place") < ends[s], F.lit(s)).otherwise(shard)
    columns = ["doc_id", "size", "text_crc32", "dice", "shard"]
    placed = rest.withColumn("shard", shard.cast("int")).select(*columns)
    everyone = written(state.filter("shard is not null").select(*columns).unionByName(placed), "shard-places")
    order = [F.col("dice"), F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return running(everyone, ["shard"], F.pmod("dice", F.lit(BLOCKS)), order, one, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _round(state: DataFrame, quota: list[int], room: list[int], shards: int) -> DataFrame:
    """One round of claims; the new ``state``, with a null ``shard`` for documents that found no room."""
    hist = state.groupBy("community", "shard").agg(F.count("*").alias("n"))
    # A community's wish: where most of it is, among shards with room; else any shard with room, the same for all of it.
    open_shards = [s for s in range(shards) if room[s] > 0] or list(range(shards))
    anywhere = F.element_at(
        F.array(*map(F.lit, open_shards)), F.pmod(F.xxhash64("community"), F.lit(len(open_shards))).cast("int") + 1
    )
    open_here = F.col("shard").isin(open_shards)
    best = F.max(F.when(open_here, F.struct("n", F.xxhash64("community", "shard").alias("dice"), "shard")))
    wishes = hist.groupBy("community").agg(best.alias("best"), F.sum("n").alias("members")).select(
        "community", "members", F.coalesce("best.shard", anywhere).alias("wish")
    )
    # In the first round everybody follows the wish; later only those without a place do.
    first = room == quota
    claims = hist.join(wishes, "community")
    if not first:
        claims = claims.withColumn("wish", F.coalesce("shard", "wish"))
    stays = F.col("shard").eqNullSafe(F.col("wish"))
    rank = F.when(stays, 0).otherwise(F.lit(63) - F.floor(F.log2("members")).cast("int"))
    block = rank * 64 + F.pmod(F.xxhash64("community"), F.lit(64))
    order = [F.col("community"), F.coalesce("shard", F.lit(-1))]
    claims = running(claims, ["wish"], block, order, F.col("n"), "before")
    free = _by_shard(quota, F.col("wish")) - F.col("before")
    claims = claims.withColumn("take", F.greatest(F.lit(0), F.least("n", free)).cast("long")).select(
        "community", F.coalesce("shard", F.lit(-1)).alias("origin"), "wish", "n", "take"
    )
    told = state.withColumn("origin", F.coalesce("shard", F.lit(-1))).drop("shard").join(claims, ["community", "origin"])
    columns = [c for c in state.columns if c != "shard"]
    whole = told.filter("take = n or take = 0").select(*columns, F.when(F.col("take") > 0, F.col("wish")).alias("shard"))
    # Where a shard's room ends within a claim: the first documents of it.
    split = running(
        told.filter("take > 0 and take < n"), ["community", "origin"], F.pmod("dice", F.lit(BLOCKS)),
        [F.col("dice"), F.col("doc_id")], F.lit(1).cast("long"), "place",
    )
    return whole.unionByName(split.select(*columns, F.when(F.col("place") < F.col("take"), F.col("wish")).alias("shard")))
