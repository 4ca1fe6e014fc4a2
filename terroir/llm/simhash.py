"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A text's fingerprint has a bit set if over half of its shingles' XXH64 hashes (seed 42, of UTF-8 bytes) have it. Words
are runs of other than ASCII white space after lower-casing A-Z; a shingle is so many words joined by blanks, a shorter
text one shingle of all its words; shingles count as often as they occur. A text without words has fingerprint zero.

Two fingerprints at most 2r bits apart have a variant in common that is at most r bits from each. So every distinct
fingerprint emits all its variants within r bits, variants meet in a shuffle, and fingerprints with a common variant are
a pair. A variant travels as its low ``KEY_BITS`` bits: a fingerprint is sent once for each low part that its variants
have, and the receiving task lists the variants' high parts. That is every variant, at a fifteenth of the rows. Within
a variant, all fingerprints are at most 2r bits apart, so linking each to the least of them loses no connection and
emits no pairs of a crowd. Links are deduplicated, verified by their bit distance and joined into components.

Documents meet fingerprints by value: copies share one, and a hot fingerprint is counted before the shuffle.

Defined results: null text is empty; a null ``doc_id`` is never the least of its group (a group without any id has a null
component); repeated rows are documents of the same group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches, texts_of
from terroir.llm.components import components
from terroir.storage import written

KEY_BITS = 16
SEED = 42
#: Variants listed at once in a task, 8 bytes each.
BATCH = 1 << 20
#: Fingerprints whose low parts are listed at once: 137 of 20 bytes each.
EMITTED = 20_000
SLAB = 1 << 16


def fingerprint(text: str, words: int = 4) -> int:
    """The 64-bit SimHash of a text."""
    found = text.encode().lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    start, starts = 0, []
    for word in found:
        starts.append(start)
        start += len(word) + 1
    ends = [s - 1 for s in starts[words:]] + [len(joined)]
    digest, n = xxhash.xxh64_intdigest, len(ends)
    counts = np.zeros(64, np.int64)
    for i in range(0, n, SLAB):
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[i : i + SLAB], ends[i : i + SLAB], strict=False)]
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


FINGERPRINTS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("fp", pa.int64())])


def fingerprints(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``text_hash`` (64 bits, tells rows of the same id apart) and ``fp`` as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc, text_hash, text in zip(batch.column(0), batch.column(1), texts_of(batch), strict=True):
                    yield doc.as_py(), text_hash.as_py(), signed(fingerprint(text, words))

        return record_batches(rows(), FINGERPRINTS)

    rows = only(docs, doc_id="long", text="string").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, fp long")


def masks(bits: int, most: int) -> np.ndarray:
    """All words of ``bits`` bits with at most ``most`` bits set, fewest first."""
    return np.array([sum(1 << b for b in c) for k in range(most + 1) for c in combinations(range(bits), k)], np.uint64)


def _emit(half: int):
    low = np.uint64((1 << KEY_BITS) - 1)
    flips = masks(KEY_BITS, half)
    schema = pa.schema([("key", pa.int32()), ("fps", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Fingerprints by low part of their variants, packed per batch of input."""
        for batch in batches:
            all_fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for i in range(0, len(all_fps), EMITTED):
                fps = all_fps[i : i + EMITTED]
                keys = (fps[:, None] & low ^ flips[None, :]).astype(np.int32).ravel()
                order = np.argsort(keys, kind="stable")
                keys = keys[order]
                values = np.repeat(fps, len(flips))[order].view(np.int64)
                firsts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
                lists = pa.ListArray.from_arrays(pa.array(np.r_[firsts, len(keys)], pa.int32()), pa.array(values))
                made = pa.RecordBatch.from_arrays([pa.array(keys[firsts], pa.int32()), lists], schema=schema)
                for j in range(0, made.num_rows, 4096):
                    yield made.slice(j, 4096)

    return run


def _meet(half: int):
    low = np.uint64((1 << KEY_BITS) - 1)
    high = [masks(64 - KEY_BITS, k) << np.uint64(KEY_BITS) for k in range(half + 1)]
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links(variants: list[np.ndarray], owners: list[np.ndarray]) -> pa.RecordBatch | None:
        """Each owner of a shared variant, linked to the least owner of that variant; distinct."""
        v, o = np.concatenate(variants), np.concatenate(owners)
        ordered = np.sort(v)
        shared = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if not len(shared):
            return None
        at = np.minimum(np.searchsorted(shared, v), len(shared) - 1)
        hit = shared[at] == v
        at, o = at[hit], o[hit]
        order = np.lexsort((o, at))
        at, o = at[order], o[order]
        first = np.r_[True, at[1:] != at[:-1]]
        least = o[np.flatnonzero(first)][np.cumsum(first) - 1]
        apart = (least != o) & (np.bitwise_count(least ^ o) <= 2 * half)
        pairs = np.unique(np.stack([o[apart], least[apart]], axis=1), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key, so a key's lists follow each other; the variants of whole keys are listed together."""
        variants: list[np.ndarray] = []
        owners: list[np.ndarray] = []
        size, last = 0, None
        for batch in batches:
            keys = batch.column(0).to_pylist()
            offsets = batch.column(1).offsets.to_numpy()
            values = batch.column(1).values.to_numpy().view(np.uint64)
            for i, key in enumerate(keys):
                if key != last and size >= BATCH:
                    if made := links(variants, owners):
                        yield made
                    variants, owners, size = [], [], 0
                last = key
                fps = values[offsets[i] : offsets[i + 1]]
                spent = np.bitwise_count(fps & low ^ np.uint64(key))
                for used in range(half + 1):
                    own = fps[spent == used]
                    flips = high[half - used]
                    if len(own):
                        variants.append(((own & ~low | np.uint64(key))[:, None] ^ flips[None, :]).ravel())
                        owners.append(np.repeat(own, len(flips)))
                        size += len(variants[-1])
        if variants and (made := links(variants, owners)):
            yield made

    return run


def near_links(fps: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that connect all ``fp`` of ``fps`` (distinct longs) at most ``distance`` bits apart (an even number)."""
    half, odd = divmod(distance, 2)
    if odd:
        raise ValueError("the distance must be even: each side flips half of it")
    sent = fps.select("fp").mapInArrow(_emit(half), "key int, fps array<long>")
    met = sent.repartition("key").sortWithinPartitions("key").mapInArrow(_meet(half), "a long, b long")
    return met.distinct()


def _rooted(docs: DataFrame, words: int, distance: int) -> tuple[DataFrame, DataFrame]:
    """The documents' fingerprints, and ``fp``, ``root``, ``first_id`` (least doc_id) of each distinct fingerprint."""
    prints = written(fingerprints(docs, words), "simhash")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = components(near_links(distinct, distance), "simhash-links")
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    return prints, rooted


def near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``: the least ``doc_id`` reachable by links."""
    prints, rooted = _rooted(docs, words, distance)
    rooted = written(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(least, "root").select("fp", "component_id")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def without_near_duplicates(docs: DataFrame, words: int = 4, distance: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one of least ``doc_id`` (then text hash)."""
    prints, rooted = _rooted(docs, words, distance)
    kinds = prints.groupBy("fp", "doc_id", "text_hash").agg(F.count("*").alias("rows")).join(rooted, "fp")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = kinds.groupBy("root").agg(F.min_by(F.struct("doc_id", "text_hash", "rows"), order).alias("first"))
    kept = written(first.select("first.*"), "simhash-kept").alias("kept")
    here = F.col("docs.doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.xxhash64("docs.text") == F.col("kept.text_hash"))
    columns = docs.columns
    single = docs.alias("docs").join(kept.filter("rows = 1"), here, "left_semi")
    # Rows repeated with their id and text: any one of them.
    repeated = docs.alias("docs").join(kept.filter("rows > 1"), here, "left_semi")
    return single.unionByName(repeated.dropDuplicates(["doc_id", "text"])).select(*(F.col(f"`{c}`") for c in columns))
