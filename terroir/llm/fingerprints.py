"""Document fingerprints: content-defined chunks, their digests weighted by length, compared by containment.

A gear hash rolls over the UTF-8 bytes: each step shifts the hash left and adds a value of the byte, so the hash at a
position depends on the last 32 bytes only. A chunk ends where the top bits of the hash are zero. Chunking is
normalised: before a chunk has its normal size, more zero bits are asked for than afterwards, which narrows the spread
of sizes; no chunk is shorter than ``MIN_SIZE`` (but the last) or longer than ``MAX_SIZE``. As ends depend on content, an
insertion changes the chunks near it only.

The fingerprint of a text is its set of chunk digests with their lengths, in order of digest:
``digest.length`` joined by blanks, a length multiplied if the chunk occurs several times. The likeness of two
fingerprints is the containment of the smaller in the larger: shared length by the smaller total length. Two empty
texts are alike (1), an empty and another text are not (0).

Neighbours in descending ``doc_id`` come together without a global sort: ids alone give range bounds, rows are dealt to
ranges and sorted there, and the first row of each range is also dealt, as a guest, to the end of the range before it.

Defined results: null text is empty; documents without ``doc_id`` come after all others; ties of ``doc_id`` are ordered by
text; a single document is its own neighbour; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches

MIN_SIZE, NORMAL_SIZE, MAX_SIZE = 24, 64, 256
#: Zero bits asked for before and after the normal size.
STRICT_BITS, LOOSE_BITS = 8, 6
WINDOW_DOUBLINGS = 5

#: A value for each byte, from a hash of the byte.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b]), seed=1) for b in range(256)], np.uint32)
SLAB = 1 << 20


def _gear_ends(data: bytes) -> tuple[list[int], list[int]]:
    """Positions after which a chunk may end by the strict and by the loose mask."""
    strict: list[np.ndarray] = []
    loose: list[np.ndarray] = []
    reach = 1 << WINDOW_DOUBLINGS
    flat = np.frombuffer(data, np.uint8)
    for start in range(0, len(data), SLAB):
        begin = max(0, start - reach)
        h = GEAR[flat[begin : start + SLAB]]
        for i in range(WINDOW_DOUBLINGS):
            width = 1 << i
            if len(h) > width:
                h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        h = h[start - begin :]
        at = np.flatnonzero(h < np.uint32(1 << (32 - LOOSE_BITS)))
        loose.append(at + (start + 1))
        strict.append(at[h[at] < np.uint32(1 << (32 - STRICT_BITS))] + (start + 1))
    none = np.empty(0, np.int64)
    return np.concatenate([none, *strict]).tolist(), np.concatenate([none, *loose]).tolist()


def chunk_ends(data: bytes) -> list[int]:
    strict, loose = _gear_ends(data)
    ends, start, n = [], 0, len(data)
    while start < n:
        last = min(n, start + MAX_SIZE)
        end = last
        i = bisect_left(strict, start + MIN_SIZE)
        normal = start + NORMAL_SIZE
        if i < len(strict) and strict[i] < normal:
            end = min(strict[i], last)
        else:
            i = bisect_left(loose, normal)
            if i < len(loose) and loose[i] < last:
                end = loose[i]
        ends.append(end)
        start = end
    return ends


def chunk_set(data: bytes) -> dict[int, int]:
    """Total length of the chunks of each digest."""
    out: dict[int, int] = {}
    start, digest = 0, xxhash.xxh3_64_intdigest
    for end in chunk_ends(data):
        d = digest(data[start:end])
        out[d] = out.get(d, 0) + end - start
        start = end
    return out


def fingerprint(chunks: dict[int, int]) -> str:
    return " ".join([f"{d:016x}.{chunks[d]}" for d in sorted(chunks)])


def likeness(a: dict[int, int], b: dict[int, int]) -> float:
    """Length shared by the two sets, by the length of the smaller one."""
    if not a or not b:
        return float(not a and not b)
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    shared = sum([min(n, large[d]) for d, n in small.items() if d in large])
    return shared / min(sum(a.values()), sum(b.values()))


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
     ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
RESULT_SQL = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges in order: ``part``, ``guest``, ``doc_id``, ``text``; each with its successor, guests only as that."""

    def items():
        for batch in batches:
            for part, guest, doc, text in zip(*batch.columns, strict=True):
                yield part.as_py(), guest.as_py(), doc.as_py(), text.as_py()

    def rows():
        last = None
        for part, guest, doc, text in items():
            chunks = chunk_set(text.encode())
            if last is not None and last[0] == part:
                yield _row(*last[1:], text, chunks)
            last = None if guest else (part, doc, text, chunks)

    return record_batches(rows(), RESULT, 500)


def _row(doc: int | None, text: str, chunks: dict[int, int], following: str, following_chunks: dict[int, int]) -> tuple:
    cut = len(text) // 3
    edited = (text[: len(text) - cut] + following[:cut]).encode()
    changed = chunk_set(edited)
    return (
        doc, len(text), hashlib.sha256(edited).hexdigest(), fingerprint(chunks), fingerprint(changed),
        likeness(chunks, changed), likeness(chunks, following_chunks),
    )


def fingerprint_documents(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text), of their edited texts, and likenesses; see the module's text.

    The edited text is the text with its last third of code points replaced by as many from the next document's start.
    ``parts`` is the number of partitions, by default the session's shuffle partitions.
    """
    spark = docs.sparkSession
    rows = only(docs, doc_id="long", text="string").withColumn("text", F.coalesce("text", F.lit("")))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Range bounds: one number for each range. Hashing deals several ranges to each partition, which evens them out.
    ranges = 4 * parts
    bounds = sorted(set(rows.approxQuantile("doc_id", [i / ranges for i in range(1, ranges)], 0.1 / ranges)))
    part = F.lit(0)
    if bounds:
        bound = F.array(*(F.lit(int(b)) for b in bounds))
        # Descending: ids above the last bound are in range 0; ids up to the first, and none, in the last.
        below = F.size(F.filter(bound, lambda b: b >= F.col("doc_id")))
        part = F.when(F.col("doc_id").isNull(), len(bounds)).otherwise(below)
    dealt = rows.withColumn("part", part.cast("int"))
    heads = dealt.groupBy("part").agg(F.max("doc_id").alias("doc_id"))
    heads = [(r["part"], r["doc_id"]) for r in heads.collect()]  # one row for each range
    heads.sort()
    guests = spark.createDataFrame(
        [(heads[i - 1][0], doc) for i, (_, doc) in enumerate(heads)], "to int, head long"
    )
    # A head's text goes to its own range and, as a guest, to the range before it. Guests with the same id as a head are all
    # sent; the first in order is the one that is used.
    found = dealt.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("head")), "left")
    places = F.array(F.struct("part", F.lit(False).alias("guest")), F.struct(F.col("to").alias("part"), F.lit(True).alias("guest")))
    both = found.select(F.explode(F.when(F.col("to").isNull(), F.slice(places, 1, 1)).otherwise(places)).alias("p"), "doc_id", "text").select(
        "p.part", "p.guest", "doc_id", "text"
    )
    ordered = both.repartition(parts, "part").sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "text")
    return ordered.mapInArrow(_compare, RESULT_SQL)
