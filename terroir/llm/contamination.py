"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

Texts become sets of word shingles (lower case, five words). An item is found in a document if at least ``SIMILARITY``
of the item's shingles are among the document's, however long the document is. An item of n < 5 words is one shingle of
all its words, and is looked for among the document's shingles of n words.

An item of under five words that holds a script without spaces (Chinese, Japanese, Thai, ...) is cut into characters of
that script and words of others, and so are the documents that hold such a script; the same rules hold for these units.

The items are the smaller sets, so their sketches decide: the item's MinHash values, that is its shingles of least hash.
Items are partitioned by size. An item of n shingles may miss at most (1 - similarity) n of them, so if it is contained,
one of its m = floor((1 - similarity) n) + 1 least shingles is in the document: no contained item is lost. Each size
partition has an inverted index from MinHash values to items; a document probes the partitions whose items it is large
enough to contain. Candidates are verified on the shingles themselves.

The benchmark is a query set: it is cut into blocks of bounded bytes, each sent to all tasks, and all documents are read
once for each block. Documents are not shuffled.

Defined results: null or empty texts and items have no shingles and are never found or contaminated; equal items are
searched once and reported each; repeated documents are reported each; null ids pass through.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from terroir.llm.common import only, record_batches, texts_of

WORDS = 5
SIMILARITY = 0.8
#: Characters of items in a block; its index takes some fifty times as much memory.
BLOCK_CHARS = 1 << 20

_WORD = re.compile(r"\w+")
#: Thai, Lao, Burmese, Khmer, kana and Han: no spaces between words.
_RANGES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_DENSE = re.compile(f"[{_RANGES}]")
_UNIT = re.compile(f"[{_RANGES}]|[^\\W{_RANGES}]+")


def shingle_list(text: str, words: int = WORDS, unit: re.Pattern = _WORD) -> list[str]:
    """Shingles in order, repeats included."""
    return _joined(unit.findall(text.lower()), words)


def _joined(found: list[str], words: int) -> list[str]:
    if len(found) <= words:
        return [" ".join(found)] if found else []
    # Slices of one joined string: from the start of a word to the end of the last word of its shingle.
    joined = " ".join(found)
    start, starts = 0, []
    for word in found:
        starts.append(start)
        start += len(word) + 1
    ends = [s - 1 for s in starts[words:]] + [len(joined)]
    return [joined[a:b] for a, b in zip(starts, ends, strict=False)]


class _Parts:
    """Inverted indexes of the items cut in one way: one for each size partition, and one for each length below ``words``."""

    def __init__(self):
        self.sizes: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.short: dict[int, dict[str, list[int]]] = defaultdict(lambda: defaultdict(list))


class Block:
    """Index of the items of a block."""

    def __init__(self, items: list[tuple[int | None, str]], similarity: float = SIMILARITY, words: int = WORDS):
        self.similarity, self.words = similarity, words
        ids: dict[tuple[bool, int, frozenset[str]], list[int | None]] = defaultdict(list)
        for item, text in items:
            found = _WORD.findall(text.lower())
            dense = len(found) < words and _DENSE.search(text) is not None
            if dense:
                found = _UNIT.findall(text.lower())
            if found:
                ids[dense, min(len(found), words), frozenset(_joined(found, words))].append(item)
        self.entries = [(shingles, items) for (_, _, shingles), items in ids.items()]
        parts = {False: _Parts(), True: _Parts()}
        for entry, (dense, length, shingles) in enumerate(ids):
            if length < words:
                parts[dense].short[length][next(iter(shingles))].append(entry)
                continue
            n = len(shingles)
            sketch = sorted(shingles, key=lambda s: (xxhash.xxh3_64_intdigest(s), s))
            for shingle in sketch[: n - self.needed(n) + 1]:
                parts[dense].sizes[n.bit_length()][shingle].append(entry)
        # Plain dictionaries: the block is broadcast.
        self.parts = {
            dense: (
                {size: dict(index) for size, index in sorted(p.sizes.items())},
                {n: dict(index) for n, index in p.short.items()},
            )
            for dense, p in parts.items()
        }

    def needed(self, n: int) -> int:
        """Shingles of an item of ``n`` that a document must have; exact for decimal similarities."""
        return math.ceil(round(self.similarity * n, 9))

    def hits(self, text: str) -> list[tuple[int, int]]:
        """Entries contained in ``text``, each with the number of its shingles that were found."""
        found = []
        for dense, (sizes, short) in self.parts.items():
            if not sizes and not short or dense and not _DENSE.search(text):
                continue
            words = (_UNIT if dense else _WORD).findall(text.lower())
            for n, index in short.items():
                if len(words) >= n:
                    found += [(e, 1) for shingle in index.keys() & set(_joined(words, n)) for e in index[shingle]]
            own = set(_joined(words, self.words))
            for size, index in sizes.items():
                if len(own) < self.needed(1 << (size - 1)):
                    break  # too small for this and all larger partitions
                candidates = {e for shingle in index.keys() & own for e in index[shingle]}
                for entry in sorted(candidates):
                    shingles = self.entries[entry][0]
                    n = len(shingles & own)
                    if n >= self.needed(len(shingles)):
                        found.append((entry, n))
        return found


def blocks_of(benchmark: DataFrame, similarity: float, block_chars: int) -> Iterator[Broadcast]:
    """Broadcast index blocks of the items, read one partition at a time."""
    context = benchmark.sparkSession.sparkContext
    items, size = [], 0
    for row in only(benchmark, item_id="long", text="string").toLocalIterator():
        text = row["text"] or ""
        if items and size + len(text) > block_chars:
            yield context.broadcast(Block(items, similarity))
            items, size = [], 0
        items.append((row["item_id"], text))
        size += len(text)
    if items:
        yield context.broadcast(Block(items, similarity))


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_found", pa.int64()),
     ("containment", pa.float64())]
)
RESULT_SQL = "doc_id long, item_id long, n_shingles long, n_found long, containment double"


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """A row for each document (doc_id, text) and item (item_id, text) that it contains."""

    def search(block: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = block.value

            def rows():
                for batch in batches:
                    for doc, text in zip(batch.column(0), texts_of(batch), strict=True):
                        for entry, found in index.hits(text):
                            shingles, items = index.entries[entry]
                            for item in items:
                                yield doc.as_py(), item, len(shingles), found, found / len(shingles)

            return record_batches(rows(), RESULT)

        return run

    rows = only(docs, doc_id="long", text="string")
    found = rows.sparkSession.createDataFrame([], RESULT_SQL)
    for block in blocks_of(benchmark, similarity, block_chars):
        found = found.unionByName(rows.mapInArrow(search(block), RESULT_SQL))
    return found


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    schema = StructType(docs.schema.fields)

    def without(block: Broadcast):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = block.value
            for batch in batches:
                kept = batch.filter(pa.array([not index.hits(text) for text in texts_of(batch)], pa.bool_()))
                if kept.num_rows:
                    yield kept

        return run

    for block in blocks_of(benchmark, similarity, block_chars):
        docs = docs.mapInArrow(without(block), schema)
    return docs
