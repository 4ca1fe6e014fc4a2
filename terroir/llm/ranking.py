"""Ranked lexical search by best-first document intervals over range-maximum sparse tables.

Index: a task cuts its documents into blocks of bounded text. A block is written as one row for each of its terms with
the documents' places in the block, ascending, and their term counts, and one row with the documents' ids and lengths.
Postings are not shuffled. Places follow ascending doc_id.

Search: the items' terms, dealt to groups of items, meet the index rows by term; what a group needs of a block is a
cell, which one task holds. Sums over the index give N, L and df. In a cell every posting list has its impacts
(weight times saturated count, a whole number) and a sparse table: entry (j, i) is the greatest impact of the 2^j
postings from i on, with its place, so that two look-ups give the maximum of any range of documents.

For an item, an interval of documents is bounded by the sum of its terms' range maxima. Intervals are split best first
at the document of the greatest single impact: that document is scored exactly, both sides get bounds of their own.
An interval whose bound is below the item's tenth best score is dropped; at an equal bound, if its first id is greater
than the tenth's. A round takes up to ``ROUND`` of the best intervals at once, which keeps numpy busy.

Cells are searched twice. The first pass ends after ``FIRST_ROUNDS`` rounds; the tenth best of its scores over all
cells is a floor under the item's tenth best score, so that the second pass drops most cells at their first bounds.
Floors only skip what cannot be among the answers, so the result is exact.

Memory: a block's text when indexing; the cell's postings times the levels of its tables when searching.

Defined results: null text has no term; rows of one item_id (null included) are one item with the terms of all of them;
repeated rows of documents are ranked each; documents without id come after others of equal score; an item without a
term, or whose terms no document holds, has no rows; empty tables give no rows.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches, texts_of
from terroir.storage import written

#: UTF-8 bytes: A-Z lower-cased, other ASCII than letters and digits as a blank.
FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in bytes(range(256)).lower())

#: Characters and documents of a block; a place has PLACE_BITS bits.
BLOCK_CHARACTERS, PLACE_BITS = 8_000_000, 13
BLOCK_DOCUMENTS = 1 << PLACE_BITS
#: Items of a group.
GROUP_ITEMS = 400
#: Intervals split in one round, and the rounds of the first pass.
ROUND, FIRST_ROUNDS = 32, 6

INDEX = pa.schema(
    [("block", pa.int64()), ("term", pa.string()), ("places", pa.list_(pa.int64())), ("counts", pa.list_(pa.int32()))]
)
INDEX_SQL = "block long, term string, places array<long>, counts array<int>"


def terms_of(text: str) -> list[bytes]:
    """The terms of a text: maximal runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(FOLD).split()


def _block_rows(number: int, docs: list[tuple[int | None, Counter]]) -> Iterator[tuple]:
    """Index rows of one block; the row without a term has ids and lengths."""
    docs.sort(key=lambda d: (d[0] is None, d[0] or 0))
    places: dict[bytes, array] = {}
    counts: dict[bytes, array] = {}
    for place, (_, found) in enumerate(docs):
        for term, n in found.items():
            if term in places:
                places[term].append(place)
                counts[term].append(n)
            else:
                places[term] = array("q", (place,))
                counts[term] = array("i", (n,))
    yield number, "", [doc for doc, _ in docs], [found.total() for _, found in docs]
    for term, own in places.items():
        yield number, term.decode(), np.frombuffer(own, np.int64), np.frombuffer(counts[term], np.int32)


def index(docs: DataFrame) -> DataFrame:
    """The written index of ``docs`` (doc_id, text): all terms of all documents; documents without a term are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            number, kept, size = TaskContext.get().partitionId() << 32, [], 0
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                    found = Counter(terms_of(text))
                    if found:
                        kept.append((doc, found))
                        size += len(text)
                    if size >= BLOCK_CHARACTERS or len(kept) >= BLOCK_DOCUMENTS:
                        yield from _block_rows(number, kept)
                        number, kept, size = number + 1, [], 0
            if kept:
                yield from _block_rows(number, kept)

        return record_batches(rows(), INDEX, 5000)

    return written(only(docs, doc_id="long", text="string").mapInArrow(run, INDEX_SQL), "search-index")


QUERY_TERMS = pa.schema([("item_id", pa.int64()), ("term", pa.string())])


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id`` and ``term`` of each item's distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for item, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                    for term in dict.fromkeys(terms_of(text)):
                        yield item, term.decode()

        return record_batches(rows(), QUERY_TERMS)

    return only(items, item_id="long", text="string").mapInArrow(run, "item_id long, term string").distinct()


class Cell:
    """Posting lists of one block with their sparse tables, for the terms of a group of items.

    ``lists`` are (items, weight, places, counts) of the terms, ``n_docs`` and ``n_terms`` the corpus's N and L.
    """

    def __init__(self, ids: list[int | None], lengths: np.ndarray, lists: list[tuple], n_docs: int, n_terms: int):
        self.ids = ids
        self.items: dict[int | None, list[int]] = {}
        sizes = np.array([len(x[2]) for x in lists])
        self.starts = np.cumsum(sizes) - sizes
        self.ends = self.starts + sizes
        places = np.concatenate([x[2] for x in lists])
        counts = np.concatenate([x[3] for x in lists]).astype(np.int64)
        weights = np.repeat(np.array([x[1] for x in lists], np.int64), sizes)
        m = 10 + (90 * lengths.astype(np.int64) * n_docs) // n_terms
        impacts = weights * ((1_000_000_000 * counts) // (1000 * counts + 8 * m[places]))
        for i, (own, _, _, _) in enumerate(lists):
            for item in own:
                self.items.setdefault(item, []).append(i)
        # Postings in order of list and place; a term's place is found by one search over all.
        self.stride = len(ids) + 1
        self.keys = np.repeat(np.arange(len(lists)) * self.stride, sizes) + places
        self.impacts = impacts
        # Of equal impacts the first place is the greatest entry.
        n_levels = int(sizes.max()).bit_length()
        self.table = np.empty((n_levels, len(impacts)), np.int64)
        self.table[0] = impacts << PLACE_BITS | BLOCK_DOCUMENTS - 1 - places
        for j in range(1, n_levels):
            last, half = self.table[j - 1], 1 << j - 1
            self.table[j] = last  # a range never leaves its list: entries that would aren't read
            np.maximum(last[:-half], last[half:], out=self.table[j][:-half])

    def maxima(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The greatest entry of postings a to b (not included), -1 where there are none."""
        size = b - a
        some = size > 0
        j = np.frexp(np.maximum(size, 1))[1] - 1
        at = np.where(some, a, 0)
        out = np.maximum(self.table[j, at], self.table[j, np.where(some, b - (1 << j), 0)])
        return np.where(some, out, -1)

    def search(self, item: int | None, k: int, floor: int, rounds: int | None) -> list[tuple[int, int]]:
        """Up to ``k`` best (score, place) of at least ``floor``, among them all that belong to the overall best."""
        terms = np.array(self.items[item])
        base = terms * self.stride
        best: list[tuple[int, int]] = []
        low = np.zeros(1, np.int64)
        high = np.full(1, len(self.ids), np.int64)
        a, b = self.starts[terms][None, :], self.ends[terms][None, :]
        entries = self.maxima(a, b)
        bounds = np.where(entries >= 0, entries >> PLACE_BITS, 0).sum(axis=1)
        width = 1
        while rounds is None or rounds > 0:
            floor = max(floor, best[k - 1][0] if len(best) >= k else 0, 1)
            # At the floor itself only ids below the k-th best's can enter.
            last = best[k - 1][1] if len(best) >= k and best[k - 1][0] == floor else len(self.ids)
            live = (bounds > floor) | (bounds == floor) & (low < last)
            if not live.any():
                break
            low, high, a, b, entries, bounds = (x[live] for x in (low, high, a, b, entries, bounds))
            order = np.lexsort((low, -bounds))
            taken, left = order[:width], order[width:]
            width = min(2 * width, ROUND)
            # The document of the greatest impact of any term.
            split = (BLOCK_DOCUMENTS - 1) - (entries[taken].max(axis=1) & (BLOCK_DOCUMENTS - 1))
            wanted = base[None, :] + split[:, None]
            p = np.searchsorted(self.keys, wanted)
            hit = self.keys[np.minimum(p, len(self.keys) - 1)] == wanted
            scores = np.where(hit, self.impacts[np.minimum(p, len(self.impacts) - 1)], 0).sum(axis=1)
            best += [(s, d) for s, d in zip(scores.tolist(), split.tolist(), strict=True) if s >= floor]
            best = sorted(best, key=lambda x: (-x[0], x[1]))[:k]
            lows = np.concatenate([low[taken], split + 1])
            highs = np.concatenate([split, high[taken]])
            starts = np.concatenate([a[taken], p + hit])
            ends = np.concatenate([p, b[taken]])
            found = self.maxima(starts, ends)
            sums = np.where(found >= 0, found >> PLACE_BITS, 0).sum(axis=1)
            low, high = np.concatenate([low[left], lows]), np.concatenate([high[left], highs])
            a, b = np.concatenate([a[left], starts]), np.concatenate([b[left], ends])
            entries, bounds = np.concatenate([entries[left], found]), np.concatenate([bounds[left], sums])
            if rounds is not None:
                rounds -= 1
        return best


FOUND = pa.schema([("item_id", pa.int64()), ("doc_id", pa.int64()), ("score", pa.int64())])


def _search(k: int, n_docs: int, n_terms: int, rounds: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell rows sorted by (group, block, term): the ids first, as their row has the empty term."""

        def searched(ids, lengths, lists):
            floors = {item: floor for own, _, _, _ in lists for item, floor in own}
            if lists:
                named = [([item for item, _ in own], *rest) for own, *rest in lists]
                cell = Cell(ids, lengths, named, n_docs, n_terms)
                for item in cell.items:
                    for score, place in cell.search(item, k, floors[item], rounds):
                        yield item, ids[place], score

        def rows():
            last, ids, lengths, lists = None, None, None, []
            for batch in batches:
                names = [batch.schema.get_field_index(n) for n in ("group", "block", "term", "items", "weight")]
                columns = [batch.column(i).to_pylist() for i in names]
                places, counts = (batch.column(batch.schema.get_field_index(n)) for n in ("places", "counts"))
                for i, (group, block, term, items, weight) in enumerate(zip(*columns, strict=True)):
                    if (group, block) != last:
                        if last is not None:
                            yield from searched(ids, lengths, lists)
                        last, lists = (group, block), []
                    own = counts[i].values.to_numpy()
                    if term == "":
                        ids, lengths = places[i].as_py(), own
                    else:
                        lists.append(([(x["item_id"], x["floor"]) for x in items], weight, places[i].values.to_numpy(), own))
            if last is not None:
                yield from searched(ids, lengths, lists)

        return record_batches(rows(), FOUND)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(indexed: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` best documents of each of ``items`` (item_id, text) in an index: item_id, rank, doc_id, score."""
    spark = indexed.sparkSession
    blocks = indexed.filter("term = ''")
    n_docs, n_terms = blocks.agg(
        F.sum(F.size("places")), F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x))
    ).first()
    queries = written(item_terms(items), "search-terms")
    n_items = queries.select("item_id").distinct().count()
    if not n_docs or not n_items:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    n_groups = math.ceil(n_items / GROUP_ITEMS)
    grouped = queries.withColumn("group", F.pmod(F.xxhash64("item_id"), F.lit(n_groups)))
    wanted = indexed.join(queries.select("term").distinct(), "term", "left_semi")
    held = written(wanted, "search-postings")
    df = held.groupBy("term").agg(F.sum(F.size("places")).alias("df"))
    odds = (2 * F.lit(n_docs) + 2).cast("double") / (2 * F.col("df") + 1).cast("double")
    weights = df.select("term", F.floor(F.lit(1000.0) * F.log(odds)).cast("long").alias("weight"))
    weighed = written(grouped.join(weights, "term"), "search-weights")

    def cells(floors: DataFrame) -> DataFrame:
        named = weighed.join(floors, weighed.item_id.eqNullSafe(floors.floor_item), "left")
        own = F.struct("item_id", F.coalesce("floor", F.lit(0)).cast("long").alias("floor"))
        # At most the items of a group.
        by_term = named.groupBy("group", "term").agg(F.collect_list(own).alias("items"), F.max("weight").alias("weight"))
        postings = held.join(by_term, "term").select("group", "block", "term", "items", "weight", "places", "counts")
        every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long")))
        headed = blocks.withColumn("group", every).select(
            "group", "block", "term", F.expr("cast(null as array<struct<item_id: bigint, floor: bigint>>)").alias("items"),
            F.lit(0).cast("long").alias("weight"), "places", "counts",
        )
        both = postings.unionByName(headed)
        return both.repartition("group", "block").sortWithinPartitions("group", "block", "term")

    none = spark.createDataFrame([], "floor_item long, floor long")
    schema = "item_id long, doc_id long, score long"
    first = _best(cells(none).mapInArrow(_search(k, n_docs, n_terms, FIRST_ROUNDS), schema), k)
    floors = first.filter(F.col("rank") == k).select(F.col("item_id").alias("floor_item"), F.col("score").alias("floor"))
    found = cells(written(floors, "search-floors")).mapInArrow(_search(k, n_docs, n_terms, None), schema)
    return _best(found, k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
