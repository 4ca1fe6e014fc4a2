"""Removal of long repeats: interval trees over enhanced suffix arrays, built where repeats can be.

A string of ``length`` bytes that occurs more than once is found through its *anchor*: of the rolling hashes of all its
32-byte windows, the least (the leftmost of equals). Equal strings have equal anchors at equal offsets. In a text, an
anchor owns a run of consecutive string starts; the text from the first of these to the end of the last string is the
anchor's context. So all copies of a string lie in contexts of one anchor hash, at one offset from the anchor, and
anchors whose hash occurs once (about one in ``length``/2 bytes is an anchor) need no further look.

Contexts of one hash are compared in three steps:

* Contexts with equal digests are whole copies: all their strings repeat. They are counted before any shuffle, and one of
  them stands for all. In a text that repeats a few words over and over, each round is a context equal to the one before
  it: such a run of contexts is one row from the start, however long the text.
* The distinct contexts of a hash are suffix-sorted in buckets of equal anchor offset (suffixes of other buckets share no
  ``length`` bytes). A stack scan over the longest common prefixes of neighbours yields the tree of intervals; an
  interval whose suffixes have different bytes to the left (or start a context) is a maximal repeat within the contexts,
  and its suffixes are all its occurrences. A longer repeat appears as overlapping repeats of successive contexts.
* A hash with more than ``GROUP`` distinct contexts is never collected: there the roots of the interval trees (strings of
  exactly ``length`` bytes) are counted by digest, pre-aggregated.

:func:`without_repeats` can also remove repeats of a number of words, whatever their bytes. There a text is the row of its
words' 8-byte digests (what stands between words doesn't count; a character of a script without spaces is a word), and
the same search runs over these bytes with ``8 * words`` as the length: found spans are rounded to whole words. A string
of ``length`` bytes that has that many whole words inside is then left to the search by words; the search by bytes looks
only where a string has fewer.

The spans of maximal repeats are what is removed. Texts meet their spans by ``doc_id`` and a 64-bit hash of the text, so
that rows which share an id keep apart.

Defined results: null text is empty; a text shorter than ``length`` keeps everything; repeated rows are documents with
equal texts; null and repeated ``doc_id`` pass through; other columns are not read, or pass through.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from terroir.llm.common import only, record_batches
from terroir.storage import written

LENGTH = 400
HASHED = 32
#: Distinct contexts of one hash that a task compares: some 20 MB.
GROUP = 32768
SLAB = 1 << 19
_LOCAL = np.uint64((1 << 20) - 1)
#: Bytes of a word's digest.
DIGEST = 8
#: Thai, Lao, Burmese, Khmer, kana and Han: no spaces between words.
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORD = re.compile(f"[{_DENSE}]|[^\\W{_DENSE}]+")


def _rolled(data: np.ndarray) -> np.ndarray:
    """Mixed polynomial hash of the ``HASHED`` bytes from each position."""
    h = data.astype(np.uint64) + np.uint64(1)
    multiplier, size = 0x9E3779B97F4A7C15, 1
    while size < HASHED:
        h = h[:-size] * np.uint64(multiplier) + h[size:]
        multiplier, size = multiplier * multiplier % (1 << 64), 2 * size
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ h >> np.uint64(32)


def anchors(data: bytes, length: int = LENGTH) -> list[tuple[int, int, int, int]]:
    """(hash, anchor, first, last start owned) for the anchors of ``data`` in order."""
    flat, out = np.frombuffer(data, np.uint8), []
    starts, window = len(data) - length + 1, length - HASHED + 1
    for begin in range(0, max(0, starts), SLAB):
        end = min(starts, begin + SLAB)
        h = _rolled(flat[begin : end + length - 1])
        # Position in the low bits: of equal hashes the leftmost is least.
        least = h & ~_LOCAL | np.arange(len(h), dtype=np.uint64)
        size = 1
        while 2 * size <= window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < window:
            least = np.minimum(least[: len(least) - (window - size)], least[window - size :])
        at = (least & _LOCAL).astype(np.int64)
        cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[cut[1:], len(at)] - 1
        made = list(zip(h[at[cut]].view(np.int64).tolist(), (at[cut] + begin).tolist(), (cut + begin).tolist(), (last + begin).tolist(), strict=True))
        if out and made[0][1] == out[-1][1]:
            out[-1] = (*out[-1][:3], made.pop(0)[3])  # an anchor whose run the slab's end had cut
        out += made
    return out


def _common(a: bytes, b: bytes, length: int) -> int:
    """Bytes that two suffixes have in common; 0 if fewer than ``length``."""
    if a[:length] != b[:length]:
        return 0
    n = min(len(a), len(b))
    differ = int.from_bytes(a[length:n]) ^ int.from_bytes(b[length:n])
    return n - (differ.bit_length() + 7) // 8


def interval_tree(suffixes: list[bytes], lefts: list[int], length: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Suffix order and the left-diverse intervals (common length, first, last place in the order), children first.

    ``lefts`` has the byte to the left of each suffix, -1 where there is none: that differs from any other.
    """
    order = sorted(range(len(suffixes)), key=suffixes.__getitem__)
    found: list[tuple[int, int, int]] = []
    stack: list[list[int]] = []  # open intervals: common length, first place, left byte or -1 if they differ
    for i in range(1, len(order) + 1):
        common = _common(suffixes[order[i - 1]], suffixes[order[i]], length) if i < len(order) else 0
        first, left = i - 1, lefts[order[i - 1]]
        while stack and stack[-1][0] > common:
            depth, first, other = stack.pop()
            left = left if left == other else -1
            if left < 0:
                found.append((depth, first, i - 1))
        if stack and stack[-1][0] == common:
            if stack[-1][2] != left:
                stack[-1][2] = -1
        elif common:
            stack.append([common, first, left])
    return order, found


def tree_repeats(contexts: list[tuple[bytes, int, int]], length: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats within ``contexts`` (bytes, anchor, number of starts): (length, [(context, start), ...])."""
    buckets: dict[int, list[int]] = {}
    for c, (_, anchor, starts) in enumerate(contexts):
        for offset in range(anchor - starts + 1, anchor + 1):
            buckets.setdefault(offset, []).append(c)
    for offset, members in buckets.items():
        if len(members) < 2:
            continue
        places = [contexts[c][1] - offset for c in members]
        suffixes = [contexts[c][0][p:] for c, p in zip(members, places, strict=True)]
        lefts = [contexts[c][0][p - 1] if p else -1 for c, p in zip(members, places, strict=True)]
        order, found = interval_tree(suffixes, lefts, length)
        for common, first, last in found:
            yield common, [(members[i], places[i]) for i in order[first : last + 1]]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, as maximal runs in order."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


#: Rows name a text by ``doc_id`` and a 64-bit hash of the text. ``place`` packs the first start that an anchor owns and,
#: counted from it, the anchor and the last start. ``run`` packs how many equal contexts follow at once, and their starts.
ANCHORS_SQL = "hash long, digest long, doc_id long, text_hash long, place long, run long"
ANCHORS = pa.schema([(c, pa.int64()) for c in ("hash", "digest", "doc_id", "text_hash", "place", "run")])
#: The contexts that rows of anchors stand for.
COUNT_SQL = "sum(1 + (run >> 32))"
SPANS_SQL = "doc_id long, text_hash long, a int, b int"
SPANS = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])
CONTEXTS_SQL = "hash long, single boolean, doc_id long, text_hash long, place long, context binary"
CONTEXTS = pa.schema(
    [("hash", pa.int64()), ("single", pa.bool_()), ("doc_id", pa.int64()), ("text_hash", pa.int64()),
     ("place", pa.int64()), ("context", pa.binary())]
)


def unpacked(place: int) -> tuple[int, int, int]:
    """First start, anchor and last start; the latter two from the first."""
    return place >> 32, place >> 16 & 0xFFFF, place & 0xFFFF


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return only(docs, doc_id="long", text="string").select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("text"))


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _digests(text: str) -> bytes:
    """The digests of the words of ``text``, one after the other."""
    return b"".join(map(xxhash.xxh3_64_digest, _WORD.findall(text)))


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word, and the byte after its last."""
    places = np.fromiter((x for m in _WORD.finditer(text) for x in m.span()), np.int64)
    if not text.isascii():
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        sizes = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
        places = np.r_[0, np.cumsum(sizes)][places]
    return places[::2], places[1::2]


def sparse_starts(text: str, length: int, words: int) -> np.ndarray:
    """Whether fewer than ``words`` words are inside of the string of ``length`` bytes from each byte.

    Inside is four bytes (a character) from its ends, so that equal strings have the same words inside.
    """
    starts, ends = word_places(text)
    size = len(text.encode())
    begun, done = (np.cumsum(np.bincount(x, minlength=size + 1), dtype=np.int32) for x in (starts, ends))
    n = max(0, size - length + 1)
    return done[length - 4 : length - 4 + n] - begun[3 : 3 + n] < words


def _data(text: pa.StringScalar, digests: bool) -> bytes:
    return _digests(text.as_py()) if digests else text.as_buffer().to_pybytes()


def _runs(contexts: Iterator[tuple[int, int, int, int, int]]) -> Iterator[tuple[int, int, int, int]]:
    """(hash, digest, place, run) for a text's contexts (hash, digest, anchor, first, last): a row for equal neighbours."""
    row = None
    for h, digest, at, first, last in contexts:
        if row and row[:2] == [h, digest] and first == end + 1:
            row[3] += (1 << 32) + last + 1 - first
        else:
            if row:
                yield tuple(row)
            row = [h, digest, first << 32 | at - first << 16 | last - first, 0]
        end = last
    if row:
        yield tuple(row)


def _anchor_rows(length: int, words: int | None, digests: bool):
    digest = xxhash.xxh3_64_intdigest

    def contexts(data: bytes, sparse: np.ndarray | None) -> Iterator[tuple[int, int, int, int, int]]:
        for h, at, first, last in anchors(data, length):
            if sparse is None or sparse[first] < sparse[last + 1]:
                yield h, _signed(digest(data[first : last + length])), at, first, last

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for doc, text_hash, text in zip(*batch.columns, strict=True):
                    data, key = _data(text, digests), (doc.as_py(), text_hash.as_py())
                    sparse = None
                    if words and len(data) >= length:
                        sparse = np.r_[0, np.cumsum(sparse_starts(text.as_py(), length, words))]
                        if not sparse[-1]:
                            continue
                    for h, context, place, equal in _runs(contexts(data, sparse)):
                        yield h, context, *key, place, equal

        return record_batches(rows(), ANCHORS, 20_000)

    return run


def _context_rows(length: int, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The wanted contexts of each text."""

        def rows():
            for batch in batches:
                for doc, text_hash, text, wanted in zip(*batch.columns, strict=True):
                    data, key = _data(text, digests), (doc.as_py(), text_hash.as_py())
                    for w in wanted.as_py():
                        first, _, last = unpacked(w["place"])
                        yield w["hash"], w["single"], *key, w["place"], data[first : first + last + length]

        return record_batches(rows(), CONTEXTS, 5_000)

    return run


def _grouped_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each hash, from rows sorted by it."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if group and group[-1][0] != row[0]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _compared(group: list[tuple]) -> list[tuple[bytes, int, int]]:
    """The contexts of a hash's rows, as :func:`tree_repeats` takes them."""
    places = [unpacked(row[4]) for row in group]
    return [(row[5], anchor, last + 1) for row, (_, anchor, last) in zip(group, places, strict=True)]


def _tree_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Removed spans of the contexts that occur once, by the maximal repeats of each hash."""

        def rows():
            for group in _grouped_contexts(batches):
                spans: dict[int, list[tuple[int, int]]] = {}
                for common, occurrences in tree_repeats(_compared(group), length):
                    for c, start in occurrences:
                        if group[c][1]:
                            spans.setdefault(c, []).append((start, start + common))
                for c, found in spans.items():
                    _, _, doc, text_hash, place, _ = group[c]
                    for a, b in merged(found):
                        yield doc, text_hash, (place >> 32) + a, (place >> 32) + b

        return record_batches(rows(), SPANS, 20_000)

    return run


REPEATS_SQL = "length int, text string, occurrences array<struct<doc_id: long, text_hash: long, start: int>>"


def _tree_groups(length: int):
    kinds = pa.struct([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int32())])
    schema = pa.schema([("length", pa.int32()), ("text", pa.string()), ("occurrences", pa.list_(kinds))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for group in _grouped_contexts(batches):
                contexts = _compared(group)
                for common, occurrences in tree_repeats(contexts, length):
                    c, start = occurrences[0]
                    text = contexts[c][0][start : start + common].decode(errors="replace")
                    yield common, text, [
                        {"doc_id": group[c][2], "text_hash": group[c][3], "start": (group[c][4] >> 32) + s}
                        for c, s in occurrences
                    ]

        return record_batches(rows(), schema, 200)

    return run


ROOTS_SQL = "hash long, root long, doc_id long, text_hash long, a int, single boolean"
ROOTS = pa.schema(
    [("hash", pa.int64()), ("root", pa.int64()), ("doc_id", pa.int64()), ("text_hash", pa.int64()), ("a", pa.int32()),
     ("single", pa.bool_())]
)


def _root_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each string of the contexts of a hot hash."""

        def rows():
            digest = xxhash.xxh3_64_intdigest
            for batch in batches:
                for h, single, *key, place, context in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    first, _, last = unpacked(place)
                    for i in range(last + 1):
                        yield h, _signed(digest(context[i : i + length])), *key, first + i, single

        return record_batches(rows(), ROOTS, 20_000)

    return run


class Repeats:
    """The repeats of ``length`` bytes or more in a table of documents (doc_id, text).

    With ``digests``, of that many bytes in the row of their words' digests. With ``words``, only contexts with a string
    that has fewer words inside.
    """

    def __init__(self, docs: DataFrame, length: int = LENGTH, group: int = GROUP, words: int | None = None, digests: bool = False):
        if not HASHED < length < 1 << 16:
            raise ValueError(f"length must be above {HASHED} and below {1 << 16}")
        self.length, self.group, self.digests = length, group, digests
        self.docs = _hashed(docs)
        anchored = written(self.docs.mapInArrow(_anchor_rows(length, words, digests), ANCHORS_SQL), "repeat-anchors")
        # Written, so that the join has shuffles of its own on both sides and splits a hot hash.
        often = written(anchored.groupBy("hash").agg(F.expr(COUNT_SQL).alias("n")).filter("n > 1").select("hash"), "repeat-often")
        self.repeated = written(anchored.join(often, "hash"), "repeat-again")
        # A context that stands for its copies; firsts come from one row, and writing fixes which.
        firsts = [F.first(c).alias(c) for c in ("doc_id", "text_hash", "place")]
        kinds = self.repeated.groupBy("hash", "digest").agg(F.expr(COUNT_SQL).alias("n"), *firsts)
        self.kinds = written(kinds, "repeat-kinds")
        sizes = self.kinds.groupBy("hash").agg(F.count("*").alias("kinds"), F.min("n").alias("least"))
        self.open = written(sizes.filter("kinds > 1 and least = 1").select("hash", "kinds"), "repeat-open")

    def contexts(self, which: str) -> DataFrame:
        """The distinct contexts of hashes that have a context which occurs once, where ``which`` holds of their number."""
        wanted = self.kinds.join(self.open.filter(which).select("hash"), "hash")
        what = F.collect_list(F.struct("hash", (F.col("n") == 1).alias("single"), "place")).alias("wanted")
        wanted = wanted.groupBy("doc_id", "text_hash").agg(what)
        same = [F.col(f"d.{c}").eqNullSafe(F.col(f"w.{c}")) for c in ("doc_id", "text_hash")]
        texts = self.docs.alias("d").join(wanted.alias("w"), same).select("d.*", "w.wanted")
        return texts.mapInArrow(_context_rows(self.length, self.digests), CONTEXTS_SQL)

    def _by_hash(self) -> DataFrame:
        ordinary = self.contexts(f"kinds <= {self.group}")
        return ordinary.repartition("hash").sortWithinPartitions("hash")

    def groups(self) -> DataFrame:
        """Maximal repeats of ordinary hashes: ``length``, ``text``, ``occurrences`` (doc_id, text hash, start).

        An occurrence in a context that has copies stands for all of them.
        """
        return self._by_hash().mapInArrow(_tree_groups(self.length), REPEATS_SQL)

    def spans(self) -> DataFrame:
        """``doc_id``, ``text_hash`` and the ``spans`` to remove (array of a, b; they may overlap)."""
        copies = self.repeated.join(self.kinds.filter("n > 1").select("hash", "digest"), ["hash", "digest"])
        first, last = "cast(place >> 32 as int)", "cast(place & 65535 as int)"
        end = f"{first} + {last} + cast(run & 4294967295 as int) + {self.length}"
        every = copies.selectExpr("doc_id", "text_hash", f"{first} as a", f"{end} as b")
        every = every.unionByName(self._by_hash().mapInArrow(_tree_spans(self.length), SPANS_SQL))
        if not self.open.filter(f"kinds > {self.group}").isEmpty():
            crowd = self.contexts(f"kinds > {self.group}").mapInArrow(_root_rows(self.length), ROOTS_SQL)
            crowd = written(crowd, "repeat-roots")
            often = crowd.groupBy("hash", "root").agg(F.count("*").alias("n")).filter("n > 1").select("hash", "root")
            often = written(often, "repeat-often")
            starts = crowd.filter("single").join(often, ["hash", "root"])
            every = every.unionByName(starts.selectExpr("doc_id", "text_hash", "a", f"a + {self.length} as b"))
        return every.distinct().groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("a", "b")).alias("spans"))


def _spanned(rows: DataFrame, spans: DataFrame, *columns: str) -> DataFrame:
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"s.{c}")) for c in ("doc_id", "text_hash")]
    return rows.alias("d").join(spans.alias("s"), same, "left").select(*(f"d.{c}" for c in columns), "s.spans")


def _kept(data: bytes, spans: list[dict] | None) -> tuple[bytes, list[tuple[int, int]]]:
    runs = merged([(s["a"], s["b"]) for s in spans or ()])
    kept, start = [], 0
    for a, b in runs:
        kept.append(data[start:a])
        start = b
    kept.append(data[start:])
    return b"".join(kept), runs


RESULT_SQL = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, text string"
RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
     ("kept_sha256", pa.string()), ("text", pa.string())]
)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for batch in batches:
            for doc, text, spans in zip(*batch.columns, strict=True):
                data = text.as_buffer().to_pybytes()
                kept, runs = _kept(data, spans.as_py())
                # Characters of which a byte is removed aren't in the text.
                edges = [0, *(x for run in runs for x in run), len(data)]
                parts = [data[a:b].decode(errors="ignore") for a, b in zip(edges[::2], edges[1::2], strict=True)]
                yield doc.as_py(), len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), "".join(parts)

    return record_batches(rows(), RESULT, 500)


def removal_report(docs: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and the kept ``text`` of every document."""
    found = Repeats(docs, length, group)
    return _spanned(found.docs, found.spans(), "doc_id", "text").mapInArrow(_report, RESULT_SQL)


def _word_runs(text: str, spans: list[dict]) -> list[dict]:
    """The bytes of the whole words that ``spans`` over digests cover."""
    starts, ends = word_places(text)
    runs = [(-(-a // DIGEST), b // DIGEST) for a, b in merged([(s["a"], s["b"]) for s in spans])]
    return [{"a": int(starts[a]), "b": int(ends[b - 1])} for a, b in runs if a < b]


def without_repeats(docs: DataFrame, length: int = LENGTH, group: int = GROUP, words: int | None = None) -> DataFrame:
    """``docs`` with all columns, its ``text`` without repeats and ``n_chars``, if there, counted anew.

    Repeats have ``length`` bytes or more; or, if given, ``words`` words or more. A character of which a byte is removed
    goes as a whole.
    """
    schema = StructType(docs.schema.fields)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, spans = batch.columns
            columns = dict(zip(names, row.flatten(), strict=True))
            texts = []
            for text, found in zip(columns["text"], spans, strict=True):
                if found.is_valid and text.is_valid:
                    every = found.as_py()
                    plain = [s for s in every if not s["digests"]]
                    plain += _word_runs(text.as_py(), [s for s in every if s["digests"]])
                    texts.append(_kept(text.as_buffer().to_pybytes(), plain)[0].decode(errors="ignore"))
                else:
                    texts.append(text.as_py())
            columns["text"] = pa.array(texts, columns["text"].type)
            if "n_chars" in columns:
                counts = [None if t is None else len(t) for t in texts]
                columns["n_chars"] = pa.array(counts, pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    def spans(found: Repeats) -> DataFrame:
        each = found.spans().select("doc_id", "text_hash", F.explode("spans").alias("s"))
        return each.select("doc_id", "text_hash", F.struct("s.a", "s.b", F.lit(found.digests).alias("digests")).alias("s"))

    every = spans(Repeats(docs, length, group, words))
    if words:
        every = every.unionByName(spans(Repeats(docs, DIGEST * words, group, digests=True)))
    every = every.groupBy("doc_id", "text_hash").agg(F.collect_list("s").alias("spans"))
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(text).alias("text_hash"))
    return _spanned(rows, every, "row").mapInArrow(run, schema)
