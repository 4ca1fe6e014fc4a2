"""Token ids in length-delimited binary records, with an offset index for shuffled reads.

A record is one serialized sequence in a frame::

    length   unsigned 64-bit, bytes of the payload
    check    unsigned 32-bit, masked checksum of the length field
    payload  the ids, little-endian unsigned integers of ``width`` bytes (2 if every id of the vocabulary fits)
    check    unsigned 32-bit, masked checksum of the payload

all little-endian. The checksum is the CRC-32 of zlib; masked means rotated right by 15 bits plus a constant, modulo
2^32, so that a checksum of data that holds checksums stays meaningful.

Documents are sorted by ``doc_id`` over range partitions (nulls first, ties by text), and each task encodes its range
and writes one file of records in that order to the shared folder. The file's name is new for each attempt; the index
rows that the task returns name it, and Spark keeps the rows of the attempt that succeeded only. So lost executors,
retried or speculative tasks leave at most unread files. The index is a Parquet table ``file, part, seq, doc_id,
offset, n_tokens, first, width``; any order of its rows reads any order of records.

Reading seeks to the records of the index rows it was given, checks both checksums and yields the ids.

Defined results: a null or empty text is a record of the end id alone; a null ``doc_id`` comes first and passes through;
ties of ``doc_id`` are ordered by text, repeated rows are records each; an empty table gives an empty index and no rows;
other columns are not read. A text of any length is encoded whole.
"""

from __future__ import annotations

import gc
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches, texts_of
from terroir.llm.pieces import Split, grouped
from terroir.storage import new_path

#: Distinct words encoded in one call, and characters of the texts that are encoded together.
WORDS, CHARACTERS = 100_000, 16_000_000

HEADER = struct.Struct("<QI")
CHECK = struct.Struct("<I")
MASK = 0xA282EAD8

INDEX = pa.schema(
    [("file", pa.string()), ("part", pa.int64()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("offset", pa.int64()),
     ("n_tokens", pa.int64()), ("first", pa.int64()), ("width", pa.int32())]
)
INDEX_SQL = "file string, part long, seq long, doc_id long, offset long, n_tokens long, first long, width int"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, CHECK.pack(masked(length)), payload, CHECK.pack(masked(payload))))


def unframed(stream, offset: int) -> bytes:
    """The payload of the record at ``offset``; raises ValueError if a checksum differs."""
    stream.seek(offset)
    head = stream.read(HEADER.size)
    length, check = HEADER.unpack(head)
    if masked(head[:8]) != check:
        raise ValueError(f"length damaged at {offset}")
    payload = stream.read(length)
    tail = stream.read(CHECK.size)
    if len(payload) != length or len(tail) != CHECK.size or masked(payload) != CHECK.unpack(tail)[0]:
        raise ValueError(f"record damaged at {offset}")
    return payload


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or of a plain local path."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Tokens:
    """Token ids of texts by a tokenizers file, as bytes; equal pieces of the texts given together are encoded once.

    A text that holds the string of an added token (an end mark, say) is encoded whole, by the plain call.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self._tokenizer.get_vocab()
        self.width = 2 if max(vocabulary.values(), default=0) < 1 << 16 else 4
        # A byte-level token has a character for each of its bytes.
        self._lengths = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self._lengths[i] = len(token)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        whole = [i for i, text in enumerate(texts) if any(mark in text for mark in self._added)]
        out = self._pieces(["" if any(mark in text for mark in self._added) else text for text in texts] if whole else texts)
        for i in whole:
            out[i] = self._each([texts[i]])[0]
        return out

    def _pieces(self, texts: list[str]) -> list[bytes]:
        split = Split.of(texts)
        if split is None:
            return [b""] * len(texts)
        used, unit = split.used(), f"<u{self.width}"
        words = split.words.filter(pa.array(used))
        parts = [self._words(words.slice(i, WORDS)) for i in range(0, len(words), WORDS)]
        firsts = self._each(split.firsts)
        parts.append((np.frombuffer(b"".join(firsts), unit), np.array([len(x) // self.width for x in firsts], np.int64)))
        ids, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        return split.joined(len(texts), used, ids, sizes)

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that a space stands before, and how many each has.

        They are encoded as one text, since no token crosses from one to the next; bytes tell where words end.
        """
        unit = f"<u{self.width}"
        strings = words.to_pylist()
        if not any(" " in mark for mark in self._added):
            found = self._tokenizer.encode_batch_fast([" " + " ".join(strings)], add_special_tokens=False)[0].ids
            ids = np.array(found, np.int64)
            ends = np.cumsum(self._lengths[ids])
            wanted = np.cumsum(pc.binary_length(words).to_numpy() + 1)
            at = np.searchsorted(ends, wanted)
            if len(ids) and ends[-1] == wanted[-1] and (ends[at] == wanted).all():
                return ids.astype(unit), np.diff(np.r_[-1, at])
        each = self._each([" " + w for w in strings])  # some byte has no token of its own
        return np.frombuffer(b"".join(each), unit), np.array([len(x) // self.width for x in each], np.int64)

    def _each(self, texts: list[str]) -> list[bytes]:
        kind = "H" if self.width == 2 else "I"
        encoded = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)  # without offsets into the texts
        return [array(kind, e.ids).tobytes() for e in encoded]


_OPEN: dict[str, Tokens] = {}


def tokens(path: str) -> Tokens:
    """The worker's tokenizer of a file."""
    if path not in _OPEN:
        _OPEN[path] = Tokens(path)
    return _OPEN[path]


def write_records(docs: DataFrame, tokenizer: str, end_id: int, folder: str) -> str:
    """Write every text of ``docs`` (doc_id, text) as a record of its ids and ``end_id``; returns the index's path.

    ``tokenizer`` names a file of the tokenizers library, one that cuts words by the GPT-2 pattern, present on every
    executor. A null or empty text is a record of ``end_id`` alone. ``end_id`` must fit the ids' width.
    """
    records, index = f"{folder}/records", f"{folder}/index"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, part = tokens(tokenizer), TaskContext.get().partitionId()
        end = end_id.to_bytes(coder.width, "little")
        system, base = opened(records)
        system.create_dir(base, recursive=True)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.rec"
        seq = offset = first = 0

        def rows(out):
            nonlocal seq, offset, first
            for batch in batches:
                doc_ids = iter(batch.column(0).to_pylist())
                for texts in grouped(list(texts_of(batch)), CHARACTERS):
                    for ids in coder.encode_many(texts):
                        frame = framed(ids + end)
                        out.write(frame)
                        n = len(ids) // coder.width + 1
                        yield f"{records}/{name}", part, seq, next(doc_ids), offset, n, first, coder.width
                        seq, offset, first = seq + 1, offset + len(frame), first + n

        gc.disable()  # lists of millions of words, none of them in a cycle
        try:
            with system.open_output_stream(f"{base}/{name}") as out:
                yield from record_batches(rows(out), INDEX)
        finally:
            gc.enable()

    ordered = only(docs, doc_id="long", text="string").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, INDEX_SQL).write.parquet(index)
    return index


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("ids", pa.list_(pa.int64())),
     ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def read_records(spark: SparkSession, index: str, keep_ids: bool = True) -> DataFrame:
    """The records that an index table names, read back by offset and checked.

    Returns ``doc_id``, ``start`` (ids of all records before it in file order), ``ids`` (null unless ``keep_ids``),
    ``n_tokens`` and ``ids_crc32``, the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            name, stream = None, None
            for batch in batches:
                for file, doc, offset, width, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if file != name:
                        if stream:
                            stream.close()
                        system, path = opened(file)
                        name, stream = file, system.open_input_file(path)
                    ids = np.frombuffer(unframed(stream, offset), f"<u{width}").astype("<u4")
                    yield doc, start, ids if keep_ids else None, len(ids), zlib.crc32(ids.tobytes())

        return record_batches(rows(), RESULT, 500)

    rows = spark.read.parquet(index)
    # One row for each file: at most the number of partitions that wrote.
    files = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = files.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = rows.join(bases, "part").select("file", "doc_id", "offset", "width", (F.col("base") + F.col("first")).alias("start"))
    return placed.mapInArrow(run, "doc_id long, start long, ids array<long>, n_tokens long, ids_crc32 long")


def token_records(docs: DataFrame, tokenizer: str, end_id: int, keep_ids: bool = True) -> DataFrame:
    """Write ``docs`` as records in a new folder of the shared directory and read them back."""
    spark = docs.sparkSession
    index = write_records(docs, tokenizer, end_id, new_path(spark, "records"))
    return read_records(spark, index, keep_ids)
