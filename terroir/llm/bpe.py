"""Byte-level BPE in DuckDB: recursive contraction to encode, ordered aggregation to decode.

Every Spark task holds an in-memory DuckDB with the merge table: a row for each way to cut a vocabulary token into two
others, with the rank of the token. A batch's distinct words become token-position rows, one per byte; a row has the
id of the token before it as well, so that it is a pair. A recursive query joins the pairs with the merge table and
contracts the leftmost pair of minimum rank of each word, step by step, until no pair of the word is in the table.
Words done in fewer steps leave the recursion.

The recursion keeps the rows of all its steps, about half the square of a word's bytes. So the words of one query are
bounded by the sum of their squares, and a word of over ``LONG_BYTES`` is contracted by a loop of statements instead,
each of which replaces the word's token table. A step there contracts all places of the least rank at once, the first,
third, … of a run of overlapping ones, up to the first where the new token and a neighbour are a pair of lower rank:
that pair would be taken next, and before it the leftmost place again and again.

Decoding cuts ids before each token that starts with a space and decodes a batch's distinct sequences once: their
(stretch, position, id) rows are joined with the token table, and each stretch's tokens concatenated in order of
position. A document is its sequences put together. A token is stored as text with a character for each of its bytes.

Memory: a batch is cut into groups of texts of about eight million characters (a longer text is a group of its own),
words into chunks of bounded bytes. A dictionary of bounded size keeps the ids of recent pieces of text, so that a
word is contracted once per worker and not once per occurrence. It outlives a task, for the next one of the stage, and is
given back when the worker has had no task for some seconds.

Defined results: a null or empty text has no ids and decodes to empty bytes; null ``doc_id`` passes through; repeated
rows are encoded each; other columns of the input are not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from terroir.llm.common import only, record_batches, texts_of
from terroir.llm.pieces import KEPT, Encodings, grouped, retained

# The characters of Unicode's White_Space property, which is what \s means to the reference library.
WHITE = r"\t-\r \x85\xa0  -     　"

#: One word of the split pattern; most pieces are.
_WORD = re.compile(" ?[A-Za-z]+").fullmatch

#: Bytes of the words contracted by one query, and the sum of their squares: twice the rows that its recursion keeps.
CHUNK_BYTES = 400_000
CHUNK_SQUARES = 3_000_000
#: Characters of the texts encoded at once.
CHARACTERS = 8_000_000
#: Seconds without a task after which a worker forgets its dictionaries.
IDLE_SECONDS = 4
#: Ids that are concatenated by one group of the decoding query.
STRETCH = 512
#: Longer words are contracted by a loop of statements.
LONG_BYTES = 1_500

CONTRACT = """
with recursive tokens(w, step, pos, id, prior, prior_id) as (
  select w, 0::smallint, pos, id, prior, prior_id from start
  union all
  select t.w, (t.step + 1)::smallint, t.pos, if(t.pos = c.place, c.rank, t.id),
         if(t.prior = c.gone, c.place, t.prior), if(t.prior = c.gone, c.rank, t.prior_id)
  from tokens t join (
    select w, (best >> 32)::integer as rank, (best & 4294967295)::integer as place, gone
    from (
      select a.w, min((m.rank::bigint << 32) | a.prior) as best, arg_min(a.pos, (m.rank::bigint << 32) | a.prior) as gone
      from tokens a join merges m on m.left_id = a.prior_id and m.right_id = a.id
      group by a.w
    )
  ) c on c.w = t.w
  where t.pos <> c.gone
)
select w, list(id order by pos) as ids
from tokens join (select w, max(step) as step from tokens group by w) using (w, step)
group by w
"""

#: One step for a long word, from table tokens (pos, id) to the next one. Least are its pairs of least rank, by place.
LEAST = """
create or replace temp table least as
with pairs as (
  select place, gone, nth, rank, before, after
  from (select pos as place, id as left_id, lead(pos) over o as gone, lead(id) over o as right_id,
               row_number() over o as nth, lag(id) over o as before, lead(id, 2) over o as after
        from tokens window o as (order by pos)) join merges using (left_id, right_id)
)
select * from pairs where rank = (select min(rank) from pairs)
"""

STEP = """
create or replace temp table next_tokens as
with runs as (
  select *, nth - row_number() over (order by nth) as run from least
), turns as (
  select *, row_number() over (partition by run order by nth) as turn from runs
), chosen as (
  select place, gone, nth, rank, if(turn > 1, rank, before) as before, after from turns where turn % 2 = 1
), last as (
  select min(nth) as nth from (
    select nth from chosen c join lowering l on l.left_id = c.before and l.right_id = c.rank and l.rank < c.rank
    union all
    select nth from chosen c join lowering l on l.left_id = c.rank and l.right_id = c.after and l.rank < c.rank)
), done as (
  select place, gone, rank from chosen where nth <= coalesce((select nth from last), nth)
)
select t.pos, coalesce(c.rank, t.id) as id
from tokens t left join done c on c.place = t.pos left join done g on g.gone = t.pos
where g.gone is null
"""

DECODE = """
select d, string_agg(token, '' order by pos) as bytes
from (select ids.d, ids.pos, vocabulary.token from ids join vocabulary using (id))
group by d
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Bpe:
    """Encoder and decoder over one rank file. ``pattern`` cuts a text into words that merge separately."""

    def __init__(self, path: str, pattern: str, kept: int | None = None):
        ranks = read_ranks(path)
        self._kept = kept or KEPT
        self._split = regex.compile(pattern.replace(r"[^\s", "[^" + WHITE).replace(r"\s", f"[{WHITE}]").replace(
            r"(?!\S)", f"(?![^{WHITE}])")).findall
        self._db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        tokens = sorted(ranks.items(), key=lambda x: x[1])
        cuts = [
            (ranks[token[:i]], ranks[token[i:]], rank)
            for token, rank in tokens
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        ]
        first, second, rank = (pa.array(x, pa.int32()) for x in zip(*cuts, strict=True))
        self._db.register("m", pa.table({"left_id": first, "right_id": second, "rank": rank}))
        self._db.execute("create table merges as select * from m")
        # Pairs that make a token of lower rank than one of theirs.
        self._db.execute("create table lowering as select * from merges where rank < greatest(left_id, right_id)")
        names = pa.table({"id": pa.array([r for _, r in tokens], pa.int32()), "token": [t.decode("latin-1") for t, _ in tokens]})
        self._db.register("v", names)
        self._db.execute("create table vocabulary as select * from v")
        self._byte = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self._spaced, self._size = np.zeros(tokens[-1][1] + 1, bool), np.zeros(tokens[-1][1] + 1, np.int64)
        self._spaced[[r for t, r in tokens if t[:1] == b" "]] = True
        self._size[[r for _, r in tokens]] = [len(t) for t, _ in tokens]
        self._words: dict[str, bytes] = {}
        self._encodings = Encodings(self._pieces, kept=self._kept + self._kept // 2, unit=4)
        self._lock, self._users, self._last_use = threading.Lock(), 0, 0.0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        return [np.frombuffer(x, "<u4") for x in self._encodings.of_many(texts)]

    @contextmanager
    def in_use(self) -> Iterator[None]:
        """A task's use; some seconds after the last one the dictionaries' memory is given back."""
        with self._lock:
            self._users += 1
        try:
            yield
        finally:
            with self._lock:
                self._users -= 1
                self._last_use = last = time.monotonic()
            timer = threading.Timer(IDLE_SECONDS, self._forget_since, [last])
            timer.daemon = True
            timer.start()

    def _forget_since(self, last: float) -> None:
        with self._lock:
            if not self._users and self._last_use == last:
                self._words = {}
                self._encodings.forget()

    def _pieces(self, texts: list[str]) -> list[bytes]:
        split = [[text] if _WORD(text) else self._split(text) for text in texts]
        words = set().union(*split)
        if len(self._words) > self._kept:
            self._words = retained(self._words, words)
        new = list(words - self._words.keys())
        self._words.update(zip(new, self.contract([w.encode() for w in new]), strict=True))
        get = self._words.__getitem__
        return [get(parts[0]) if len(parts) == 1 else b"".join(map(get, parts)) for parts in split]

    def contract(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, as bytes of little-endian unsigned 32-bit integers."""
        out = [b""] * len(words)
        chunk: list[int] = []
        size = squares = 0
        for i, word in enumerate(words):
            n = len(word)
            if n > LONG_BYTES:
                out[i] = self._contract_long(word)
                continue
            if chunk and (size + n > CHUNK_BYTES or squares + n * n > CHUNK_SQUARES):
                self._contract_into(out, words, chunk)
                chunk, size, squares = [], 0, 0
            chunk.append(i)
            size, squares = size + n, squares + n * n
        if chunk:
            self._contract_into(out, words, chunk)
        return out

    def _contract_into(self, out: list[bytes], words: list[bytes], chunk: list[int]) -> None:
        for i, ids in zip(chunk, self._contract([words[i] for i in chunk]), strict=True):
            out[i] = ids

    def _contract_long(self, word: bytes) -> bytes:
        flat = np.frombuffer(word, np.uint8)
        self._db.register("start", pa.table({"pos": np.arange(len(flat)), "id": self._byte[flat]}))
        self._db.execute("create or replace temp table tokens as select * from start")
        self._db.unregister("start")
        while self._db.execute(LEAST).fetchall()[0][0]:
            self._db.execute(STEP)
            self._db.execute("drop table tokens")
            self._db.execute("alter table next_tokens rename to tokens")
        ids = self._db.execute("select id from tokens order by pos").fetchnumpy()["id"]
        self._db.execute("drop table tokens")
        self._db.execute("drop table least")
        return ids.astype("<u4").tobytes()

    def _contract(self, words: list[bytes]) -> list[bytes]:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        flat = np.frombuffer(b"".join(words), np.uint8)
        pos, ids, firsts = np.arange(len(flat), dtype=np.int32), self._byte[flat], ends - lengths
        prior, prior_id = pos - 1, np.roll(ids, 1)
        prior[firsts] = prior_id[firsts] = -1
        word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
        self._db.register("start", pa.table({"w": word, "pos": pos, "id": ids, "prior": prior, "prior_id": prior_id}))
        found = self._db.sql(CONTRACT).to_arrow_table()
        self._db.unregister("start")
        out = [b""] * len(words)
        lists = found.column("ids").combine_chunks() if found.num_rows else None
        if lists is not None:
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4").tobytes()
            for w, a, b in zip(found.column("w").to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                out[w] = values[4 * a : 4 * b]
        return out

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes that each sequence of ids stands for."""
        stops = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        flat = np.concatenate([np.empty(0, "<u4"), *ids])
        if not len(flat):
            return [b""] * len(ids)
        begins = self._spaced[flat]
        begins[0] = True
        begins[stops[stops < len(flat)]] = True
        at = np.flatnonzero(begins)
        places = pa.py_buffer(np.r_[at, len(flat)] * flat.itemsize)
        cut = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, places, pa.py_buffer(flat)])
        numbered = cut.dictionary_encode()
        decoded = self._decode(numbered.dictionary).take(numbered.indices)
        offsets, data = np.frombuffer(decoded.buffers()[1], np.int64), decoded.buffers()[2].to_pybytes()
        upto = offsets[np.searchsorted(at, stops)].tolist()
        return [data[a:b] for a, b in zip([0, *upto], upto, strict=False)]

    def _decode(self, sequences: pa.LargeBinaryArray) -> pa.LargeBinaryArray:
        """The bytes that each sequence of ids (little-endian unsigned 32-bit integers) stands for."""
        ends = np.cumsum(pc.binary_length(sequences).to_numpy() // 4)
        flat = np.frombuffer(b"".join(sequences.to_pylist()), "<u4").astype(np.int32)
        pos = np.arange(len(flat), dtype=np.int32)
        self._db.register("ids", pa.table({"d": pos // STRETCH, "pos": pos, "id": flat}))
        found = self._db.execute(DECODE).fetchall()
        self._db.unregister("ids")
        data = "".join(text for _, text in sorted(found)).encode("latin-1")
        offsets = np.r_[0, np.cumsum(self._size[flat])[ends - 1]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


_OPEN: dict[tuple[str, str, int | None], Bpe] = {}


def codec(path: str, pattern: str, kept: int | None = None) -> Bpe:
    """The worker's codec of a rank file; its tables are made once."""
    if (path, pattern, kept) not in _OPEN:
        _OPEN[path, pattern, kept] = Bpe(path, pattern, kept)
    return _OPEN[path, pattern, kept]


RESULT = pa.schema(
    [("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
     ("decoded_sha256", pa.string())]
)


def encode_documents(docs: DataFrame, path: str, pattern: str, keep_ids: bool = True, kept: int | None = None) -> DataFrame:
    """Encode and decode every text of ``docs`` (doc_id, text). ``kept`` bounds the words that a worker remembers.

    Returns ``doc_id``, ``ids`` (null unless ``keep_ids``), ``n_tokens``, ``ids_sha256`` of the ids as little-endian
    unsigned 32-bit integers and ``decoded_sha256`` of the bytes decoded from the ids.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = codec(path, pattern, kept)

        def rows():
            for batch in batches:
                doc_ids = iter(batch.column(0).to_pylist())
                for texts in grouped(list(texts_of(batch)), CHARACTERS):
                    encoded = bpe.encode(texts)
                    for ids, decoded in zip(encoded, bpe.decode(encoded), strict=True):
                        yield (
                            next(doc_ids), ids.astype(np.int32) if keep_ids else None, len(ids),
                            hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(decoded).hexdigest(),
                        )

        with bpe.in_use():
            yield from record_batches(rows(), RESULT, 500)

    schema = "doc_id long, ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return only(docs, doc_id="long", text="string").mapInArrow(run, schema)
