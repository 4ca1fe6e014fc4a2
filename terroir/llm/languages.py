"""Language identification by error-correcting output codes.

Every language has a codeword: a row of a Hadamard matrix without the columns that tell no two languages apart. Any two
of them differ in at least half of the matrix's columns, so some wrong bits leave the nearest codeword right.

A bit is predicted by a binary n-gram classifier: n-grams of one to ``ORDER`` bytes of the text's letters in lower case,
hashed to ``BUCKETS`` numbers for each n, each with the log of its share among the languages of bit 1 over its share
among those of bit 0 (additive smoothing, each language weighing the same). The margin of a text is the mean of its
n-grams' logs, times a scale that the calibrating documents give.

Decoding weighs losses: calibrating documents, which are not counted, tell how often each bit is right for documents of
each language. The loss of a language is the weighted mean over its bits of log(1 + exp(-margin x sign)), weights in
proportion to how far a bit is better than chance. The least loss wins; its score is its share by exp(-loss) among all,
sharpened by the number of bits. A text whose two least losses differ by less than ``CLOSE`` is flagged as ambiguous.

Training sample: about ``PER_LANGUAGE`` documents of each of the ``LANGUAGES`` most frequent languages, by a hash of
text, a bounded number whatever the size of the table. Counts of n-grams are summed by Spark; the driver gets a number
for each language and bucket. Every document is predicted, from its whole text, and n-grams are taken in slabs.

Defined results: a text that is null or has no letter is ``und`` with score 0; without any training text every
document is; with a single language all others are that language, score 1; ties of loss go to the first language in
order; null ``doc_id`` is an id like others (not held out); repeated rows are predicted each; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches, texts_of

ORDER = 4
BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
#: Bounds of the training sample.
PER_LANGUAGE, LANGUAGES = 10_000, 128
SMOOTHING = 0.5
#: Bytes whose n-grams are hashed at once.
SLAB = 1 << 18
CLOSE = 0.05
UNKNOWN = "und"

_APART = re.compile(r"[\W\d_]+")


def letters(text: str) -> bytes:
    """The words of a text in lower case, each with a blank before and after it; empty if there is no letter."""
    words = _APART.sub(" ", text.lower()).strip(" ")
    return f" {words} ".encode() if any(map(str.isalpha, words)) else b""


def grams(data: bytes) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams; those of n are in the n-th range of ``BUCKETS``."""
    flat = np.frombuffer(data, np.uint8).astype(np.uint32)
    for start in range(0, len(flat), SLAB):
        part = flat[start : start + SLAB + ORDER - 1]
        h = np.zeros(len(part), np.uint32)
        for n in range(1, min(ORDER, len(part)) + 1):
            h = h[: len(part) - n + 1] * np.uint32(0x01000193) + part[n - 1 :] + np.uint32(1)
            own = h[: min(SLAB, len(flat) - start)]
            yield (own * np.uint32(0x9E3779B1) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64) + (n - 1) * BUCKETS


def codewords(n: int) -> np.ndarray:
    """A row of -1 and 1 for each of ``n`` languages; no column is the same for all."""
    size = 1 << max(n, 1).bit_length()
    rows = np.arange(1, n + 1)[:, None] & np.arange(1, size)[None, :]
    code = 1 - 2 * (np.bitwise_count(rows.astype(np.uint64)).astype(np.int64) & 1)
    return code[:, (code != code[:1]).any(axis=0)]


class Model:
    """Codewords, n-gram weights of each bit, scale and weights of losses."""

    def __init__(self, names: list[str], counts: np.ndarray):
        """``counts`` has a row for each language, a column for each bucket."""
        self.names = names
        self.code = codewords(len(names)).astype(np.float32)
        shaped = counts.reshape(len(names), ORDER, BUCKETS) + SMOOTHING
        shares = (shaped / shaped.sum(axis=2, keepdims=True)).reshape(len(names), ORDER * BUCKETS)
        ones = [shares[self.code[:, j] > 0].mean(axis=0) for j in range(self.code.shape[1])]
        zeros = [shares[self.code[:, j] < 0].mean(axis=0) for j in range(self.code.shape[1])]
        logs = [np.log(a / b) for a, b in zip(ones, zeros, strict=True)]
        self.weights = np.stack(logs, axis=1).astype(np.float32) if logs else np.zeros((ORDER * BUCKETS, 0), np.float32)
        self.scale = 1.0
        self.trust = np.ones_like(self.code) / max(1, self.code.shape[1])

    def raw(self, data: bytes) -> np.ndarray:
        """Mean log of the n-grams, for each bit."""
        total, n = np.zeros(self.code.shape[1]), 0
        for part in grams(data):
            total += self.weights[part].sum(axis=0, dtype=np.float64)
            n += len(part)
        return total / max(n, 1)

    def calibrate(self, right: np.ndarray, scale: float) -> None:
        """``right`` is each language's share of right predictions of each bit."""
        better = np.maximum(right - 0.5, 0.01)
        self.trust = (better / better.sum(axis=1, keepdims=True)).astype(np.float32)
        self.scale = scale

    def decode(self, raw: np.ndarray) -> tuple[str, float, bool]:
        """Language, score and whether the second is close."""
        margins = self.code * (raw * self.scale).astype(np.float32)
        loss = (self.trust * np.logaddexp(0, -margins)).sum(axis=1, dtype=np.float64)
        order = np.argsort(loss, kind="stable")
        shares = np.exp(-self.code.shape[1] * (loss - loss[order[0]]))
        close = len(order) > 1 and loss[order[1]] - loss[order[0]] < CLOSE
        return self.names[order[0]], float(1 / shares.sum()), bool(close)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        data = letters(text or "")
        return self.decode(self.raw(data)) if data and self.names else (UNKNOWN, 0.0, False)


def sampled(rows: DataFrame, names: list[str], n_rows: dict[str, int], calibrating: bool) -> DataFrame:
    """``lang``, ``text`` of the training sample: a tenth, by hash, is for calibrating, the rest is counted."""
    shares = [F.lit(x) for name in names for x in (name, min(1.0, PER_LANGUAGE / n_rows[name]))]
    share = F.coalesce(F.create_map(*shares)[F.col("lang")], F.lit(0.0))
    drawn = F.pmod(F.xxhash64("text", "doc_id"), F.lit(1_000_000)) < share * 1_000_000
    tenth = F.pmod(F.xxhash64(F.lit("calibrating"), "text"), F.lit(10)) == 0  # copies on the same side
    return rows.filter(F.col("text").isNotNull() & drawn & (tenth if calibrating else ~tenth)).select("lang", "text")


def gram_counts(rows: DataFrame, names: list[str]) -> np.ndarray:
    """Counts of buckets for each language; a task sums before the shuffle."""
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                own = sums.setdefault(lang, np.zeros(ORDER * BUCKETS, np.int64))
                for part in grams(letters(text)):
                    own += np.bincount(part, minlength=len(own))
        for lang, own in sums.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some)), pa.array(some), pa.array(own[some])], schema=schema)

    summed = rows.mapInArrow(run, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros((len(names), ORDER * BUCKETS))
    place = {name: i for i, name in enumerate(names)}
    found = summed.toArrow()  # at most LANGUAGES x ORDER x BUCKETS numbers
    languages = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    counts[languages, found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def fit(docs: DataFrame) -> Model:
    """A model from ``docs`` (doc_id, text, lang), all of which may be learned from; rows without language are left out."""
    rows = only(docs, doc_id="long", text="string", lang="string").filter("lang is not null")
    frequent = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    n_rows = {r["lang"]: r["count"] for r in frequent.collect()}
    names = sorted(n_rows)
    if not names:
        return Model([], np.zeros((0, ORDER * BUCKETS)))
    counts = gram_counts(sampled(rows, names, n_rows, calibrating=False), names)
    learned = [i for i in range(len(names)) if counts[i].any()]
    model = Model([names[i] for i in learned], counts[learned])
    if len(model.names) > 1:
        _calibrate(model, sampled(rows, names, n_rows, calibrating=True))
    return model


def _calibrate(model: Model, rows: DataFrame) -> None:
    bits = model.code.shape[1]
    schema = pa.schema([("lang", pa.string()), ("bit", pa.int64()), ("n", pa.int64()), ("right", pa.int64()), ("size", pa.float64())])
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        place = {name: i for i, name in enumerate(own.names)}
        n, right, size = (np.zeros((len(own.names), bits)) for _ in range(3))
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch), strict=True):
                data, i = letters(text), place.get(lang)
                if data and i is not None:
                    margins = own.code[i] * own.raw(data)
                    n[i] += 1
                    right[i] += margins > 0
                    size[i] += np.abs(margins)
        rows = (
            (name, j, int(n[i, j]), int(right[i, j]), float(size[i, j]))
            for name, i in place.items() for j in range(bits) if n[i, j]
        )
        return record_batches(rows, schema)

    sums = rows.mapInArrow(run, "lang string, bit long, n long, right long, size double").groupBy("lang", "bit")
    found = sums.agg(F.sum("n").alias("n"), F.sum("right").alias("right"), F.sum("size").alias("size")).collect()
    # A language without calibrating documents trusts all its bits alike.
    share = np.ones((len(model.names), bits))
    place = {name: i for i, name in enumerate(model.names)}
    for r in found:
        share[place[r["lang"]], r["bit"]] = (r["right"] + 1) / (r["n"] + 2)
    total, n = sum(r["size"] for r in sorted(found)), sum(r["n"] for r in found)
    # The usual margin becomes 2.
    model.calibrate(share, round(2 * n / total, 6) if total else 1.0)


PREDICTED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())]
)


def predict(docs: DataFrame, model: Model, held_out: Column) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``ambiguous`` of each row of ``docs`` (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by LANGUAGES and BUCKETS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value

        def rows():
            for batch in batches:
                doc_ids, marks = (batch.column(i).to_pylist() for i in range(2))
                for doc, mark, text in zip(doc_ids, marks, texts_of(batch), strict=True):
                    yield doc, mark, *own.predict(text)

        return record_batches(rows(), PREDICTED)

    rows = only(docs, doc_id="long", text="string").select("doc_id", held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean")


def identify(docs: DataFrame, folds: int = 5) -> DataFrame:
    """Predict every document; documents whose crc32(doc_id) is divisible by ``folds`` are not learned from."""
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False))
    learned = only(docs, doc_id="long", text="string", lang="string").filter(~held_out)
    return predict(docs, fit(learned), held_out)
