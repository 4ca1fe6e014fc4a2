"""Quality by perplexity: an interpolated modified Kneser-Ney model of byte n-grams, counted and joined in shards.

The model is trained on all trusted documents (labelled good and not toxic). Grams are runs of ``ORDER`` bytes of the
UTF-8 text, after a start mark, packed into a long: any language, any script, no vocabulary. Only the highest order is
counted in texts; a lower order's count is the number of distinct bytes seen to the left of a gram, so all orders come
from the table of counted grams by grouping. Discounts for counts of one, two, and three or more come from each order's
counts of counts.

How texts meet the model without either being sent whole:

1. Documents are dealt to buckets by a hash of their id, packed and compressed, together with the trusted ids of the
   bucket. Each bucket's task counts the grams of its training documents and lists the distinct grams of all of them.
2. Counts are summed per gram; the wanted grams, distinct over all buckets, are joined with the tables of counts and
   of contexts, order by order, which gives each its probability. Probabilities of two bytes and contexts of two bytes
   are at most 65,536 rows and broadcast; the other tables are joined by shuffle.
3. The probabilities of the grams that a bucket listed go to the bucket, documents are dealt again, and each document's
   log probabilities are summed over its whole text.

A fifth of the trusted documents, by a hash of their ids, is not counted but calibrates: it shows how surprising clean
text is to the model that did not see it. A text is judged by its log perplexity less ``ERRORS`` standard errors, as few
bytes prove little. The limit of a language is the ``QUANTILE`` quantile of that number over its n calibrating documents,
moved out by ``WIDEN`` / sqrt(n) of its distance from the median: a quantile of few documents is uncertain, one of many
is the limit itself. A document above it is not kept. A language without calibrating documents takes the limit of all of them.

Defined results: null or empty text has no perplexity and is not kept; null languages are a language of their own;
null ids are never trusted; an id is trusted if any of its label rows says so and none says otherwise; rows that
share an id are scored each; without counted documents the model is uniform, without calibrating ones every text that is
not empty is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir.llm.common import only, record_batches
from terroir.storage import written

#: Bytes of a gram. Those of five span short words with what is around them; their number grows with the corpus.
ORDER = 5
#: The limit's quantile, and how far it is moved out for the few documents that it is estimated from.
QUANTILE, WIDEN = 0.96, 4.0
#: One in so many trusted documents calibrates.
CALIBRATING = 5
#: Standard errors that are taken off a text's mean surprise.
ERRORS = 1.0
#: Bytes of text in a bucket, about. A task streams them; what it holds is the bucket's distinct grams. These grow far
#: slower than its text, so twice the bytes are fewer rows in all to list, join and send back.
BUCKET_BYTES = 32 << 20
#: Bytes of text in a pack before it is compressed.
PACK_BYTES = 8 << 20
#: Grams gathered in a task before they are made distinct again.
GATHERED = 1_500_000

PACK = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text_hash", pa.int64()), ("text", pa.binary())])
DEALT_SQL = "bucket int, kind int, gram long, value double, ids array<long>, pack binary"
DEALT = pa.schema(
    [("bucket", pa.int32()), ("kind", pa.int32()), ("gram", pa.int64()), ("value", pa.float64()),
     ("ids", pa.list_(pa.int64())), ("pack", pa.binary())]
)


def grams(data: bytes) -> np.ndarray:
    """The packed gram that ends at each byte of ``data``; zero bytes stand before the start."""
    flat = np.frombuffer(b"\0" * (ORDER - 1) + data, np.uint8).astype(np.int64)
    out = np.zeros(len(data), np.int64)
    for i in range(ORDER):
        out = out << 8 | flat[i : i + len(data)]
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of bucket, doc_id, lang, text_hash, text, as compressed packs of one bucket each."""
    packer = zstandard.ZstdCompressor(level=3)
    held: list[pa.RecordBatch] = []
    size = 0

    def packs() -> Iterator[tuple]:
        rows = pa.Table.from_batches(held)
        for bucket in rows.column("bucket").unique().to_pylist():
            part = rows.filter(pa.compute.equal(rows.column("bucket"), bucket)).drop_columns("bucket").cast(PACK)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, PACK) as out:
                out.write_table(part.combine_chunks())
            yield bucket, 1, None, None, None, packer.compress(sink.getvalue())

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PACK_BYTES:
            yield from record_batches(packs(), DEALT, 50)
            held, size = [], 0
    if held:
        yield from record_batches(packs(), DEALT, 50)


def _unpacked(pack: bytes) -> Iterator[tuple]:
    with pa.ipc.open_stream(zstandard.ZstdDecompressor().stream_reader(pack)) as rows:
        for batch in rows:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From buckets in order, each with trusted ids before packs: gram counts (bucket null) and wanted grams."""
    schema = pa.schema([("bucket", pa.int32()), ("gram", pa.int64()), ("n", pa.int64())])
    trusted: set[int] = set()
    wanted: list[np.ndarray] = []
    counted: list[tuple[np.ndarray, np.ndarray]] = []
    size, bucket = [0, 0], None

    def shrink_wanted() -> None:
        wanted[:] = [np.unique(np.concatenate(wanted))]
        size[0] = len(wanted[0])

    def shrink_counted() -> None:
        every = np.concatenate([g for g, _ in counted])
        values, inverse = np.unique(every, return_inverse=True)
        counted[:] = [(values, np.bincount(inverse, np.concatenate([n for _, n in counted])).astype(np.int64))]
        size[1] = len(values)

    def rows_of(bucket_: int | None, values: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(values), 50_000):
            v = values[i : i + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([bucket_] * len(v), pa.int32()), pa.array(v), pa.array(n[i : i + 50_000])], schema=schema
            )

    for batch in batches:
        for key, kind, _, _, ids, pack in zip(*batch.columns, strict=True):
            if key.as_py() != bucket:
                if wanted:
                    shrink_wanted()
                    yield from rows_of(bucket, wanted[0], np.zeros(len(wanted[0]), np.int64))
                bucket, trusted, size[0] = key.as_py(), set(), 0
                wanted.clear()
            if kind.as_py() == 0:
                trusted.update(ids.as_py())
                continue
            for doc, _, _, text in _unpacked(pack.as_py()):
                found, n = np.unique(grams(text or b""), return_counts=True)
                if not len(found):
                    continue
                wanted.append(found)
                size[0] += len(found)
                if doc in trusted:
                    counted.append((found, n))
                    size[1] += len(found)
                if size[0] > GATHERED:
                    shrink_wanted()
                if size[1] > GATHERED:
                    shrink_counted()
    if wanted:
        shrink_wanted()
        yield from rows_of(bucket, wanted[0], np.zeros(len(wanted[0]), np.int64))
    if counted:
        shrink_counted()
        yield from rows_of(None, *counted[0])


SCORES_SQL = "doc_id long, lang string, text_hash long, n_bytes long, marked boolean, log_perplexity double, error double"
SCORES = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("text_hash", pa.int64()), ("n_bytes", pa.int64()),
     ("marked", pa.bool_()), ("log_perplexity", pa.float64()), ("error", pa.float64())]
)


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From buckets in order, each with marked ids and gram probabilities before packs: a row for each document."""

    def rows():
        marked: set[int] = set()
        known: list[np.ndarray] = []
        logs: list[np.ndarray] = []
        keys = values = None
        bucket = None
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            for i, (key, ids, pack) in enumerate(zip(batch.column(0), batch.column(4), batch.column(5), strict=True)):
                if key.as_py() != bucket:
                    bucket, marked, known, logs, keys = key.as_py(), set(), [], [], None
                if kinds[i] == 0 and ids.is_valid:
                    marked.update(ids.as_py())
                elif kinds[i] == 0:
                    known.append(batch.column(2)[i].as_py())
                    logs.append(batch.column(3)[i].as_py())
                else:
                    if keys is None:
                        keys, values = np.array(known, np.int64), np.array(logs)
                        order = np.argsort(keys)
                        keys, values = keys[order], values[order]
                    for doc, lang, text_hash, text in _unpacked(pack.as_py()):
                        found, n = np.unique(grams(text or b""), return_counts=True)
                        size = len(text or b"")
                        if not size:
                            yield doc, lang, text_hash, 0, doc in marked, None, None
                            continue
                        surprise = -values[np.searchsorted(keys, found)]
                        mean = float(surprise @ n) / size
                        error = (float((surprise - mean) ** 2 @ n) / size / size) ** 0.5
                        yield doc, lang, text_hash, size, doc in marked, mean, error

    return record_batches(rows(), SCORES, 5_000)


def _discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and from 3, from the counts of counts of an order."""
    if not n1 or not n2:
        return 0.5, 0.5, 0.5
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5]
    return tuple(min(max(d, 0.05), float(k)) for k, d in enumerate(found, 1))


def _short(pairs: np.ndarray) -> np.ndarray:
    """Probabilities of all two-byte grams, interpolated down to the uniform one, from their 65,536 counts."""
    value = np.full(1, 1 / 256)
    for n in (np.count_nonzero(pairs.reshape(256, 256), axis=0), pairs):
        discounts = np.array([0.0, *_discounts(*(int((n == k).sum()) for k in (1, 2, 3, 4)))])
        discount = discounts[np.minimum(n, 3)].reshape(-1, 256)
        n = n.reshape(-1, 256)  # a row for each context
        total = n.sum(axis=1, keepdims=True)
        seen = np.maximum(total, 1)
        left = np.where(total > 0, discount.sum(axis=1, keepdims=True) / seen, 1.0)
        # Shorter grams follow by the last byte.
        value = (np.maximum(n - discount, 0) / seen + left * value.reshape(1, -1)).ravel()
    return value


def probabilities(wanted: DataFrame, counts: DataFrame) -> DataFrame:
    """``gram`` and ``value``, the log probability of its last byte after the others, for the grams of ``wanted``.

    ``counts`` (gram, n) are the counts of grams of ``ORDER`` bytes in the training text.
    """
    tables = {ORDER: counts}
    for order in range(ORDER - 1, 1, -1):
        # Distinct grams that end in this one: one for each byte seen to its left.
        ends = F.col("gram").bitwiseAND((1 << 8 * order) - 1).alias("gram")
        shorter = tables[order + 1].groupBy(ends).agg(F.count("*").alias("n"))
        tables[order] = written(shorter, "quality-grams")
    # At most 65,536 rows, whatever the input.
    pairs = np.zeros(1 << 16, np.int64)
    for row in tables[2].toLocalIterator():
        pairs[row["gram"]] = row["n"]
    short = pa.table({"end": np.arange(1 << 16), "value": _short(pairs)})
    session = wanted.sparkSession
    end = F.col("gram").bitwiseAND((1 << 16) - 1)
    found = wanted.select("gram").distinct().withColumn("end", end).join(F.broadcast(session.createDataFrame(short)), "end").drop("end")
    for order in range(3, ORDER + 1):
        n = F.col("n")
        seen = tables[order].agg(*(F.count_if(n == k) for k in (1, 2, 3, 4))).first()
        d1, d2, d3 = _discounts(*seen)
        discount = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        contexts = tables[order].groupBy(F.shiftright("gram", 8).alias("before")).agg(
            F.sum("n").alias("total"), (F.sum(discount) / F.sum("n")).alias("left")
        )
        if order == 3:
            contexts = F.broadcast(contexts)  # contexts of two bytes: at most 65,536 rows
        masses = tables[order].select(F.col("gram").alias("end"), F.greatest(n - discount, F.lit(0.0)).alias("mass"))
        found = found.withColumn("end", F.col("gram").bitwiseAND((1 << 8 * order) - 1))
        found = found.join(masses, "end", "left").withColumn("before", F.shiftright("end", 8)).join(contexts, "before", "left")
        part = F.coalesce(F.col("mass") / F.col("total"), F.lit(0.0))
        found = found.select("gram", (part + F.coalesce("left", F.lit(1.0)) * F.col("value")).alias("value"))
    return found.select("gram", F.log("value").alias("value"))


def _bucket(buckets: int, otherwise: str | None = None) -> Column:
    """Bucket of a row by ``doc_id``; by column ``otherwise`` where it has none, as no trusted id is there to meet."""
    key = F.xxhash64("doc_id")
    if otherwise:
        key = F.when(F.col("doc_id").isNull(), F.xxhash64(otherwise)).otherwise(key)
    return F.pmod(key, F.lit(buckets)).cast("int")


def _dealt_ids(ids: DataFrame, buckets: int, name: str) -> DataFrame:
    """Rows of some hundred ids of a bucket each: the salt keeps lists short."""
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "doc_id"), F.lit(256))
    lists = ids.groupBy(_bucket(buckets).alias("bucket"), chunk.alias("chunk")).agg(F.collect_list("doc_id").alias("ids"))
    return written(_as_dealt(lists, "bucket", "ids"), name)


def _as_dealt(df: DataFrame, *given: str) -> DataFrame:
    """``df`` in the shape of dealt rows, of the kind that comes before packs."""
    kinds = {"gram": "long", "value": "double", "ids": "array<long>", "pack": "binary"}
    columns = [F.col(c) if c in given else F.lit(None).cast(t).alias(c) for c, t in kinds.items()]
    return df.select("bucket", F.lit(0).alias("kind"), *columns)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the documents that labels (doc_id, quality, toxic) call good and not toxic, and whether it calibrates."""
    good = only(labels, doc_id="long", quality="int", toxic="int").filter("doc_id is not null")
    good = good.groupBy("doc_id").agg(F.min(F.col("quality").eqNullSafe(1) & F.col("toxic").eqNullSafe(0)).alias("good"))
    calibrates = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(CALIBRATING)) == 0
    return good.filter("good").select("doc_id", calibrates.alias("calibrates"))


def score_documents(docs: DataFrame, training: DataFrame, marked: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``text_hash``, ``n_bytes``, ``marked``, ``log_perplexity`` and its standard ``error``.

    ``docs`` has doc_id, lang and text. ``training`` and ``marked`` (doc_id, distinct) name the documents to train on and
    those to mark in the result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = only(docs, text="string").agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 + size // BUCKET_BYTES
    rows = only(docs, doc_id="long", lang="string", text="string").select(
        _bucket(buckets, "text").alias("bucket"), "doc_id", "lang", F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text")
    )
    packs = rows.mapInArrow(_pack, DEALT_SQL)

    def dealt(*extra: DataFrame) -> DataFrame:
        both = packs
        for other in extra:
            both = both.unionByName(other)
        return both.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")

    ids = _dealt_ids(training, buckets, "quality-training")
    found = written(dealt(ids).mapInArrow(_count, "bucket int, gram long, n long"), "quality-found")
    counts = found.filter("bucket is null").groupBy("gram").agg(F.sum("n").alias("n"))
    wanted = found.filter("bucket is not null").select("bucket", "gram")
    known = written(probabilities(wanted, written(counts, "quality-grams")), "quality-known")
    replies = _as_dealt(wanted.join(known, "gram"), "gram", "value")
    return dealt(_dealt_ids(marked, buckets, "quality-marked"), replies).mapInArrow(_score, SCORES_SQL)


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, errors: float = ERRORS) -> DataFrame:
    """``doc_id``, ``lang``, ``text_hash``, ``n_bytes``, ``perplexity``, ``judged``, ``threshold`` and ``keep`` of every row.

    ``judged`` is the perplexity less the standard errors, which is what meets the threshold.
    """
    ids = written(trusted_ids(labels), "quality-ids")
    training, calibrating = ids.filter("not calibrates").select("doc_id"), ids.filter("calibrates").select("doc_id")
    scores = written(score_documents(docs, training, calibrating), "quality-scores")
    scores = scores.withColumn("judged", F.col("log_perplexity") - errors * F.col("error"))
    middle, high = (F.percentile_approx("judged", p, 10_000) for p in (0.5, quantile))
    limit = high + (high - middle) * WIDEN / F.sqrt(F.count("judged"))
    calm = scores.filter("marked and judged is not null")
    by_lang = calm.groupBy(F.col("lang").alias("of_lang")).agg(limit.alias("own"))
    overall = calm.agg(limit).first()[0]
    joined = scores.join(by_lang, F.col("lang").eqNullSafe(F.col("of_lang")), "left")
    top = F.coalesce("own", F.lit(overall).cast("double"))
    keep = F.col("judged").isNotNull() & F.coalesce(F.col("judged") <= top, F.lit(True))
    return joined.select(
        "doc_id", "lang", "text_hash", "n_bytes", F.exp("log_perplexity").alias("perplexity"),
        F.exp("judged").alias("judged"), F.exp(top).alias("threshold"), keep.alias("keep"),
    )


def kept(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, errors: float = ERRORS) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    good = classify(docs, labels, quantile, errors).filter("keep").select("doc_id", "text_hash").distinct().alias("k")
    text = F.coalesce(F.col("d.text"), F.lit(""))
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.xxhash64(text) == F.col("k.text_hash"))
    return docs.alias("d").join(good, same, "left_semi")
