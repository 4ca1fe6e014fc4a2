"""Which keys a stream has had before: bucketed key files with a Bloom filter for each bucket, probed exactly after.

Keys are dealt to a fixed number of buckets by hash. Each lot of new keys is written as one folder for each of its
buckets, and one row for each bucket with the bits of its Bloom filter. A batch reads the filters of its own buckets
only. Keys that a filter lets through are then looked up in the key files of their buckets: the filter saves reads,
the files decide. Lots are merged by :func:`compacted`, with filters made anew for the larger buckets.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits and hashes of a filter's key: about one key in 5,000 passes by chance.
BITS, HASHES = 20, 7
PAQUETS = 64


def bucket(key: str, paquets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(paquets)).cast("int")


def _place(key: str, i: int, size: Column) -> Column:
    """The ``i``-th bit of a key in a filter of ``size`` bits."""
    one, two = (F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(1 << 31)) for seed in ("a", "b"))
    return (one + two * i) % size


@dataclass(frozen=True)
class Lot:
    """Key files ``keys``/paquet=…, filters and the buckets that hold keys."""

    keys: str
    filters: str
    buckets: tuple[int, ...]

    def text(self) -> str:
        return json.dumps([self.keys, self.filters, self.buckets])

    @staticmethod
    def of(text: str) -> Lot:
        keys, filters, buckets = json.loads(text)
        return Lot(keys, filters, tuple(buckets))

    def files(self, wanted: set[int], what: str) -> list[str]:
        return [f"{getattr(self, what)}/paquet={b}" for b in self.buckets if b in wanted]


def write_lot(keys: DataFrame, key: str, root: str, paquets: int) -> Lot | None:
    """Write distinct ``keys`` as a lot; None if there are none."""
    spark, name = keys.sparkSession, uuid.uuid4().hex[:12]
    lot, filters = f"{root}/cles-{name}", f"{root}/filtres-{name}"
    dealt = keys.select(key).withColumn("paquet", bucket(key, paquets)).hint("rebalance", "paquet")
    dealt.sortWithinPartitions("paquet", key).write.partitionBy("paquet").parquet(lot)
    written = spark.read.schema(keys.select(key).withColumn("paquet", F.lit(0)).schema).parquet(lot)
    counts = {r["paquet"]: r["count"] for r in written.groupBy("paquet").count().collect()}  # a number for each bucket
    if not counts:
        return None
    words = max(1, -(-max(counts.values()) * BITS // 64))
    place = F.explode(F.array(*(_place(key, i, F.lit(64 * words)) for i in range(HASHES))))
    bits = written.select("paquet", place.alias("p")).groupBy("paquet", F.expr("cast(p div 64 as int)").alias("mot")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")
    )
    # Every word is there, so that a word's place in the array is its number.
    every = F.explode(F.sequence(F.lit(0), F.lit(words - 1)))
    zeros = spark.createDataFrame([(b,) for b in counts], "paquet int").select("paquet", every.alias("mot"), F.lit(0).cast("long").alias("bits"))
    whole = bits.unionByName(zeros).groupBy("paquet", "mot").agg(F.expr("bit_or(bits)").alias("bits"))
    arrays = whole.groupBy("paquet").agg(F.array_sort(F.collect_list(F.struct("mot", "bits"))).alias("mots"))
    arrays.select("paquet", F.col("mots.bits").alias("mots")).write.partitionBy("paquet").parquet(filters)
    return Lot(lot, filters, tuple(sorted(counts)))


def _read(spark: SparkSession, lots: list[Lot], wanted: set[int], what: str) -> DataFrame | None:
    """The wanted buckets of the lots' ``keys`` or ``filters``, with their ``paquet``."""
    parts = []
    for lot in lots:
        paths = lot.files(wanted, what)
        if paths:
            parts.append(spark.read.option("basePath", getattr(lot, what)).parquet(*paths))
    return reduce(DataFrame.unionByName, parts) if parts else None


def maybe_known(keys: DataFrame, key: str, lots: list[Lot]) -> DataFrame | None:
    """The ``keys`` (with their ``paquet``) that some filter lets through, repeated if several do."""
    spark = keys.sparkSession
    touched = {r["paquet"] for r in keys.select("paquet").distinct().collect()}
    filters = _read(spark, lots, touched, "filters")
    if filters is None:
        return None
    met = keys.select(key, "paquet").join(filters, "paquet")
    size = F.size("mots").cast("long") * 64
    test = reduce(lambda a, b: a & b, (_bit(_place(key, i, size)) for i in range(HASHES)))
    return met.filter(test).select(key, "paquet")


def _bit(place: Column) -> Column:
    word = F.get("mots", F.floor(place / 64).cast("int"))
    return F.getbit(word, (place % 64).cast("int")) == 1


def known(keys: DataFrame, key: str, lots: list[Lot], scratch: str) -> DataFrame | None:
    """Those of ``keys`` (with their ``paquet``) that are in the lots, exactly; None if no filter lets any through.

    ``scratch`` names a folder for the keys between the two probes.
    """
    passed = maybe_known(keys, key, lots)
    if passed is None:
        return None
    spark = keys.sparkSession
    passed.distinct().write.mode("overwrite").parquet(scratch)
    passed = spark.read.parquet(scratch)
    files = _read(spark, lots, {r["paquet"] for r in passed.select("paquet").distinct().collect()}, "keys")
    if files is None:
        return None
    held = files.select(F.col(key).alias("vu"), "paquet")
    same = F.col(key).eqNullSafe(F.col("vu")) & (passed["paquet"] == held["paquet"])
    return passed.join(held, same, "left_semi").select(key)


def compacted(spark: SparkSession, lots: list[Lot], key: str, root: str, paquets: int) -> Lot | None:
    """All lots as one, written anew; no key is in two lots."""
    keys = _read(spark, lots, set(range(paquets)), "keys")
    return None if keys is None else write_lot(keys.select(key), key, root, paquets)
