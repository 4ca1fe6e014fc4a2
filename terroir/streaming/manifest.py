"""What a stream has written, as one small file that is replaced by rename.

The manifest names the folders that belong to each table: whole lots, and for keyed state the current folder of each key
bucket. A micro-batch writes its folders first and then replaces the manifest, which is its only visible step: a batch
that is replayed after that does nothing, one replayed before writes its folders again. Compaction works the same way.
Folders that are no longer named stay for ``GRACE`` seconds, for readers that began earlier; the first replacement after
that deletes them.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from terroir.sinks.versions import read_file, replace_file
from terroir.storage import remove

FICHIER = "manifest.json"
GRACE = 6 * 3600


@dataclass(frozen=True)
class Manifest:
    """``batch`` is the last micro-batch taken in, ``facts`` are small values kept, ``retired`` folders with their time."""

    batch: int = -1
    lots: dict[str, list[str]] = field(default_factory=dict)
    buckets: dict[str, dict[str, str]] = field(default_factory=dict)
    facts: dict[str, str] = field(default_factory=dict)
    retired: list[tuple[int, str]] = field(default_factory=list)

    def folders(self, table: str) -> list[str]:
        return self.lots.get(table, [])

    def with_lots(self, new: dict[str, str]) -> Manifest:
        """One more lot of each table named."""
        return replace(self, lots=self.lots | {t: [*self.folders(t), folder] for t, folder in new.items()})

    def compacted(self, table: str, old: Iterable[str], new: str) -> Manifest:
        """``new`` in the place of the lots ``old``; lots added meanwhile stay."""
        gone = list(old)
        return replace(self, lots=self.lots | {table: [new, *(f for f in self.folders(table) if f not in gone)]})

    def without(self, folders: Iterable[str]) -> Manifest:
        """``folders``, no longer named, are to be deleted after the grace."""
        return replace(self, retired=[*self.retired, *((int(time.time()), f) for f in folders)])

    def with_buckets(self, table: str, new: dict[str, str]) -> Manifest:
        """``new`` folders for some buckets; the ones before them are retired."""
        before = self.buckets.get(table, {})
        return replace(self, buckets=self.buckets | {table: before | new}).without([before[b] for b in new if b in before])


def load(spark: SparkSession, root: str) -> Manifest:
    text = read_file(spark, f"{root}/{FICHIER}")
    if text is None:
        return Manifest()
    kept = json.loads(text)
    return Manifest(**kept | {"retired": [tuple(r) for r in kept["retired"]]})


def store(spark: SparkSession, root: str, manifest: Manifest) -> None:
    """Replace the manifest of ``root``; folders out of grace go before that, so none is forgotten in a crash."""
    late = [r for r in manifest.retired if r[0] + GRACE <= time.time()]
    for _, folder in late:
        remove(spark, folder)
    kept = replace(manifest, retired=[r for r in manifest.retired if r not in late])
    replace_file(spark, f"{root}/{FICHIER}", json.dumps(asdict(kept)))


def read(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """The rows of folders as they are named now; None without any."""
    return spark.read.parquet(*folders) if folders else None
