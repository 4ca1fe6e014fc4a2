"""Versioned history of a corrected table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def open_history(snapshot: DataFrame, day: Column) -> DataFrame:
    return snapshot.select(
        "*", day.alias("valide_du"), F.lit(None).cast("date").alias("valide_au")
    )


def apply_snapshot(history: DataFrame, snapshot: DataFrame, key: str, tracked: Sequence[str], day: Column) -> DataFrame:
    """History after a new snapshot: unchanged rows stay open, changed or vanished ones close on ``day``,
    and new or changed ones open a version.

    Only open versions meet the snapshot, in one full outer join on the key.
    """
    closed = history.filter(F.col("valide_au").isNotNull())
    old = history.filter(F.col("valide_au").isNull()).alias("old")
    new = snapshot.select(key, *tracked).alias("new")
    joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    same = reduce(lambda a, b: a & b, [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in (key, *tracked)])
    in_old, in_new = F.col(f"old.{key}").isNotNull(), F.col(f"new.{key}").isNotNull()

    def version(side: str, start: Column, end: Column) -> Column:
        return F.struct(
            *[F.col(f"{side}.{c}").alias(c) for c in (key, *tracked)],
            start.cast("date").alias("valide_du"),
            end.cast("date").alias("valide_au"),
        )

    open_end = F.lit(None)
    versions = F.array_compact(
        F.array(
            F.when(in_old, version("old", F.col("old.valide_du"), F.when(~same, day))),
            F.when(in_new & ~same, version("new", day, open_end)),
        )
    )
    return joined.select(F.inline(versions)).unionByName(closed.select(key, *tracked, "valide_du", "valide_au"))
