"""One row per key: earliest load, latest diagnostic, latest year.

Each is a ``min``/``max`` of a struct, not a window: the state is one row per key, map tasks
pre-aggregate, and a key holding a large part of all rows reaches the reducer as one row per map task.
The struct's field order makes the choice total, so a recomputed task picks the same row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys and c not in order]
    row = F.struct(*order, *rest)
    return (
        df.groupBy(*keys)
        .agg(pick(row).alias("__row"))
        .select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in df.columns])
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the smallest ``order`` per key; remaining columns break ties."""
    return _one_per_key(df, keys, order, F.min)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Row with the greatest ``order`` per key, NULLs last; remaining columns break ties."""
    return _one_per_key(df, keys, order, F.max)
