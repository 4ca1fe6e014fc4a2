"""Joins on aggregated rows, semi/anti joins and the star lookup.

No join here carries a broadcast hint: Catalyst and AQE broadcast a
side only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise
sort-merge with skew splitting.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Join two results of the same ``groupBy(keys)``; NULL keys match each other."""
    if not keys:  # one row on each side, put together without a join
        both = left.unionByName(right, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in both.columns])
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[c for c in right.columns if c not in keys],
    )
    cond: Column = reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"__r_{k}"]) for k in keys]
    )
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def lookup(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Many-to-one star join; unmatched fact rows stay, with NULL attributes."""
    return fact.join(dim.select(key, *columns), key, "left")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``members`` (left semi); give one row per key, a fact's keys as ``distinct()``."""
    return df.join(members.select(key), key, "left_semi")


def not_in(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (members)`` for member keys that are never NULL.

    A NULL key on the left is neither in nor out and is dropped, so an equi anti join applies instead of
    a nested loop.
    """
    known = members.select(key).filter(F.col(key).isNotNull())
    return df.filter(F.col(key).isNotNull()).join(known, key, "left_anti")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti")
