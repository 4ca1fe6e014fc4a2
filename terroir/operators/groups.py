"""Counts with labels, most frequent value and single-value selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_with_labels(df: DataFrame, keys: Sequence[str], labels: Sequence[str], nb: str) -> DataFrame:
    """``count(*)`` and one value of each label column per group.

    Counting by keys and labels first keeps the large step a plain hash aggregation (a string ``min``
    would force a sort of the input); the second step sees one row per distinct label.
    """
    return (
        df.groupBy(*keys, *labels)
        .agg(F.count(F.lit(1)).alias(nb))
        .groupBy(*keys)
        .agg(*[F.min(c).alias(c) for c in labels], F.sum(nb).alias(nb))
    )


def most_frequent(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent non-NULL value per group, the smallest one on a tie."""
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    best = F.min(F.struct((-F.col("__n")).alias("rank"), F.col(value).alias("value")))
    return counted.groupBy(*keys).agg(best.getField("value").alias(name))


def single_value(c: str) -> Column:
    """Aggregate: the value if the group holds exactly one distinct value (NULL counts as one)."""
    only = (F.count(c) == F.count(F.lit(1))) & F.min(c).eqNullSafe(F.max(c))
    return F.when(only, F.max(c))
