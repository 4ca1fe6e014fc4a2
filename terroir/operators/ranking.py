"""Top-N with ties on aggregated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def top_n_with_ties(df: DataFrame, measure: str, n: int, ascending: bool = False, rank: str = "rang") -> DataFrame:
    """Rows ranked 1..n by ``measure``, ties included, NULL measures excluded.

    Spark turns ``rank() <= n`` into a per-task limit before the exchange, so the ranking task receives
    the best rows of each task, not the table.
    """
    order = F.col(measure).asc() if ascending else F.col(measure).desc()
    ranked = df.filter(F.col(measure).isNotNull()).withColumn(rank, F.rank().over(W.orderBy(order)))
    return ranked.filter(F.col(rank) <= n).withColumn(rank, F.col(rank).cast("int"))
