"""Time comparisons on aggregated rows: prior year, trailing months, year to date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_prior_year(
    df: DataFrame, year: str, keys: Sequence[str], values: Sequence[str], suffix: str = "_n1"
) -> DataFrame:
    """Add each value one year earlier; NULL when the current value or the earlier row is missing.

    ``df`` holds one row per year and keys. The range frame covers exactly the year before, where ``lag``
    would take the wrong row when a year is absent, and unlike a join on the shifted year it evaluates
    ``df`` once.
    """
    before = W.partitionBy(*keys).orderBy(year).rangeBetween(-1, -1)
    return df.select(
        "*", *[F.when(F.col(v).isNotNull(), F.max(v).over(before)).alias(f"{v}{suffix}") for v in values]
    )


def trailing_months(df: DataFrame, month: str, months: int = 12) -> DataFrame:
    """Copy every row to each window end it belongs to: its own month and the ``months - 1`` after it.

    Linear in the rows (feed it monthly histograms, not detail rows), and no range join.
    """
    ends = F.sequence(F.col(month), F.add_months(F.col(month), months - 1), F.expr("interval 1 month"))
    return df.withColumn(month, F.explode(ends))


def year_to_date(df: DataFrame, year: str, order: str, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Running total inside each year over rows already aggregated to ``order``."""
    w = W.partitionBy(*keys, year).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(value).over(w))


def share_of_group(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Each row's share of its group's total (100 % stacked column)."""
    total = F.sum(value).over(W.partitionBy(*keys))
    return df.withColumn(name, F.try_divide(F.col(value).cast("double"), total.cast("double")))
