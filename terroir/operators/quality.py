"""Data-quality checks, compiled to one pass over each table.

A check is a declaration. :func:`verify` puts all checks of a table into one projection: a row gives an entry for each
predicate it fails and for each key that is to be counted, and no entry otherwise. The entries of all tables are counted
together by check and key, with map-side combine, so a predicate is one row per task and a hot key too. A relation
needs no join: child and parent give entries of the same check and key, and a key without a parent's entry is an orphan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERREUR, ALERTE = "error", "warn"
#: What a check counts: failing rows, distinct failing values, keys that occur again, child rows without a parent.
LIGNES, VALEURS, REPETITIONS, ORPHELINS = "lignes", "valeurs", "repetitions", "orphelins"


@dataclass(frozen=True)
class Check:
    """A check of ``table``; ``key`` are the columns counted, ``fails`` tells the rows that count.

    For a relation, ``parent`` is the table whose ``field`` has the keys.
    """

    name: str
    table: str
    column: str
    counts: str
    fails: Column | None = None
    key: tuple[str, ...] = ()
    severity: str = ERREUR
    parent: str | None = None
    field: str | None = None


def not_null(table: str, column: str, where: Column | None = None) -> Check:
    missing = F.col(column).isNull()
    return Check("not_null", table, column, LIGNES, missing if where is None else missing & where)


def unique(table: str, column: str, severity: str = ERREUR) -> Check:
    """Number of non-NULL values that occur more than once."""
    return Check("unique", table, column, REPETITIONS, F.col(column).isNotNull(), (column,), severity)


def unique_combination(table: str, columns: Sequence[str], severity: str = ERREUR) -> Check:
    """Number of column combinations that occur more than once; NULLs are values here."""
    return Check("unique_combinaison", table, ",".join(columns), REPETITIONS, F.lit(True), tuple(columns), severity)


def accepted_values(table: str, column: str, values: Sequence[str], severity: str = ERREUR) -> Check:
    """Number of distinct non-NULL values outside the list."""
    return Check("accepted_values", table, column, VALEURS, ~F.col(column).isin(*values), (column,), severity)


def relationship(table: str, column: str, parent: str, field: str, severity: str = ERREUR) -> Check:
    """Number of child rows whose non-NULL key has no parent."""
    return Check("relationships", table, column, ORPHELINS, F.col(column).isNotNull(), (column,), severity, parent, field)


def rows_failing(name: str, table: str, fails: Column) -> Check:
    """Number of rows for which a predicate holds."""
    return Check(name, table, "", LIGNES, fails)


def values_failing(name: str, table: str, column: str, values: Sequence[str]) -> Check:
    """A named check of the distinct values outside a list."""
    return Check(name, table, "", VALEURS, ~F.col(column).isin(*values), (column,))


def _entry(number: int, when: Column, columns: Sequence[str], child: int, parent: int) -> Column:
    """A row's entry for a check: keys are texts, one for each column, NULL where the column is."""
    key = F.array(*(F.col(c).cast("string") for c in columns)).cast("array<string>")
    return F.when(when, F.struct(F.lit(number).alias("controle"), key.alias("cle"), F.lit(child).alias("n"), F.lit(parent).alias("p")))


def verify(table: Callable[[str], DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Rows (controle, table_controlee, colonne, severite, echecs) of all ``checks``; ``table`` gives tables by name."""
    entries: dict[str, list[Column]] = {}
    for i, c in enumerate(checks):
        entries.setdefault(c.table, []).append(_entry(i, c.fails, c.key, 1, 0))
        if c.parent is not None:
            entries.setdefault(c.parent, []).append(_entry(i, F.col(c.field).isNotNull(), [c.field], 0, 1))
    passes = [
        table(name).select(F.inline(F.filter(F.array(*own), lambda x: x.isNotNull()))) for name, own in entries.items()
    ]
    counted = reduce(DataFrame.unionAll, passes).groupBy("controle", "cle").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    echecs = {
        LIGNES: F.col("n"),
        VALEURS: F.lit(1).cast("long"),
        REPETITIONS: (F.col("n") > 1).cast("long"),
        ORPHELINS: F.when(F.col("p") == 0, F.col("n")).otherwise(0),
    }
    failures = F.lit(0).cast("long")
    for what, count in echecs.items():
        numbers = [i for i, c in enumerate(checks) if c.counts == what]
        failures = F.when(F.col("controle").isin(numbers), count).otherwise(failures)
    found = counted.groupBy("controle").agg(F.sum(failures).alias("echecs"))
    # Checks that no row has an entry for passed. This side has one row for each check.
    named = [
        F.struct(
            F.lit(i).alias("numero"), F.lit(c.name).alias("controle"), F.lit(c.table).alias("table_controlee"),
            F.lit(c.column).alias("colonne"), F.lit(c.severity).alias("severite"),
        )
        for i, c in enumerate(checks)
    ]
    every = counted.sparkSession.range(1).select(F.inline(F.array(*named)))
    joined = every.join(found.withColumnRenamed("controle", "numero"), "numero", "left")
    return joined.select(
        "controle", "table_controlee", "colonne", "severite", F.coalesce("echecs", F.lit(0)).cast("long").alias("echecs")
    )


def unexpected_values(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Non-NULL values outside the list, with their row counts."""
    return df.filter(~F.col(column).isin(*values)).groupBy(column).agg(F.count(F.lit(1)).alias("nb_lignes"))


def with_status(results: DataFrame) -> DataFrame:
    """'ok', or the severity when something fails."""
    return results.withColumn("statut", F.when(F.col("echecs") == 0, "ok").otherwise(F.col("severite")))
