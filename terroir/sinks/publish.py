"""Publishing the marts: a new version beside the old one, then one atomic switch per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.sinks.versions import expire, new_version, read_current, switch

# Types a published table may have.
TYPES_PUBLIABLES = (
    T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType, T.ByteType, T.ShortType,
    T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType,
)


def check_types(df: DataFrame) -> None:
    """Raise on a column type without a counterpart in the target database."""
    unknown = [f"{f.name}: {f.dataType.simpleString()}" for f in df.schema if not isinstance(f.dataType, TYPES_PUBLIABLES)]
    if unknown:
        raise TypeError(f"unsupported column types: {', '.join(unknown)}")


def publish(
    tables: Mapping[str, DataFrame], root: str, only: Sequence[str] | None = None, keep: int = 10
) -> dict[str, int]:
    """Write the chosen tables as a new version and switch to it; returns the rows written per table.

    A failure before the switch leaves the published version untouched. The ``keep`` newest versions stay for readers.
    """
    names = list(tables if only is None else only)
    missing = [n for n in names if n not in tables]
    if missing:
        raise KeyError(f"unknown tables: {', '.join(missing)}")
    version = new_version()
    counts: dict[str, int] = {}
    for name in names:
        check_types(tables[name])
    for name in names:
        seen = Observation(f"publish_{name}")
        tables[name].observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/{name}/{version}")
        counts[name] = seen.get["rows"]
    for name in names:
        switch(tables[name].sparkSession, f"{root}/{name}", version)
    for name in names:
        expire(tables[name].sparkSession, f"{root}/{name}", keep)
    return counts


def read_published(spark: SparkSession, root: str, table: str) -> DataFrame:
    return read_current(spark, f"{root}/{table}")


def publish_jdbc(df: DataFrame, url: str, schema: str, table: str, properties: Mapping[str, str]) -> None:
    """Replace a database table: distributed write to a staging table, then one renaming transaction.

    Needs the database's JDBC driver on the class path. Not covered by tests: none is available here.
    """
    check_types(df)
    staging, final = f"{schema}.{table}__new", f"{schema}.{table}"
    df.write.jdbc(url, staging, mode="overwrite", properties=dict(properties))
    connection = df.sparkSession._jvm.java.sql.DriverManager.getConnection(
        url, properties.get("user"), properties.get("password")
    )
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        statement.execute(f"DROP TABLE IF EXISTS {final}")
        statement.execute(f"ALTER TABLE {staging} RENAME TO {table}")
        connection.commit()
    finally:
        connection.close()
