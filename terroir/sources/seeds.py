"""Fixed reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terroir import params as P

SCHEMA = "code_departement string, nom_departement string, code_region string, nom_region string"


def departements(spark: SparkSession, csv_path: str | None = None) -> DataFrame:
    """Department seed; ``csv_path`` reads an extended list, codes always as text."""
    if csv_path:
        return spark.read.schema(SCHEMA).option("header", True).csv(csv_path)
    return spark.createDataFrame(list(P.SEED_DEPARTEMENTS), schema=SCHEMA)
