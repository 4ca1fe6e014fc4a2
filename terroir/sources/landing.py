"""Readers of the landed files: gzip CSV, gzip JSON lines and Parquet, codes always as text."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terroir.sinks.versions import expire, new_version, read_current, switch

# Fixed values -- fields kept from the diagnostics source.
CHAMPS_DPE = (
    "numero_dpe",
    "numero_dpe_remplace",
    "date_etablissement_dpe",
    "code_insee_ban",
    "nom_commune_ban",
    "code_departement_ban",
    "identifiant_ban",
    "type_batiment",
    "periode_construction",
    "annee_construction",
    "surface_habitable_logement",
    "etiquette_dpe",
    "etiquette_ges",
    "conso_5_usages_par_m2_ep",
    "emission_ges_5_usages_par_m2",
)
MOTIF_DVF, MOTIF_DPE, FICHIER_INSEE = "dvf/*/*.csv.gz", "dpe/*json.gz", "insee/comparateur.parquet"


class AucuneSource(FileNotFoundError):
    """None of the expected source files exists."""


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def any_file(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob matches anything, by the file system's listing alone."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line that isn't blank; the file is read no further than the batch that holds it."""
    for batch in batches:
        for i, line in enumerate(batch.column(0).to_pylist()):
            if line.strip():
                yield batch.slice(i, 1)
                return


def headers(spark: SparkSession, pattern: str) -> dict[tuple[str, ...], list[str]]:
    """The files of each distinct header, from one job over all files of a glob; no file matching is no header.

    Every file is a task of its own there, which ends with the file's first line. A file without lines has no header and
    no rows, and is left out.
    """
    own = spark.newSession()  # the settings below are for this read alone
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.files.maxPartitionNum", 2**31 - 1)
    try:
        lines = own.read.text(pattern).filter(F.col("_metadata.file_block_start") == 0).select(
            "value", F.col("_metadata.file_path").alias("path")
        )
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    found: dict[tuple[str, ...], list[str]] = {}
    for line, path in lines.mapInArrow(_first_lines, "value string, path string").collect():
        names = tuple(next(csv.reader([line.removeprefix("\ufeff")])))
        found.setdefault(names, []).append(unquote(path))
    return {names: sorted(paths) for names, paths in sorted(found.items())}


def read_csv_by_name(spark: SparkSession, pattern: str) -> DataFrame | None:
    """All-text CSV files of a glob united by column name; None where there is no row.

    One read binds columns by position, so files are grouped by their header and every distinct header gets its own
    schema.
    """
    parts = []
    for columns, members in headers(spark, pattern).items():
        df = (
            spark.read.schema(text_schema(columns))
            .option("header", True)
            .option("escape", '"')
            .option("multiLine", True)  # a gzip file is one task anyway; line breaks in quotes are data
            .option("mode", "FAILFAST")
            .csv(members)
        )
        # An empty field is NULL, quoted or not.
        parts.append(
            df.select(
                *[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in columns],
                F.col("_metadata.file_path").alias("filename"),
            )
        )
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts) if parts else None


def _year_of_folder(path: str) -> Column:
    """The four digits that end the name of the file's folder, else the empty text."""
    end = F.right(F.element_at(F.split(path, "/"), -2), F.lit(4))
    return F.when(end.rlike("^[0-9]{4}$"), end).otherwise("")


def read_dvf(spark: SparkSession, root: str) -> DataFrame | None:
    lines = read_csv_by_name(spark, f"{root}/{MOTIF_DVF}")
    if lines is None:
        return None
    return lines.select("*", _year_of_folder("filename").alias("_annee_fichier"), F.current_timestamp().alias("_loaded_at"))


def read_dpe(spark: SparkSession, root: str) -> DataFrame | None:
    if not any_file(spark, f"{root}/{MOTIF_DPE}"):
        return None
    # The declared columns are the projection: other fields of a line are skipped by the parser.
    lines = spark.read.schema(text_schema(CHAMPS_DPE)).option("mode", "FAILFAST").json(f"{root}/{MOTIF_DPE}")
    return lines.withColumn("_loaded_at", F.current_timestamp())


def read_insee(spark: SparkSession, root: str) -> DataFrame | None:
    path = f"{root}/{FICHIER_INSEE}"
    try:
        return spark.read.parquet(path).withColumn("_loaded_at", F.current_timestamp())
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


READERS = {"dvf_mutations": read_dvf, "dpe_logements": read_dpe, "insee_comparateur": read_insee}


# Department column of the sources that are downloaded per department.
COLONNE_DEPARTEMENT = {"dvf_mutations": "code_departement", "dpe_logements": "code_departement_ban"}


def read_raw(
    spark: SparkSession, root: str, departements: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The sources that are present; absent ones are left out, none at all is an error.

    ``departements`` restricts sales and diagnostics as they are read.
    """
    found = {name: df for name, reader in READERS.items() if (df := reader(spark, root)) is not None}
    if not found:
        raise AucuneSource(f"no source file under {root}")
    if departements is not None:
        for name, column in COLONNE_DEPARTEMENT.items():
            if name in found:
                found[name] = found[name].filter(F.col(column).isin(*departements))
    return found


def files_read(raw: dict[str, DataFrame]) -> dict[str, int]:
    """Number of source files behind each table, for the load audit."""
    return {name: len(set(df.inputFiles())) for name, df in raw.items()}


def land(raw: dict[str, DataFrame], out: str, rows_per_file: int = 1_000_000, keep: int = 2) -> dict[str, int]:
    """Full refresh of the raw layer as Parquet; returns the rows written per table.

    A gzip file is one task whatever its size; bounding the rows per output file keeps the tables
    splittable from here on without a shuffle. Every table is written as a new version first; then each is switched to
    by replacing its pointer. So a failure leaves all tables as they were, and there is no moment without a table.
    The ``keep`` newest versions stay for readers that began earlier.
    """
    counts, version = {}, new_version()
    for name, df in raw.items():
        seen = Observation(name)
        observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        observed.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{out}/{name}/{version}")
        counts[name] = seen.get["rows"]
    for name, df in raw.items():
        switch(df.sparkSession, f"{out}/{name}", version)
    for name, df in raw.items():
        expire(df.sparkSession, f"{out}/{name}", keep)
    return counts


def read_landed(spark: SparkSession, out: str, name: str) -> DataFrame:
    """A table of the raw layer, as of its current version."""
    return read_current(spark, f"{out}/{name}")
