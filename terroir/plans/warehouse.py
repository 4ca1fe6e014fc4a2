"""Tables of one build, each written once and read back by its consumers.

Raw tables, the deduplicated diagnostics, the intermediate tables and the marts are Parquet under the
shared folder of the cluster (``spark.checkpoint.dir``), so a lost executor never recomputes the chain
and every later join sees true file sizes.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir.functions import expressions as X
from terroir.params import Params
from terroir.plans import intermediate, marts, staging
from terroir.sources import adapters, seeds
from terroir.storage import remove, shared_dir

# The calendar of the registered queries ends in a fixed year, so that results are comparable.
AS_OF = dt.date(2026, 6, 30)


# Bounds a file, so that a table read from a few large unsplittable inputs is splittable from here on.
ROWS_PER_FILE = 1_000_000
# Storage columns of the facts, not part of their published columns: the year, and the dwelling type in the one spelling
# that all facts share, so that a type slicer compares a stored column.
PARTITION, TYPE = "annee_partition", "type_conforme"


class Landed(Mapping[str, DataFrame]):
    """Raw tables under a folder, each written on first use: a build derives only those that it reads."""

    def __init__(self, plans: Mapping[str, DataFrame], root: str):
        self._plans, self._root = plans, root
        self._written: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._written:
            df, path = self._plans[name], f"{self._root}/{name}"
            df.write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
            self._written[name] = df.sparkSession.read.parquet(path)
        return self._written[name]

    def __contains__(self, name: object) -> bool:
        return name in self._plans

    def __iter__(self) -> Iterator[str]:
        return iter(self._plans)

    def __len__(self) -> int:
        return len(self._plans)


class Warehouse:
    """Lazily built tables over one set of raw sources."""

    #: Day and type of the facts, and what spreads a commune that holds much of a year.
    FAITS = {"fct_ventes": ("date_vente", "type_logement", "id_mutation"), "fct_dpe_mensuel": ("mois", "type_logement", "etiquette_dpe")}

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        root: str,
        params: Params = Params(as_of=AS_OF),
        rows_per_file: int = ROWS_PER_FILE,
        departements_csv: str | None = None,
    ):
        self.spark, self.raw, self.root, self.params = spark, raw, root, params
        self.rows_per_file, self.departements_csv = rows_per_file, departements_csv
        self._written: dict[str, DataFrame] = {}
        self._files: str | None = None
        self._in_files: set[str] = set()

    def stored(self, name: str) -> DataFrame:
        """The written table with its partition column, built with its inputs on first use.

        Raw tables are read where they are.
        """
        if name in self.raw:
            return self.raw[name]
        if name not in self._written:
            path = self.scratch(name)
            self.write(self.plan(name), name, path)
            self._written[name] = self.spark.read.parquet(path)
        return self._written[name]

    def table(self, name: str) -> DataFrame:
        """The written table as its consumers know it."""
        return self.stored(name).drop(PARTITION, TYPE)

    def write(self, df: DataFrame, name: str, path: str) -> None:
        if name not in self.FAITS:
            df.write.option("maxRecordsPerFile", self.rows_per_file).parquet(path)
            return
        # Dealt by ranges of year and commune, so that files and row groups hold few communes each and a commune slicer
        # skips the others by their statistics. A heavy year or commune goes on over several tasks.
        day, kind, rest = self.FAITS[name]
        order = [PARTITION, "code_commune", day, rest]
        (
            df.withColumn(PARTITION, F.year(day))
            .withColumn(TYPE, X.type_conforme(kind))
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .write.option("maxRecordsPerFile", self.rows_per_file)
            .partitionBy(PARTITION)
            .parquet(path)
        )

    def scratch(self, name: str) -> str:
        """A new folder of this build."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def files(self, *names: str) -> str:
        """Folder holding the named raw sources as published files (all of them without a name), each written on first use."""
        if self._files is None:
            self._files = self.scratch("fichiers")
        missing = [n for n in names or self.raw if n not in self._in_files]
        adapters.write_files({n: self.table(n) for n in missing}, self._files)
        self._in_files.update(missing)
        return self._files

    def plan(self, name: str) -> DataFrame:
        """The table's definition over its written inputs; nothing is written for ``name`` itself."""
        return self.raw[name] if name in self.raw else getattr(self, f"_{name}")()

    def remove(self) -> None:
        """Delete the tables of this build; raw tables stay."""
        remove(self.spark, self.root)
        self._written, self._files, self._in_files = {}, None, set()

    def _departements(self) -> DataFrame:
        return seeds.departements(self.spark, self.departements_csv)

    def _stg_dvf_mutations(self) -> DataFrame:
        return staging.stg_dvf(self.table("dvf_mutations"))

    def _stg_dpe_logements(self) -> DataFrame:
        return staging.stg_dpe(self.table("dpe_logements"))

    def _stg_insee_indicateurs(self) -> DataFrame:
        return staging.stg_insee(self.table("insee_comparateur"))

    def _int_ventes_logement(self) -> DataFrame:
        return intermediate.ventes_logement(self.plan("stg_dvf_mutations"))

    def _int_dpe_logement_dernier(self) -> DataFrame:
        return intermediate.dpe_dernier(self.table("stg_dpe_logements"))

    def _int_insee_commune(self) -> DataFrame:
        return intermediate.insee_commune(self.plan("stg_insee_indicateurs"))

    def _dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark, self.params)

    def _dim_commune(self) -> DataFrame:
        return marts.dim_commune(
            self.table("int_insee_commune"),
            self.plan("stg_dvf_mutations"),
            self.table("stg_dpe_logements"),
            self.plan("departements"),
            self.params,
        )

    def _fct_ventes(self) -> DataFrame:
        return marts.fct_ventes(self.table("int_ventes_logement"), self.params)

    def _fct_dpe_mensuel(self) -> DataFrame:
        return marts.fct_dpe_mensuel(self.table("stg_dpe_logements"), self.params)

    def _mart_dpe_commune_etiquette(self) -> DataFrame:
        return marts.mart_dpe(self.table("int_dpe_logement_dernier"))

    def _mart_prix_commune_annee(self) -> DataFrame:
        return marts.mart_prix(self.table("int_ventes_logement"))

    def _mart_logement_commune(self) -> DataFrame:
        return marts.mart_logement(
            self.table("int_insee_commune"),
            self.table("int_ventes_logement"),
            self.table("int_dpe_logement_dernier"),
            self.params,
        )


MODELES = (
    "stg_dvf_mutations",
    "stg_dpe_logements",
    "stg_insee_indicateurs",
    "int_ventes_logement",
    "int_dpe_logement_dernier",
    "int_insee_commune",
    "dim_date",
    "dim_commune",
    "fct_ventes",
    "fct_dpe_mensuel",
    "mart_dpe_commune_etiquette",
    "mart_prix_commune_annee",
    "mart_logement_commune",
)
EXPORTS = MODELES[6:]


def raw_from_test_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "dvf_mutations": adapters.dvf_raw(spark, sf_dir),
        "dpe_logements": adapters.dpe_raw(spark, sf_dir),
        "insee_comparateur": adapters.insee_raw(spark, sf_dir),
    }


def _state(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of the files of a table, from the file system's listing."""
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    listed = place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place)
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed)


_OPEN: dict[tuple[str, ...], Warehouse] = {}


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The application's tables for one state of an input directory; each is built once per application."""
    state = [_state(spark, f"{sf_dir}/{t}.parquet") for t in adapters.TABLES]
    key = (spark.sparkContext.applicationId, sf_dir, repr(state))
    if key not in _OPEN:
        root = f"{shared_dir(spark)}/{hashlib.sha256(repr(key).encode()).hexdigest()[:12]}"
        _OPEN[key] = Warehouse(spark, Landed(raw_from_test_tables(spark, sf_dir), f"{root}/raw"), f"{root}/built")
    return _OPEN[key]
