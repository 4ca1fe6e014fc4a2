"""Raw tables of the three public sources, derived from the driver's test tables.

They stand where the landed files stand in production: every text column is text, prices carry decimal
commas, diagnostics contain technical duplicates and some values are unreadable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir import params as P

#: The test tables that the sources are derived from.
TABLES = ("lineitem", "orders", "customer", "part", "events")
_DEPS = tuple(d[0] for d in P.SEED_DEPARTEMENTS)
_LOADED_AT = "timestamp'2026-01-01 00:00:00'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dep(n: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in _DEPS]), (n % 5 + 1).cast("int"))


def _commune(k: Column, n: Column) -> Column:
    """Six sevenths of the keys are in two dense communes of a department; the others' communes grow with the keys.

    Of these, key k is in one of the first sqrt(k) communes, so that earlier ones get more keys.
    """
    opened = F.floor(F.sqrt(k)) + 1
    rang = F.when(k % 7 != 6, F.floor(k / 7) % 2 + 1).otherwise((F.floor(k / 7) % opened) % 997 + 3)
    return F.concat(_dep(n), F.lpad(rang.cast("int").cast("string"), 3, "0"))


def dvf_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a sale, its lines are the premises; returned lines lie on two parcels."""
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )
    orders = _table(spark, sf_dir, "orders")
    cust = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")

    # Lines meet their narrow parts first and the orders, which have their customers by then, last: two shuffles of them.
    joined = (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(orders.join(cust, orders.o_custkey == cust.c_custkey), li.l_orderkey == orders.o_orderkey)
        .withColumn("k", F.explode(F.when(F.col("l_returnflag") == "R", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    )
    c, n = F.col("c_custkey"), F.col("c_nationkey")
    day = F.date_add(
        F.lit("2021-01-01").cast("date"),
        (F.datediff(F.to_date("o_orderdate"), F.lit("1995-01-01").cast("date")) % 1826).cast("int"),
    )
    price = F.col("o_totalprice").cast("string")
    type_local = (
        F.when(F.col("p_type") == "STANDARD", "Maison")
        .when(F.col("p_type") == "MEDIUM", "Appartement")
        .when(F.col("p_type") == "LARGE", P.TYPE_ACTIVITE)
        .when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
        .otherwise("Dépendance")
    )
    code_type = (
        F.when(F.col("p_type") == "STANDARD", "1")
        .when(F.col("p_type") == "MEDIUM", "2")
        .when(F.col("p_type") == "LARGE", "4")
        .when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
        .otherwise("3")
    )
    located = F.col("l_partkey") % 11 != 0
    step = F.lit(0.01).cast("double")
    return joined.select(
        F.col("o_orderkey").cast("string").alias("id_mutation"),
        day.cast("string").alias("date_mutation"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Vente en l'état futur d'achèvement")
        .when(F.col("o_orderpriority") == "5-LOW", "Adjudication")
        .otherwise("Vente")
        .alias("nature_mutation"),
        F.when(F.col("o_orderkey") % 3 == 0, F.replace(price, F.lit("."), F.lit(",")))
        .when(F.col("o_orderkey") % 97 == 0, "")
        .otherwise(price)
        .alias("valeur_fonciere"),
        F.concat(F.lit("59"), F.lpad((c % 1000).cast("string"), 3, "0")).alias("code_postal"),
        _commune(c, n).alias("code_commune"),
        F.concat(F.lit("Commune "), _commune(c, n)).alias("nom_commune"),
        _dep(n).alias("code_departement"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("k").cast("string")).alias("id_parcelle"),
        F.col("l_linenumber").cast("string").alias("lot1_numero"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit(".0")).alias("nombre_lots"),
        code_type.alias("code_type_local"),
        type_local.alias("type_local"),
        F.when(F.col("l_suppkey") % 50 != 0, (F.col("l_quantity") * 4).cast("string")).alias("surface_reelle_bati"),
        (F.col("p_size") % 8).cast("string").alias("nombre_pieces_principales"),
        F.when(F.col("l_linenumber") == 1, (F.col("l_quantity") * 10).cast("string")).alias("surface_terrain"),
        F.when(located, (2 + (c % 50) * step).cast("string")).alias("longitude"),
        F.when(located, (49 + (c % 70) * step).cast("string")).alias("latitude"),
        F.expr(_LOADED_AT).alias("_loaded_at"),
    )


def dpe_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An event is a diagnostic; one in a hundred was downloaded twice."""
    k = F.get_json_object("props", "$.k").cast("int")
    ev = (
        _table(spark, sf_dir, "events")
        .select("event_id", "user_id", "event_type", "value", k.alias("k"))
        .withColumn("replica", F.explode(F.when(F.col("event_id") % 100 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    )
    e, u, v = F.col("event_id"), F.col("user_id"), F.col("value")

    def numero(x: Column) -> Column:
        return F.concat(F.lit("DPE"), F.lpad(x.cast("string"), 8, "0"))

    def letter(x: Column) -> Column:
        return F.lower(F.substring(F.lit("ABCDEFG"), (F.floor(x) % 7 + 1).cast("int"), F.lit(1)))

    date = F.date_add(F.lit("2021-07-01").cast("date"), ((e * 37) % 1600).cast("int"))
    period = F.element_at(F.array(*[F.lit(p) for p in P.PERIODES_CONSTRUCTION]), (F.col("k") % 10 + 1).cast("int"))
    return ev.select(
        numero(e).alias("numero_dpe"),
        F.when(e % 7 == 0, numero(e - 1)).alias("numero_dpe_remplace"),
        F.when(e % 211 == 0, "inconnue").otherwise(date.cast("string")).alias("date_etablissement_dpe"),
        F.when(e % 53 != 0, _commune(u, u)).alias("code_insee_ban"),
        F.concat(F.lit("Commune "), _commune(u, u)).alias("nom_commune_ban"),
        _dep(u).alias("code_departement_ban"),
        F.when(e % 40 != 0, F.concat(F.lit("BAN"), u.cast("string"))).alias("identifiant_ban"),
        F.when(F.col("event_type") == "view", "Maison")
        .when(F.col("event_type") == "signup", "maison")
        .when(F.col("event_type") == "error", "immeuble")
        .otherwise("Appartement")
        .alias("type_batiment"),
        F.when(F.col("k") % 23 != 0, period).alias("periode_construction"),
        F.concat((1900 + F.col("k")).cast("string"), F.lit(".0")).alias("annee_construction"),
        (F.floor(v / 4) * 5 + 9).cast("double").cast("string").alias("surface_habitable_logement"),
        letter(v).alias("etiquette_dpe"),
        letter(v / 2).alias("etiquette_ges"),
        F.floor(v * 4).cast("string").alias("conso_5_usages_par_m2_ep"),
        F.floor(v / 2).cast("string").alias("emission_ges_5_usages_par_m2"),
        (F.expr(_LOADED_AT) + F.make_interval(secs=F.col("replica"))).alias("_loaded_at"),
    )


def insee_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long-form commune statistics for two years, plus one department row to filter out."""
    per_commune = (
        _table(spark, sf_dir, "customer")
        .groupBy(_commune(F.col("c_custkey"), F.col("c_nationkey")).alias("GEO"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(~F.col("GEO").endswith("005"))
        .withColumn("annee", F.explode(F.array(F.lit(2022), F.lit(2023))))
    )
    n = F.col("n")
    measures = (
        ("POP", n * 100 + F.col("annee") - 2022),
        ("SUP", n * F.lit(0.25).cast("double")),
        ("MED_SL", 18000 + (n * 37) % 9000),
        ("PR_MD60", 10 + n % 15),
        ("DWELLINGS", n * F.lit(50.5).cast("double")),
        ("DWELLINGS_OCS_DW_MAIN", n * 40),
        ("DWELLINGS_OCS_DW_MAIN_TSH_100", n * 22),
        ("DWELLINGS_OCS_DW_VAC", n * 4),
        ("DWELLINGS_OCS_DW_SEC_DW_OCC", n * F.lit(6.5).cast("double")),
    )
    rows = F.inline(F.array(*[F.struct(F.lit(m).alias("TAB_MEASURE"), v.cast("double").alias("OBS_VALUE")) for m, v in measures]))
    long = per_commune.select("GEO", "annee", rows).select(
        "GEO",
        F.concat(F.lit("Commune "), F.col("GEO")).alias("GEO_LABEL"),
        F.lit("COM").alias("GEO_OBJECT"),
        "TAB_MEASURE",
        F.col("TAB_MEASURE").alias("TAB_MEASURE_LABEL"),
        F.col("annee").cast("string").alias("TIME_PERIOD"),
        "OBS_VALUE",
        F.when((F.col("TAB_MEASURE") == "MED_SL") & F.col("GEO").endswith("004"), "C").alias("CONF_STATUS"),
        F.lit("2026").alias("GEO_REF"),
    )
    extra = spark.createDataFrame(
        [("59", "Nord", "DEP", "POP", "POP", "2023", 2600000.0, None, "2026")], schema=long.schema
    )
    return long.unionByName(extra).withColumn("_loaded_at", F.expr(_LOADED_AT))


#: Files that a task holds open at once; the sales of a table are of fewer years.
OPEN_FILES = 64


def _write_by_year(df: DataFrame, path: str) -> None:
    """Gzip CSV in a folder for each year; a task writes its rows to the files of their years as they come.

    Spark sorts all rows of a task by year otherwise, to have one file open at a time.
    """
    conf, key = df.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, OPEN_FILES)
    try:
        (
            df.write.mode("append")
            .partitionBy("annee")
            .option("header", True)
            .option("escape", '"')
            .option("compression", "gzip")
            .csv(path)
        )
    finally:
        conf.set(key, before)


def _write_dvf(raw: DataFrame, root: str) -> None:
    dvf = raw.drop("_loaded_at").withColumn("annee", F.substring("date_mutation", 1, 4))
    columns = [c for c in dvf.columns if c != "annee"]
    # Partition directories end in the year, as the published folders do.
    for part, cols in (
        (dvf.filter(F.col("annee") < "2024"), columns),
        (dvf.filter(F.col("annee") >= "2024").withColumn("ancien_code_commune", F.col("code_commune")), [*columns[::-1], "ancien_code_commune"]),
    ):
        _write_by_year(part.select(*cols, "annee"), f"{root}/dvf")


def _write_dpe(raw: DataFrame, root: str) -> None:
    # Consumption is a JSON number in the source and text in the raw layer; unknown fields are ignored.
    dpe = raw.drop("_loaded_at").withColumn("conso_5_usages_par_m2_ep", F.col("conso_5_usages_par_m2_ep").cast("int"))
    dpe.withColumn("version_dpe", F.lit(2.4)).write.option("compression", "gzip").json(f"{root}/dpe")


def _write_insee(raw: DataFrame, root: str) -> None:
    raw.drop("_loaded_at").write.parquet(f"{root}/insee/comparateur.parquet")


_WRITERS = {"dvf_mutations": _write_dvf, "dpe_logements": _write_dpe, "insee_comparateur": _write_insee}


def write_files(raw: dict[str, DataFrame], root: str) -> None:
    """The raw tables as published files: gzip CSV per year with two header layouts, gzip JSON lines, Parquet.

    Files of 2024 on list their columns in reverse order and carry one more column.
    """
    for name, df in raw.items():
        _WRITERS[name](df, root)


def _doubled(df: DataFrame) -> DataFrame:
    return df.unionByName(df.filter(F.month("mois") == 1))


#: Faults put into built tables, so that checks have something to find.
FAULTS = {
    "mart_dpe_commune_etiquette": lambda df: df.withColumn("etiquette_dpe", F.translate("etiquette_dpe", "AG", "ZH")),
    "fct_dpe_mensuel": _doubled,
    "int_insee_commune": lambda df: df.withColumn(
        "population", F.when(~F.col("code_commune").endswith("1"), F.col("population"))
    ),
    "mart_prix_commune_annee": lambda df: df.withColumn(
        "prix_m2_median", F.when(F.col("annee") == 2024, F.col("prix_m2_median") * 100.0).otherwise(F.col("prix_m2_median"))
    ),
    "stg_dvf_mutations": lambda df: df.withColumn(
        "nature_mutation", F.when(F.col("code_commune").startswith("59"), "Don").otherwise(F.col("nature_mutation"))
    ),
    "mart_logement_commune": lambda df: df.withColumn(
        "part_proprietaires",
        F.when(F.col("code_commune").startswith("62"), F.col("part_proprietaires") + 1.5).otherwise(F.col("part_proprietaires")),
    ),
}


class Faulty:
    """The tables of a warehouse with ``FAULTS`` in them."""

    def __init__(self, inner):
        self._inner = inner

    def table(self, name: str) -> DataFrame:
        return FAULTS.get(name, lambda df: df)(self._inner.table(name))

    def plan(self, name: str) -> DataFrame:
        return FAULTS.get(name, lambda df: df)(self._inner.plan(name))
