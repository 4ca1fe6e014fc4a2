"""Staging: types, names and technical duplicates; the grain is the source's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir.functions import expressions as X
from terroir.operators.latest import first_per_key


def stg_dvf(raw: DataFrame) -> DataFrame:
    jour = F.col("date_mutation").cast("date")
    return raw.select(
        "id_mutation",
        jour.alias("date_mutation"),
        F.year(jour).alias("annee"),
        "nature_mutation",
        X.decimal_comma("valeur_fonciere").alias("valeur_fonciere"),
        "code_postal",
        "code_commune",
        "nom_commune",
        "code_departement",
        "id_parcelle",
        "lot1_numero",
        X.to_int("nombre_lots").alias("nombre_lots"),
        "code_type_local",
        "type_local",
        X.to_double("surface_reelle_bati").alias("surface_reelle_bati"),
        X.to_int("nombre_pieces_principales").alias("nombre_pieces_principales"),
        X.to_double("surface_terrain").alias("surface_terrain"),
        X.to_double("longitude").alias("longitude"),
        X.to_double("latitude").alias("latitude"),
        "_loaded_at",
    )


def dpe_types(raw: DataFrame) -> DataFrame:
    """Typed diagnostics before the technical duplicates are removed."""
    return raw.select(
        "numero_dpe",
        "numero_dpe_remplace",
        F.col("date_etablissement_dpe").try_cast("date").alias("date_etablissement_dpe"),
        F.col("code_insee_ban").alias("code_commune"),
        F.col("nom_commune_ban").alias("nom_commune"),
        F.col("code_departement_ban").alias("code_departement"),
        "identifiant_ban",
        F.lower("type_batiment").alias("type_batiment"),
        "periode_construction",
        X.to_int("annee_construction").alias("annee_construction"),
        X.to_double("surface_habitable_logement").alias("surface_habitable"),
        F.upper("etiquette_dpe").alias("etiquette_dpe"),
        F.upper("etiquette_ges").alias("etiquette_ges"),
        X.to_double("conso_5_usages_par_m2_ep").alias("conso_energie_primaire_m2"),
        X.to_double("emission_ges_5_usages_par_m2").alias("emission_ges_m2"),
        "_loaded_at",
    )


def stg_dpe(raw: DataFrame) -> DataFrame:
    """One row per diagnostic number: the first one loaded."""
    return first_per_key(dpe_types(raw), ["numero_dpe"], ["_loaded_at"])


def stg_insee(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("GEO_OBJECT") == "COM").select(
        F.col("GEO").alias("code_commune"),
        F.col("GEO_LABEL").alias("nom_commune"),
        F.col("TAB_MEASURE").alias("indicateur"),
        F.col("TAB_MEASURE_LABEL").alias("libelle_indicateur"),
        F.col("TIME_PERIOD").cast("int").alias("annee"),
        X.masked_value("OBS_VALUE", "CONF_STATUS").alias("valeur"),
        X.is_masked("CONF_STATUS").alias("est_secret_statistique"),
        F.col("GEO_REF").alias("millesime_geographie"),
    )
