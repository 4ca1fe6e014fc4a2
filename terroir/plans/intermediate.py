"""Intermediate tables: single-dwelling sales, latest diagnostic per dwelling, commune statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import expressions as X
from terroir.operators.latest import last_per_key


def ventes_logement(stg_dvf: DataFrame) -> DataFrame:
    """One row per sale of exactly one dwelling without business premises.

    "Exactly one distinct dwelling" means that the smallest and the greatest dwelling tuple of the sale
    are the same, so no distinct, no join and a single shuffle are needed. The state per sale is a
    handful of values and lines are pre-aggregated before the shuffle.
    """
    habitable = F.col("type_local").isin(*P.TYPES_DVF)
    local = F.struct("type_local", "surface_reelle_bati", "nombre_pieces_principales", "lot1_numero")
    located = F.col("longitude").isNotNull() & F.col("latitude").isNotNull()
    per_sale = (
        stg_dvf.filter(F.col("nature_mutation") == P.NATURE_VENTE)
        .groupBy("id_mutation")
        .agg(
            F.min("date_mutation").alias("date_mutation"),
            F.min("valeur_fonciere").alias("valeur_fonciere"),
            F.min("code_commune").alias("code_commune"),
            F.min("nom_commune").alias("nom_commune"),
            F.min("code_departement").alias("code_departement"),
            F.min(F.when(located, F.struct("longitude", "latitude"))).alias("point"),
            F.min("longitude").alias("lon_seule"),
            F.min("latitude").alias("lat_seule"),
            F.min(F.when(habitable, local)).alias("premier"),
            F.max(F.when(habitable, local)).alias("dernier"),
            F.bool_or(F.col("type_local").eqNullSafe(P.TYPE_ACTIVITE)).alias("a_activite"),
        )
    )
    surface, prix = F.col("premier.surface_reelle_bati"), F.col("valeur_fonciere")
    return per_sale.filter(
        F.col("premier").isNotNull()
        & F.col("premier").eqNullSafe(F.col("dernier"))
        & ~F.col("a_activite")
        & (surface > 0)
    ).select(
        "id_mutation",
        "date_mutation",
        F.year("date_mutation").alias("annee"),
        "code_commune",
        "nom_commune",
        "code_departement",
        F.col("premier.type_local").alias("type_local"),
        surface.alias("surface_reelle_bati"),
        F.col("premier.nombre_pieces_principales").alias("nombre_pieces_principales"),
        "valeur_fonciere",
        X.prix_m2(prix, surface).alias("prix_m2"),
        F.coalesce("point.longitude", "lon_seule").alias("longitude"),
        F.coalesce("point.latitude", "lat_seule").alias("latitude"),
        X.prix_plausible(prix, surface).alias("est_prix_plausible"),
    )


def dpe_avec_cle(dpe: DataFrame) -> DataFrame:
    """Diagnostics of single dwellings with their rebuilt dwelling key."""
    return dpe.filter(F.col("type_batiment").isin(*P.TYPES_DPE) & F.col("code_commune").isNotNull()).select(
        X.cle_logement("identifiant_ban", "numero_dpe", "type_batiment", "surface_habitable").alias("cle_logement"),
        "numero_dpe",
        "date_etablissement_dpe",
        "code_commune",
        "nom_commune",
        "code_departement",
        "type_batiment",
        "periode_construction",
        "annee_construction",
        "surface_habitable",
        "etiquette_dpe",
        "etiquette_ges",
        "conso_energie_primaire_m2",
        "emission_ges_m2",
    )


def dpe_dernier(stg_dpe: DataFrame) -> DataFrame:
    """One row per dwelling: its latest diagnostic."""
    latest = last_per_key(dpe_avec_cle(stg_dpe), ["cle_logement"], ["date_etablissement_dpe", "numero_dpe"])
    return latest.select(
        "*",
        X.est_passoire("etiquette_dpe").alias("est_passoire_thermique"),
        X.est_performant("etiquette_dpe").alias("est_logement_performant"),
    )


def insee_commune(stg_insee: DataFrame) -> DataFrame:
    """One row per commune, one column per indicator at its latest year."""
    latest = last_per_key(
        stg_insee.select("code_commune", "indicateur", "annee", "valeur", "est_secret_statistique", "nom_commune"),
        ["code_commune", "indicateur"],
        ["annee"],
    )
    is_ = lambda code: F.col("indicateur") == code
    return (
        latest.groupBy("code_commune")
        .agg(
            F.min("nom_commune").alias("nom_commune"),
            *[F.max(F.when(is_(code), F.col("valeur"))).alias(name) for code, name in P.INDICATEURS_INSEE],
            F.bool_or(F.col("est_secret_statistique") & is_(P.INDICATEUR_NIVEAU_VIE)).alias("niveau_vie_sous_secret"),
        )
        .select(
            "code_commune",
            "nom_commune",
            F.substring("code_commune", 1, 2).alias("code_departement"),
            *[name for _, name in P.INDICATEURS_INSEE],
            "niveau_vie_sous_secret",
        )
    )
