"""Star schema and commune marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import expressions as X
from terroir.operators.groups import count_with_labels, most_frequent
from terroir.operators.joins import join_groups, keep_members, not_in
from terroir.operators.percentiles import Pct, percentiles
from terroir.params import Params

# Slice width of coordinates, in degrees.
L_COORD = 0.002


def dim_date(spark: SparkSession, params: Params = Params()) -> DataFrame:
    """One row per day from the start of the calendar to 31 December of the reference year."""
    jours = spark.range(1).select(
        F.explode(
            F.sequence(
                F.lit(params.debut_calendrier), F.lit(params.fin_calendrier), F.expr("interval 1 day")
            )
        ).alias("date")
    )
    an, mo, tri = F.year("date"), F.month("date"), F.quarter("date")
    semestre = F.when(mo <= 6, 1).otherwise(2)
    jour = F.weekday("date") + 1
    return jours.select(
        "date",
        an.alias("annee"),
        semestre.alias("semestre"),
        X.cle(an, F.concat(F.lit("S"), semestre.cast("string"))).alias("annee_semestre"),
        tri.alias("trimestre"),
        X.cle(an, F.concat(F.lit("T"), tri.cast("string"))).alias("annee_trimestre"),
        mo.alias("mois"),
        X.nieme(P.MOIS, mo).alias("nom_mois"),
        X.nieme(P.MOIS_COURTS, mo).alias("nom_mois_court"),
        F.date_format("date", "yyyy-MM").alias("annee_mois"),
        (an * 100 + mo).alias("annee_mois_tri"),
        X.mois("date").alias("premier_jour_mois"),
        jour.alias("jour_semaine"),
        X.nieme(P.JOURS, jour).alias("nom_jour"),
        (jour >= 6).alias("est_weekend"),
    )


def dim_commune(
    insee: DataFrame, stg_dvf: DataFrame, stg_dpe: DataFrame, departements: DataFrame, params: Params = Params()
) -> DataFrame:
    """One row per commune in scope, merged ("historical") communes of the facts included."""
    ident = ["code_commune", "nom_commune", "code_departement"]
    actuelles = insee.filter(X.in_scope("code_departement", params.departements)).select(*ident)
    # Each fact source shrinks to its distinct communes before the union.
    vues = (
        stg_dvf.select(*ident).distinct().unionByName(stg_dpe.select(*ident).distinct())
        .filter(X.in_scope("code_departement", params.departements))
    )
    historiques = (
        not_in(vues, actuelles, "code_commune")
        .groupBy("code_commune")
        .agg(F.min("nom_commune").alias("nom_commune"), F.min("code_departement").alias("code_departement"))
    )
    communes = actuelles.withColumn("est_commune_historique", F.lit(False)).unionByName(
        historiques.withColumn("est_commune_historique", F.lit(True))
    )
    coordonnees = percentiles(
        keep_members(
            stg_dvf.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()), communes, "code_commune"
        ),
        ["code_commune"],
        [Pct("latitude", "latitude", width=L_COORD), Pct("longitude", "longitude", width=L_COORD)],
    ).select("code_commune", X.rnd("latitude", 5).alias("latitude"), X.rnd("longitude", 5).alias("longitude"))
    attributs = insee.select(
        "code_commune", "population", "superficie_km2", "niveau_vie_median", "niveau_vie_sous_secret",
        "taux_pauvrete", "nb_logements", "nb_residences_principales", "nb_logements_vacants",
        "nb_residences_secondaires", "nb_proprietaires",
    )
    return (
        communes.join(departements.select("code_departement", "nom_departement", "nom_region"), "code_departement", "left")
        .join(coordonnees, "code_commune", "left")
        .join(attributs, "code_commune", "left")
        .select(
            "code_commune",
            "nom_commune",
            F.concat("nom_commune", F.lit(" ("), "code_departement", F.lit(")")).alias("nom_commune_dep"),
            "code_departement",
            "nom_departement",
            "nom_region",
            "est_commune_historique",
            "latitude",
            "longitude",
            "population",
            "superficie_km2",
            X.ratio("population", "superficie_km2", 1).alias("densite_hab_km2"),
            X.taille_commune("population").alias("taille_commune"),
            "niveau_vie_median",
            "niveau_vie_sous_secret",
            "taux_pauvrete",
            *[
                X.rounded_int(c).alias(c)
                for c in (
                    "nb_logements", "nb_residences_principales", "nb_logements_vacants",
                    "nb_residences_secondaires", "nb_proprietaires",
                )
            ],
        )
    )


def fct_ventes(ventes: DataFrame, params: Params = Params()) -> DataFrame:
    """One plausible sale in scope, at its finest grain: medians do not add up."""
    return ventes.filter(F.col("est_prix_plausible") & X.in_scope("code_departement", params.departements)).select(
        "id_mutation",
        F.col("date_mutation").alias("date_vente"),
        "code_commune",
        F.col("type_local").alias("type_logement"),
        F.col("surface_reelle_bati").alias("surface_m2"),
        F.col("nombre_pieces_principales").alias("nb_pieces"),
        F.col("valeur_fonciere").alias("prix"),
        "prix_m2",
        "latitude",
        "longitude",
    )


def dpe_du_flux(dpe: DataFrame, params: Params = Params()) -> DataFrame:
    """Dated diagnostics of single dwellings in scope, with the grouping columns of the flow fact."""
    return dpe.filter(
        F.col("type_batiment").isin(*P.TYPES_DPE)
        & X.in_scope("code_departement", params.departements)
        & F.col("date_etablissement_dpe").isNotNull()
    ).select(
        X.mois("date_etablissement_dpe").alias("mois"),
        "code_commune",
        F.col("type_batiment").alias("type_logement"),
        X.periode_connue("periode_construction").alias("periode_construction"),
        "etiquette_dpe",
        "surface_habitable",
    )


CLES_FLUX = ["mois", "code_commune", "type_logement", "periode_construction", "etiquette_dpe"]


def fct_dpe_mensuel(stg_dpe: DataFrame, params: Params = Params()) -> DataFrame:
    """Diagnostics carried out per month, commune, type, period and label: a flow, additive."""
    counted = dpe_du_flux(stg_dpe, params).groupBy(*CLES_FLUX).agg(
        F.count(F.lit(1)).alias("nb_dpe"), F.sum("surface_habitable").alias("surface")
    )
    return flux_final(counted)


def flux_final(counted: DataFrame) -> DataFrame:
    """Derived columns of the flow fact, once its groups are summed."""
    return counted.select(
        "mois",
        "code_commune",
        "type_logement",
        "periode_construction",
        X.periode_tri("periode_construction").alias("periode_construction_tri"),
        "etiquette_dpe",
        X.est_passoire("etiquette_dpe").alias("est_passoire_thermique"),
        "nb_dpe",
        X.rnd("surface", 1).alias("surface_totale_m2"),
    )


def mart_dpe(dpe_dernier: DataFrame) -> DataFrame:
    """Stock of dwellings per commune, type, period and label."""
    keys = ["code_commune", "type_batiment", "periode_construction", "etiquette_dpe"]
    counted = count_with_labels(
        dpe_dernier.withColumn("periode_construction", X.periode_connue("periode_construction")),
        keys,
        ["nom_commune", "code_departement"],
        "nb_logements",
    )
    return counted.select(
        X.cle("code_commune", "type_batiment", "etiquette_dpe", "periode_construction").alias("cle"),
        "code_commune",
        "nom_commune",
        "code_departement",
        "type_batiment",
        "periode_construction",
        X.periode_tri("periode_construction").alias("periode_construction_tri"),
        "etiquette_dpe",
        "nb_logements",
    )


def mart_prix(ventes: DataFrame) -> DataFrame:
    """Median prices per commune, year and type."""
    keys = ["code_commune", "annee", "type_local"]
    plausibles = ventes.filter("est_prix_plausible")
    counted = count_with_labels(plausibles, keys, ["nom_commune", "code_departement"], "nb_ventes")
    pct = percentiles(
        plausibles,
        keys,
        [
            Pct("prix_m2_median", "prix_m2"),
            Pct("prix_m2_q1", "prix_m2", 0.25),
            Pct("prix_m2_q3", "prix_m2", 0.75),
            Pct("prix_median", "valeur_fonciere"),
            Pct("surface_mediane", "surface_reelle_bati"),
        ],
    )
    return join_groups(counted, pct, keys).select(
        X.cle(*keys).alias("cle"),
        "code_commune",
        "nom_commune",
        "code_departement",
        "annee",
        "type_local",
        "nb_ventes",
        *[X.rnd(c).alias(c) for c in ("prix_m2_median", "prix_m2_q1", "prix_m2_q3", "prix_median")],
        X.rnd("surface_mediane", 1).alias("surface_mediane"),
        (F.col("nb_ventes") >= P.MIN_VENTES_CELLULE).alias("est_fiable"),
    )


def mart_logement(insee: DataFrame, ventes: DataFrame, dpe_dernier: DataFrame, params: Params = Params()) -> DataFrame:
    """One row per commune in scope: statistics, recent prices, energy, affordability.

    Both fact tables are aggregated to communes before any join, and only for communes in scope.
    """
    communes = insee.filter(X.in_scope("code_departement", params.departements))
    key = ["code_commune"]

    recentes = keep_members(
        ventes.filter(F.col("est_prix_plausible") & F.col("annee").isin(*params.annees_recentes)), communes, "code_commune"
    )
    est = lambda t: F.col("type_local") == t
    v_nb = recentes.groupBy(*key).agg(
        F.count(F.lit(1)).alias("v_nb"),
        F.count_if(est("Appartement")).alias("nb_ventes_appartement"),
        F.count_if(est("Maison")).alias("nb_ventes_maison"),
    )
    v_pct = percentiles(
        recentes.select(
            *key,
            F.when(est("Appartement"), F.col("prix_m2")).alias("m2_appartement"),
            F.when(est("Maison"), F.col("prix_m2")).alias("m2_maison"),
            "valeur_fonciere",
            "surface_reelle_bati",
        ),
        key,
        [
            Pct("prix_m2_median_appartement", "m2_appartement"),
            Pct("prix_m2_median_maison", "m2_maison"),
            Pct("prix_median_logement", "valeur_fonciere"),
            Pct("surface_mediane_vendue", "surface_reelle_bati"),
        ],
    )

    dwellings = keep_members(dpe_dernier, communes, "code_commune")
    d_nb = dwellings.groupBy(*key).agg(
        F.count(F.lit(1)).alias("d_nb"),
        F.avg(F.col("est_passoire_thermique").cast("int")).alias("d_passoires"),
        F.avg(F.col("est_logement_performant").cast("int")).alias("d_performants"),
    )
    d_pct = percentiles(dwellings, key, [Pct("conso", "conso_energie_primaire_m2")])
    d_mode = most_frequent(dwellings, key, "etiquette_dpe", "etiquette_dpe_la_plus_frequente")

    wide = communes
    for part in (v_nb, v_pct, d_nb, d_pct, d_mode):
        wide = wide.join(part, "code_commune", "left")
    prix_median = X.rnd("prix_median_logement")
    nb_v, nb_d = F.coalesce("v_nb", F.lit(0)), F.coalesce("d_nb", F.lit(0))
    return wide.select(
        "code_commune",
        "nom_commune",
        "code_departement",
        "population",
        "superficie_km2",
        X.ratio("population", "superficie_km2", 1).alias("densite_hab_km2"),
        "niveau_vie_median",
        "niveau_vie_sous_secret",
        "taux_pauvrete",
        "nb_logements",
        X.ratio("nb_logements_vacants", "nb_logements", 4).alias("part_logements_vacants"),
        X.ratio("nb_residences_secondaires", "nb_logements", 4).alias("part_residences_secondaires"),
        X.ratio("nb_proprietaires", "nb_residences_principales", 4).alias("part_proprietaires"),
        nb_v.alias("nb_ventes"),
        "nb_ventes_appartement",
        "nb_ventes_maison",
        X.rnd("prix_m2_median_appartement").alias("prix_m2_median_appartement"),
        X.rnd("prix_m2_median_maison").alias("prix_m2_median_maison"),
        prix_median.alias("prix_median_logement"),
        X.rnd("surface_mediane_vendue", 1).alias("surface_mediane_vendue"),
        (nb_v >= P.MIN_VENTES_COMMUNE).alias("prix_est_fiable"),
        X.ratio(prix_median, "niveau_vie_median", 1).alias("annees_niveau_vie_pour_acheter"),
        nb_d.alias("nb_logements_diagnostiques"),
        X.rnd("d_passoires", 4).alias("part_passoires_thermiques"),
        X.rnd("d_performants", 4).alias("part_logements_performants"),
        X.rnd("conso").alias("conso_energie_mediane_m2"),
        "etiquette_dpe_la_plus_frequente",
        (nb_d >= P.MIN_DPE_COMMUNE).alias("dpe_est_fiable"),
        F.lit(params.periode_dvf).alias("periode_dvf"),
    )
