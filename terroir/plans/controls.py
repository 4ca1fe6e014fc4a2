"""The checks of every table, declared once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir import params as P
from terroir.operators import quality as Q
from terroir.plans.marts import CLES_FLUX
from terroir.plans.warehouse import Warehouse

NON_NULS = {
    "dvf_mutations": ["id_mutation"],
    "dpe_logements": ["numero_dpe"],
    "stg_dvf_mutations": ["id_mutation", "date_mutation", "code_commune"],
    "stg_dpe_logements": ["numero_dpe", "code_commune"],
    "stg_insee_indicateurs": ["code_commune", "indicateur"],
    "int_ventes_logement": ["id_mutation", "surface_reelle_bati"],
    "int_dpe_logement_dernier": ["cle_logement"],
    "int_insee_commune": ["code_commune"],
    "dim_date": ["date"],
    "dim_commune": ["code_commune", "nom_departement"],
    "fct_ventes": ["id_mutation", "date_vente", "code_commune"],
    "fct_dpe_mensuel": ["mois", "nb_dpe"],
    "mart_prix_commune_annee": ["cle", "code_commune", "nb_ventes", "prix_m2_median"],
    "mart_logement_commune": ["code_commune", "population"],
    "mart_dpe_commune_etiquette": ["cle"],
    "departements": ["code_departement"],
}
UNIQUES = (
    ("dpe_logements", "numero_dpe", Q.ALERTE),
    ("stg_dpe_logements", "numero_dpe", Q.ERREUR),
    ("int_ventes_logement", "id_mutation", Q.ERREUR),
    ("int_dpe_logement_dernier", "cle_logement", Q.ERREUR),
    ("int_insee_commune", "code_commune", Q.ERREUR),
    ("dim_date", "date", Q.ERREUR),
    ("dim_commune", "code_commune", Q.ERREUR),
    ("fct_ventes", "id_mutation", Q.ERREUR),
    ("mart_prix_commune_annee", "cle", Q.ERREUR),
    ("mart_logement_commune", "code_commune", Q.ERREUR),
    ("mart_dpe_commune_etiquette", "cle", Q.ERREUR),
    ("departements", "code_departement", Q.ERREUR),
)
VALEURS = (
    ("stg_dpe_logements", "etiquette_dpe", P.ETIQUETTES),
    ("stg_dpe_logements", "type_batiment", (*P.TYPES_DPE, "immeuble")),
    ("int_ventes_logement", "type_local", P.TYPES_DVF),
    ("mart_dpe_commune_etiquette", "etiquette_dpe", P.ETIQUETTES),
)
RELATIONS = (
    ("int_ventes_logement", "code_commune", "int_insee_commune", "code_commune", Q.ALERTE),
    ("int_dpe_logement_dernier", "code_commune", "int_insee_commune", "code_commune", Q.ALERTE),
    ("fct_ventes", "date_vente", "dim_date", "date", Q.ERREUR),
    ("fct_ventes", "code_commune", "dim_commune", "code_commune", Q.ERREUR),
    ("fct_dpe_mensuel", "mois", "dim_date", "date", Q.ERREUR),
    ("fct_dpe_mensuel", "code_commune", "dim_commune", "code_commune", Q.ERREUR),
)
VUES = ("stg_dvf_mutations", "stg_insee_indicateurs", "departements")
PARTS = (
    "part_logements_vacants",
    "part_residences_secondaires",
    "part_proprietaires",
    "part_passoires_thermiques",
    "part_logements_performants",
)


def _t(w: Warehouse, name: str) -> DataFrame:
    return w.plan(name) if name in VUES else w.table(name)


def _verify(w: Warehouse, checks: list[Q.Check]) -> DataFrame:
    return Q.verify(lambda name: _t(w, name), checks)


def _non_nuls() -> list[Q.Check]:
    return [Q.not_null(t, c) for t, columns in NON_NULS.items() for c in columns]


def _population() -> list[Q.Check]:
    """Conditional check: one overseas department has no population in this edition."""
    return [Q.not_null("int_insee_commune", "population", ~F.col("code_commune").startswith("976"))]


def _uniques() -> list[Q.Check]:
    return [Q.unique(*u) for u in UNIQUES]


def _valeurs() -> list[Q.Check]:
    return [Q.accepted_values(*v) for v in VALEURS]


def _relations() -> list[Q.Check]:
    return [Q.relationship(*r) for r in RELATIONS]


def _combinaison() -> list[Q.Check]:
    return [Q.unique_combination("fct_dpe_mensuel", CLES_FLUX)]


def _prix_hors_bornes() -> Column:
    """Median prices outside the plausible range."""
    return ~F.col("prix_m2_median").between(P.PRIX_M2_MIN, P.PRIX_M2_MAX)


def _parts_hors_bornes() -> Column:
    """A ratio outside [0, 1]; NULL ratios pass."""
    return reduce(lambda a, b: a | b, [F.coalesce(~F.col(c).between(0, 1), F.lit(False)) for c in PARTS])


def non_nuls(w: Warehouse) -> DataFrame:
    return _verify(w, _non_nuls())


def population_renseignee(w: Warehouse) -> DataFrame:
    return _verify(w, _population())


def uniques(w: Warehouse) -> DataFrame:
    return _verify(w, _uniques())


def valeurs(w: Warehouse) -> DataFrame:
    return _verify(w, _valeurs())


def relations(w: Warehouse) -> DataFrame:
    return _verify(w, _relations())


def combinaison(w: Warehouse) -> DataFrame:
    return _verify(w, _combinaison())


def prix_hors_bornes(w: Warehouse) -> DataFrame:
    return _t(w, "mart_prix_commune_annee").filter(_prix_hors_bornes())


def natures_inconnues(w: Warehouse) -> DataFrame:
    """Sale natures outside the known list, with their number of lines."""
    return Q.unexpected_values(_t(w, "stg_dvf_mutations"), "nature_mutation", P.NATURES_MUTATION)


def natures(w: Warehouse) -> DataFrame:
    """Every sale nature with its number of lines and whether it is known."""
    return (
        _t(w, "stg_dvf_mutations")
        .groupBy("nature_mutation")
        .agg(F.count(F.lit(1)).alias("nb_lignes"))
        .withColumn("est_connue", F.col("nature_mutation").isin(*P.NATURES_MUTATION))
    )


def parts_hors_bornes(w: Warehouse) -> DataFrame:
    """Communes with a ratio outside [0, 1]."""
    return _t(w, "mart_logement_commune").filter(_parts_hors_bornes()).select("code_commune", "nom_commune")


def tous(w: Warehouse) -> DataFrame:
    """All checks with their status, from one pass over each table."""
    singular = [
        Q.rows_failing("prix_hors_bornes", "mart_prix_commune_annee", _prix_hors_bornes()),
        Q.values_failing("natures_inconnues", "stg_dvf_mutations", "nature_mutation", P.NATURES_MUTATION),
        Q.rows_failing("parts_hors_bornes", "mart_logement_commune", _parts_hors_bornes()),
    ]
    checks = [*_non_nuls(), *_population(), *_uniques(), *_valeurs(), *_relations(), *_combinaison(), *singular]
    return Q.with_status(_verify(w, checks))
