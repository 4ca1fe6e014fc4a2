"""Measures of the semantic model as functions of a fact, grouping keys and a filter context.

A blank is NULL: dividing by nothing is NULL, a share without matching rows is NULL rather than 0, and a
comparison exists only where the current value does.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import expressions as X
from terroir.operators.joins import join_groups, keep_members, lookup
from terroir.operators.percentiles import Pct, percentiles
from terroir.operators.periods import with_prior_year
from terroir.params import Contexte, Params
from terroir.plans.warehouse import PARTITION, TYPE, Warehouse

TOUT = Contexte()


@dataclass(frozen=True)
class Modele:
    """The star: two facts, the stock table and the two dimensions."""

    ventes: DataFrame
    dpe: DataFrame
    parc: DataFrame
    communes: DataFrame
    dates: DataFrame
    params: Params

    @staticmethod
    def of(w: Warehouse) -> "Modele":
        return Modele(
            ventes=w.stored("fct_ventes"),
            dpe=w.stored("fct_dpe_mensuel"),
            parc=w.table("mart_dpe_commune_etiquette"),
            communes=w.table("dim_commune"),
            dates=w.table("dim_date"),
            params=w.params,
        )


def dans_annees(day: str, annees: Sequence[int]) -> Column:
    """Day ranges instead of ``year(day)``, so that the filter reaches the Parquet statistics."""
    ranges = [F.col(day).between(F.lit(dt.date(a, 1, 1)), F.lit(dt.date(a, 12, 31))) for a in annees]
    return reduce(lambda a, b: a | b, ranges)


def type_commun(df: DataFrame, type_: str) -> Column:
    """The common dwelling type: stored with the facts, where it reaches the Parquet statistics; else computed."""
    return F.col(TYPE) if TYPE in df.columns else X.type_conforme(type_)


def _contexte(df: DataFrame, m: Modele, ctx: Contexte, day: str | None, type_: str) -> DataFrame:
    if ctx.annees is not None and day is not None:
        df = df.filter(dans_annees(day, ctx.annees))
        if PARTITION in df.columns:
            df = df.filter(F.col(PARTITION).isin(*ctx.annees))
    if ctx.types is not None:
        df = df.filter(type_commun(df, type_).isin(*[t.lower() for t in ctx.types]))
    if ctx.communes is not None:
        df = df.filter(F.col("code_commune").isin(*ctx.communes))
    if ctx.departements is not None:
        df = keep_members(df, m.communes.filter(X.in_scope("code_departement", ctx.departements)), "code_commune")
    return df


def ventes(m: Modele, ctx: Contexte = TOUT) -> DataFrame:
    """Sales in context with their calendar year and month."""
    return _contexte(m.ventes, m, ctx, "date_vente", "type_logement").select(
        "*", F.year("date_vente").alias("annee"), X.mois("date_vente").alias("mois")
    )


def flux(m: Modele, ctx: Contexte = TOUT) -> DataFrame:
    """Diagnostics carried out in context."""
    return _contexte(m.dpe, m, ctx, "mois", "type_logement").withColumn("annee", F.year("mois"))


def parc(m: Modele, ctx: Contexte = TOUT) -> DataFrame:
    """Diagnosed stock in context (it has no date)."""
    return _contexte(m.parc, m, ctx, None, "type_batiment")


def mesures_ventes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of sales, median price per m² and median price per group.

    A plausible sale always has a price, so the count comes out of the percentile step.
    """
    return percentiles(
        df,
        by,
        [Pct("prix_m2_median", "prix_m2"), Pct("prix_median", "prix")],
        counts={"nb_ventes": "prix_m2"},
    )


def nombre_ventes(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("nb_ventes"))


def mesures_flux(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Number of diagnostics, of F-G diagnostics and their share."""
    return (
        df.groupBy(*by)
        .agg(
            F.sum("nb_dpe").alias("nb_dpe"),
            F.sum(F.when(F.col("est_passoire_thermique"), F.col("nb_dpe"))).alias("nb_passoires"),
        )
        .withColumn("part_passoires", part("nb_passoires", "nb_dpe"))
    )


def part(num: str, den: str) -> Column:
    return F.try_divide(F.col(num).cast("double"), F.col(den).cast("double"))


def parts_parc(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Diagnosed dwellings with the F-G and A-B shares."""
    nb = F.col("nb_logements")
    out = df.groupBy(*by).agg(
        F.sum(nb).alias("nb_logements"),
        F.sum(F.when(X.est_passoire("etiquette_dpe"), nb)).alias("nb_fg"),
        F.sum(F.when(X.est_performant("etiquette_dpe"), nb)).alias("nb_ab"),
    )
    return out.select(
        *by,
        "nb_logements",
        part("nb_fg", "nb_logements").alias("part_passoires_parc"),
        part("nb_ab", "nb_logements").alias("part_logements_ab_parc"),
    )


def evolution(current: str, previous: str) -> Column:
    """(x - previous) / previous; NULL without a previous value."""
    x, p = F.col(current).cast("double"), F.col(previous).cast("double")
    return F.try_divide(x - p, p)


def comparaison_annuelle(df: DataFrame, values: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``<value>_n1`` and ``evol_<value>`` to yearly rows."""
    out = with_prior_year(df, "annee", keys, values)
    return out.select("*", *[evolution(v, f"{v}_n1").alias(f"evol_{v}") for v in values])


def glissant_12_mois(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sales and median price per m² over the 12 months ending in each month that has sales.

    Rows are counted once per month and price; no row is copied to the windows it belongs to.
    """
    keys = ["mois", *by]
    hist = df.groupBy(*keys, "prix_m2").agg(F.count(F.lit(1)).alias("n"))
    present = hist.groupBy(*keys).agg(F.sum("n").alias("nb_ventes"))
    windows = percentiles(
        hist,
        keys,
        [Pct("prix_m2_median_12m", "prix_m2")],
        weight="n",
        counts={"nb_ventes_12m": "prix_m2"},
        window=("mois", 12),
    )
    return join_groups(present, windows, keys)


def prix_deux_periodes(m: Modele, ctx: Contexte, by: Sequence[str], minimum: int) -> DataFrame:
    """Median price per m² and sales of the first and the recent years, and the change between them.

    The year slicer is overridden: both periods are conditional columns over all years.
    """
    debut, fin = m.params.annees_debut, m.params.annees_recentes
    wide = ctx.sur((*debut, *fin))
    df = ventes(m, wide).select(
        *by,
        F.when(F.col("annee").isin(*debut), F.col("prix_m2")).alias("m2_debut"),
        F.when(F.col("annee").isin(*fin), F.col("prix_m2")).alias("m2_fin"),
    )
    out = percentiles(
        df,
        by,
        [Pct("prix_m2_debut", "m2_debut"), Pct("prix_m2_fin", "m2_fin")],
        counts={"nb_debut": "m2_debut", "nb_fin": "m2_fin"},
    )
    enough_end = F.col("nb_fin") >= minimum
    enough = enough_end & (F.col("nb_debut") >= minimum)
    evol = evolution("prix_m2_fin", "prix_m2_debut")
    return out.select(
        "*",
        evol.alias("evol_prix_m2"),
        F.when(enough, evol).alias("evol_prix_m2_min"),
        F.when(enough_end, F.col("prix_m2_fin")).alias("prix_m2_min"),
        F.when(enough_end, F.col("nb_fin")).alias("nb_ventes_min"),
    )


def accessibilite(m: Modele, ctx: Contexte) -> DataFrame:
    """Per commune: sales, median price, standard of living and years needed to buy."""
    by_commune = mesures_ventes(ventes(m, ctx), ["code_commune"])
    return lookup(
        by_commune, m.communes, "code_commune", ["nom_commune", "nom_departement", "population", "niveau_vie_median"]
    ).withColumn("annees_pour_acheter", F.try_divide("prix_median", "niveau_vie_median"))


def communes_retenues(m: Modele, ctx: Contexte, minimum: int = P.MIN_VENTES_COMMUNE) -> DataFrame:
    """One row over the communes with enough sales: medians across communes, and those at 8 years or more.

    One row per commune enters the final medians, so the built-in ones are bounded here.
    """
    kept = accessibilite(m, ctx).filter(F.col("nb_ventes") >= minimum)
    out = kept.agg(
        F.nullif(F.count(F.lit(1)), F.lit(0)).alias("nb_communes_retenues"),
        F.median("annees_pour_acheter").alias("annees_commune_mediane"),
        F.median("niveau_vie_median").alias("niveau_vie_commune_mediane"),
        F.nullif(F.count_if(F.col("annees_pour_acheter") >= P.SEUIL_ACCES_ROUGE), F.lit(0)).alias("communes_8_ans"),
    )
    return out.withColumn("part_communes_8_ans", part("communes_8_ans", "nb_communes_retenues"))
