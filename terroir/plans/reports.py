"""Report queries: filter, aggregate, then join dimensions to the small result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import display as D
from terroir.functions import expressions as X
from terroir.operators.joins import join_groups, lookup
from terroir.operators.groups import single_value
from terroir.operators.percentiles import Pct, percentiles
from terroir.operators.periods import share_of_group, with_prior_year, year_to_date
from terroir.operators.ranking import top_n_with_ties
from terroir.params import Contexte
from terroir.plans import measures as M
from terroir.plans.measures import Modele


def _deux_ans(annee: int, ctx: Contexte) -> Contexte:
    return ctx.sur((annee - 1, annee))


def _mesures_des_cartes(m: Modele, annee: int, ctx: Contexte) -> DataFrame:
    """One row: the year's measures, each with its change against the year before."""
    two = _deux_ans(annee, ctx)
    v = M.comparaison_annuelle(
        M.mesures_ventes(M.ventes(m, two), ["annee"]), ["prix_m2_median", "nb_ventes", "prix_median"]
    )
    d = with_prior_year(M.mesures_flux(M.flux(m, two), ["annee"]), "annee", [], ["part_passoires"]).withColumn(
        "ecart", F.col("part_passoires") - F.col("part_passoires_n1")
    )
    year = m.dates.filter(F.col("annee") == annee).select("annee").distinct()
    return join_groups(join_groups(year, v, ["annee"]), d, ["annee"])


def _mesures_sans_annee(m: Modele, ctx: Contexte) -> DataFrame:
    """One row: the measures over all years in context; without a single year there is nothing to compare with."""
    row = join_groups(M.mesures_flux(M.flux(m, ctx), []), M.mesures_ventes(M.ventes(m, ctx), []), [])
    blank = ("evol_prix_m2_median", "evol_nb_ventes", "evol_prix_median", "ecart")
    return row.select("*", F.lit(None).cast("int").alias("annee"), *[F.lit(None).cast("double").alias(c) for c in blank])


def cartes(m: Modele, annee: int | None, ctx: Contexte = Contexte()) -> DataFrame:
    """Q1: the four cards, each with value, text, comparison, colour and title.

    Of one year, or with ``None`` of all years in context: then comparisons are blank and titles name the period.
    """
    row = _mesures_sans_annee(m, ctx) if annee is None else _mesures_des_cartes(m, annee, ctx)

    def card(name: str, value: str, text, e: str, title: str):
        return F.struct(
            F.lit(name).alias("carte"),
            F.col(value).cast("double").alias("valeur"),
            text.alias("texte"),
            D.libelle_evolution(e, "annee").alias("libelle"),
            D.couleur_evolution(e).alias("couleur"),
            D.titre(title, "annee").alias("titre"),
        )

    share = F.struct(
        F.lit("passoires").alias("carte"),
        F.col("part_passoires").alias("valeur"),
        F.format_string("%.1f %%", X.rnd(F.col("part_passoires") * 100.0, 1)).alias("texte"),
        D.libelle_ecart("ecart", "annee").alias("libelle"),
        D.couleur_evolution("ecart", inverse=True).alias("couleur"),
        D.titre(P.TITRE_PASSOIRES, "annee").alias("titre"),
    )
    share = share.withField("texte", F.when(F.col("part_passoires").isNotNull(), share["texte"]))
    return row.select(
        "annee",
        F.inline(
            F.array(
                card("prix_m2", "prix_m2_median", D.texte_carte("prix_m2_median", " €"), "evol_prix_m2_median", P.TITRE_PRIX_M2),
                card("ventes", "nb_ventes", D.texte_carte("nb_ventes"), "evol_nb_ventes", P.TITRE_VENTES),
                card("prix_median", "prix_median", D.texte_carte("prix_median", " €"), "evol_prix_median", P.TITRE_PRIX),
                share,
            )
        ),
    )


def carte_communes(m: Modele, ctx: Contexte = Contexte(), minimum: int = P.MIN_VENTES_CARTE) -> DataFrame:
    """Q2: recent years only, whatever the year slicer; the filter applies after the aggregate."""
    recent = ctx.sur(m.params.annees_recentes)
    by_commune = M.mesures_ventes(M.ventes(m, recent), ["code_commune"]).filter(F.col("nb_ventes") >= minimum)
    low, high = P.BORNES_CARTE
    return lookup(
        by_commune, m.communes, "code_commune", ["nom_commune_dep", "latitude", "longitude", "population"]
    ).select(
        "code_commune",
        "nom_commune_dep",
        "latitude",
        "longitude",
        "nb_ventes",
        "prix_m2_median",
        "prix_median",
        "population",
        F.greatest(F.lit(low), F.least(F.lit(high), F.col("prix_m2_median"))).alias("prix_m2_couleur"),
    )


def ventes_par_mois(m: Modele, annee: int, ctx: Contexte = Contexte()) -> DataFrame:
    """Q3: sales per month of one year against the same month a year earlier."""
    per_month = (
        M.nombre_ventes(M.ventes(m, _deux_ans(annee, ctx)), ["mois"])
        .select(F.year("mois").alias("annee"), F.month("mois").alias("mois"), "nb_ventes")
    )
    out = with_prior_year(per_month, "annee", ["mois"], ["nb_ventes"]).filter(F.col("annee") == annee)
    return out.select(
        "annee", "mois", X.nieme(P.MOIS_COURTS, F.col("mois")).alias("nom_mois_court"), "nb_ventes", "nb_ventes_n1"
    ).orderBy("mois")


def prix_glissant(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Q4: trailing 12-month median price per m² by month and type."""
    return (
        M.glissant_12_mois(M.ventes(m, ctx), ["type_logement"])
        .select(F.col("mois").alias("premier_jour_mois"), "type_logement", "nb_ventes", "nb_ventes_12m", "prix_m2_median_12m")
        .orderBy("premier_jour_mois", "type_logement")
    )


def ventes_par_annee(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Q5: sales per year with the change on the year before."""
    out = M.comparaison_annuelle(M.nombre_ventes(M.ventes(m, ctx), ["annee"]), ["nb_ventes"])
    return out.select(
        "annee",
        "nb_ventes",
        "nb_ventes_n1",
        F.col("evol_nb_ventes").alias("evolution"),
        D.libelle_evolution("evol_nb_ventes").alias("libelle"),
        D.couleur_evolution("evol_nb_ventes").alias("couleur"),
    ).orderBy("annee")


CLASSEMENTS = {
    "prix": ("prix_m2_min", False),
    "hausse": ("evol_prix_m2_min", False),
    "baisse": ("evol_prix_m2_min", True),
    "ventes": ("nb_ventes_min", False),
}


def classement_communes(
    m: Modele, critere: str, ctx: Contexte = Contexte(), minimum: int = P.MIN_VENTES_CLASSEMENT, n: int = 10
) -> DataFrame:
    """Q6 and its bookmarks: the n first communes by price, rise, fall or number of sales."""
    measure, ascending = CLASSEMENTS[critere]
    by_commune = M.prix_deux_periodes(m, ctx, ["code_commune"], minimum)
    top = top_n_with_ties(by_commune, measure, n, ascending)
    return (
        lookup(top, m.communes, "code_commune", ["nom_commune", "population"])
        .select(
            "rang",
            "code_commune",
            "nom_commune",
            F.col("prix_m2_fin").alias("prix_m2_median"),
            F.col("nb_fin").alias("nb_ventes"),
            F.col("evol_prix_m2").alias("evolution"),
            D.classe_evolution("evol_prix_m2").alias("classe_evolution"),
            "population",
        )
        .orderBy("rang", "code_commune")
    )


def _recent(m: Modele, ctx: Contexte) -> Contexte:
    return ctx.sur(m.params.annees_recentes)


def accessibilite_cles(m: Modele, ctx: Contexte = Contexte(), minimum: int = P.MIN_VENTES_COMMUNE) -> DataFrame:
    """Q7: medians across communes, communes at 8 years or more, with their texts."""
    out = M.communes_retenues(m, _recent(m, ctx), minimum)
    return out.select(
        "*",
        D.texte_carte("niveau_vie_commune_mediane", " €/an").alias("niveau_vie_carte"),
        F.concat(F.coalesce(D.entier_espace("nb_communes_retenues"), F.lit("")), F.lit(f" communes · {m.params.periode_dvf}")).alias("libelle_communes"),
        D.pourcentage_entier("part_communes_8_ans", " des communes").alias("libelle_part"),
        F.lit(P.SOURCE_INSEE).alias("libelle_source"),
    )


def nuage_accessibilite(m: Modele, ctx: Contexte = Contexte(), minimum: int = P.MIN_VENTES_COMMUNE) -> DataFrame:
    """Q8: one bubble per commune with enough sales."""
    return (
        M.accessibilite(m, _recent(m, ctx))
        .filter(F.col("nb_ventes") >= minimum)
        .select(
            "code_commune", "nom_commune", "niveau_vie_median", "prix_median", "nb_ventes", "population",
            "annees_pour_acheter", D.couleur_accessibilite("annees_pour_acheter").alias("couleur"),
        )
    )


def communes_moins_accessibles(
    m: Modele, ctx: Contexte = Contexte(), minimum: int = P.MIN_VENTES_CLASSEMENT, n: int = 10
) -> DataFrame:
    """Q9: the n communes needing the most years, ties included."""
    eligible = M.accessibilite(m, _recent(m, ctx)).filter(F.col("nb_ventes") >= minimum)
    return (
        top_n_with_ties(eligible, "annees_pour_acheter", n)
        .select(
            "rang", "code_commune", "nom_commune", "nom_departement", "annees_pour_acheter", "prix_median",
            D.couleur_accessibilite("annees_pour_acheter").alias("couleur"),
        )
        .orderBy("rang", "code_commune")
    )


def etiquettes_par_periode(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Q10: label shares of the stock by construction period, periods in chronological order."""
    counted = (
        M.parc(m, ctx)
        .groupBy("periode_construction", "periode_construction_tri", "etiquette_dpe")
        .agg(F.sum("nb_logements").alias("nb_logements"))
    )
    return share_of_group(counted, ["periode_construction"], "nb_logements", "part").orderBy(
        "periode_construction_tri", "etiquette_dpe"
    )


def parts_du_parc(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Q11: F-G and A-B shares of the stock."""
    return M.parts_parc(M.parc(m, ctx), [])


def diagnostics_annee(m: Modele, annee: int, ctx: Contexte = Contexte()) -> DataFrame:
    """Q12: diagnostics of one year with the change on the year before."""
    counted = M.mesures_flux(M.flux(m, _deux_ans(annee, ctx)), ["annee"])
    out = M.comparaison_annuelle(counted.select("annee", "nb_dpe"), ["nb_dpe"]).filter(F.col("annee") == annee)
    return out.select(
        "annee",
        "nb_dpe",
        "nb_dpe_n1",
        F.col("evol_nb_dpe").alias("evolution"),
        D.texte_carte("nb_dpe").alias("texte"),
        D.libelle_evolution("evol_nb_dpe", "annee").alias("libelle"),
    )


def passoires_par_mois(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Q13: monthly share of F-G diagnostics, for months with diagnostics."""
    return (
        M.mesures_flux(M.flux(m, ctx), ["mois"])
        .withColumnRenamed("mois", "premier_jour_mois")
        .orderBy("premier_jour_mois")
    )


def selection(m: Modele, ctx: Contexte) -> DataFrame:
    """Q14: base measures under any combination of year, department and type slicers."""
    return M.mesures_ventes(M.ventes(m, ctx), ["annee"]).orderBy("annee")


def listes(m: Modele) -> DataFrame:
    """Q14: the members that the slicers offer: years with a complete calendar year, departments, dwelling types."""
    complete = m.dates.groupBy("annee").agg(F.max("date").alias("fin")).filter("month(fin) = 12 and day(fin) = 31")

    def members(df: DataFrame, slicer: str, value) -> DataFrame:
        return df.select(F.lit(slicer).alias("segment"), value.cast("string").alias("valeur")).distinct()

    types = m.ventes.select(M.type_commun(m.ventes, "type_logement").alias("t")).unionByName(
        m.dpe.select(M.type_commun(m.dpe, "type_logement").alias("t"))
    )
    return (
        members(complete, "annee", F.col("annee"))
        .unionByName(members(m.communes, "departement", F.col("nom_departement")))
        .unionByName(members(types.filter("t is not null"), "type", F.col("t")))
    )


def niveaux(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Every slicer position of the department and commune levels at once.

    Levels come from one price histogram of the communes: its slices' sums add up to those of the departments and of
    all, and only the counts around the medians are read for each level.
    """
    hist = M.ventes(m, ctx).groupBy("code_commune", "prix_m2").agg(F.count(F.lit(1)).alias("n"))
    placed = lookup(hist, m.communes, "code_commune", ["code_departement"]).select(
        F.col("code_departement").alias("departement"), F.col("code_commune").alias("commune"), "prix_m2", "n"
    )
    return percentiles(
        placed,
        ["departement", "commune"],
        [Pct("prix_m2_median", "prix_m2")],
        weight="n",
        counts={"nb_ventes": "prix_m2"},
        levels=("niveau", {"total": [], "departement": ["departement"], "commune": ["departement", "commune"]}),
    )


def cumul_annuel(m: Modele, ctx: Contexte = Contexte()) -> DataFrame:
    """Sales since 1 January, per month, and over the trailing 12 months."""
    per_month = M.glissant_12_mois(M.ventes(m, ctx)).select(
        F.year("mois").alias("annee"), F.month("mois").alias("mois"), "nb_ventes", "nb_ventes_12m"
    )
    return year_to_date(per_month, "annee", "mois", "nb_ventes", "nb_ventes_cumul")


def niveau_vie_par(m: Modele, by: str) -> DataFrame:
    """Standard of living where the group holds a single value, by any commune attribute."""
    return m.communes.groupBy(by).agg(
        F.count(F.lit(1)).alias("nb_communes"), single_value("niveau_vie_median").alias("niveau_vie_median")
    )


def libelles_ventes(m: Modele, annees: Sequence[int], ctx: Contexte = Contexte()) -> DataFrame:
    """Title and subtitle of the monthly chart: per single year, and over all of them."""
    v = M.nombre_ventes(M.ventes(m, ctx.sur(tuple(annees))), ["annee"])
    total = v.agg(F.lit(None).cast("int").alias("annee"), F.sum("nb_ventes").alias("nb_ventes"))
    return v.unionByName(total).select(
        "annee",
        D.titre(P.TITRE_MOIS, "annee").alias("titre"),
        D.sous_titre_ventes("nb_ventes", "annee").alias("sous_titre"),
    )
