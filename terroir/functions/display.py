"""Texts and colours of the report: projections over already aggregated rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions.expressions import _col, rnd


def _signed(c: Column) -> Column:
    """One signed decimal. A value that rounds to zero is written '+0.0'."""
    x = rnd(c, 1)
    return F.format_string("%+.1f", F.when(x == 0, F.lit(0.0)).otherwise(x))


def _arrow(e: Column) -> Column:
    return F.when(e >= 0, "▲ ").otherwise("▼ ")


def libelle_evolution(e: Column | str, annee: Column | str | None = None) -> Column:
    """'▲ +3.1 % vs 2024'; without ``annee`` the comparison year is left out. NULL stays NULL."""
    e = _col(e)
    parts = [_arrow(e), _signed(e * 100.0), F.lit(" %")]
    if annee is not None:
        parts += [F.lit(" vs "), (_col(annee) - 1).cast("string")]
    return F.when(e.isNotNull(), F.concat(*parts))


def libelle_ecart(e: Column | str, annee: Column | str) -> Column:
    """'▼ -0.4 pts vs 2024'."""
    e = _col(e)
    text = F.concat(_arrow(e), _signed(e * 100.0), F.lit(" pts vs "), (_col(annee) - 1).cast("string"))
    return F.when(e.isNotNull(), text)


def couleur_evolution(e: Column | str, inverse: bool = False) -> Column:
    """Green when the change is favourable; an unknown change counts as zero."""
    x = F.coalesce(_col(e), F.lit(0.0))
    return F.when((x <= 0) if inverse else (x >= 0), P.VERT).otherwise(P.ROUGE)


def couleur_accessibilite(annees: Column | str) -> Column:
    x = F.coalesce(_col(annees), F.lit(0.0))
    return (
        F.when(x >= P.SEUIL_ACCES_ROUGE, P.ROUGE)
        .when(x >= P.SEUIL_ACCES_ORANGE, P.ORANGE)
        .otherwise(P.VERT)
    )


def entier_groupe(c: Column | str) -> Column:
    """'12,345'."""
    return F.format_number(rnd(_col(c).cast("double")), 0)


def texte_carte(c: Column | str, suffixe: str = "") -> Column:
    return F.concat(entier_groupe(c), F.lit(suffixe))


def entier_espace(c: Column | str) -> Column:
    """'12 345'."""
    return F.replace(entier_groupe(c), F.lit(","), F.lit(" "))


def titre(prefixe: str, annee: Column | str | None) -> Column:
    """Card title followed by the single selected year, or the whole period."""
    selected = F.lit(None).cast("string") if annee is None else _col(annee).cast("string")
    return F.concat(F.lit(f"{prefixe} · "), F.coalesce(selected, F.lit(P.LIBELLE_PERIODE_COMPLETE)))


def sous_titre_ventes(nb: Column | str, annee: Column | str | None) -> Column:
    base = F.concat(F.coalesce(entier_espace(nb), F.lit("")), F.lit(" ventes"))
    if annee is None:
        return base
    suffix = F.concat(F.lit(P.SOUS_TITRE_MOIS), (_col(annee) - 1).cast("string"))
    return F.concat(base, F.coalesce(suffix, F.lit("")))


def pourcentage_entier(c: Column | str, suffixe: str = "") -> Column:
    """'25 %' followed by ``suffixe``; NULL is written as an empty number."""
    text = F.concat(F.format_number(rnd(_col(c) * 100.0), 0), F.lit(" %"))
    return F.concat(F.coalesce(text, F.lit("")), F.lit(suffixe))


def classe_evolution(e: Column | str) -> Column:
    """'hausse' from 5 %, 'stable' from 0 to 5 %, 'baisse' below."""
    e = _col(e)
    return (
        F.when((e >= 0.05) & (e <= 100), "hausse")
        .when((e >= 0) & (e < 0.05), "stable")
        .when((e >= -1) & (e < 0), "baisse")
    )
