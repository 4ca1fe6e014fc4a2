"""Column expressions: casts, rounding, guarded ratios, flags and buckets.

Everything here is a JVM-side expression, so it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from terroir import params as P


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rnd(c: Column | str, digits: int = 0) -> Column:
    """Round by scaling the binary value.

    ``round(x, n)`` rounds the decimal text of the double, which differs from scale-round-unscale
    arithmetic on values such as 1.005.
    """
    scale = 10.0**digits
    return F.round(_col(c)) if digits == 0 else F.round(_col(c) * scale) / F.lit(scale)


def to_double(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Text to integer; ``'12.0'`` is 12 and ``'2.7'`` is 3, anything unreadable is NULL."""
    return F.round(_col(c).try_cast("double")).try_cast("int")


def decimal_comma(c: Column | str) -> Column:
    return F.replace(_col(c), F.lit(","), F.lit(".")).try_cast("double")


def ratio(num: Column | str, den: Column | str, digits: int | None = None) -> Column:
    """``num / den``, NULL on a zero denominator, optionally rounded."""
    q = F.try_divide(_col(num), _col(den))
    return q if digits is None else rnd(q, digits)


def decimal_text(c: Column | str) -> Column:
    """Text of a rounded double with one decimal, never in scientific notation."""
    x = F.round(_col(c))
    return F.coalesce(x.try_cast("decimal(25,1)").cast("string"), x.cast("string"))


def in_scope(c: Column | str, departements: Sequence[str]) -> Column:
    return _col(c).isin(*departements)


def masked_value(value: Column | str, status: Column | str) -> Column:
    """NULL where the status is 'C' (statistical secrecy); a NULL status keeps the value."""
    return F.when(~_col(status).eqNullSafe(F.lit("C")), _col(value))


def is_masked(status: Column | str) -> Column:
    return F.coalesce(_col(status) == "C", F.lit(False))


def prix_m2(prix: Column | str, surface: Column | str) -> Column:
    return ratio(prix, surface, 2)


def prix_plausible(prix: Column | str, surface: Column | str) -> Column:
    """Three-valued: NULL price with a sufficient surface stays NULL."""
    return (
        (_col(surface) >= P.SURFACE_MIN)
        & (_col(prix) >= P.PRIX_MIN)
        & F.try_divide(_col(prix), _col(surface)).between(P.PRIX_M2_MIN, P.PRIX_M2_MAX)
    )


def est_passoire(etiquette: Column | str) -> Column:
    return _col(etiquette).isin(*P.ETIQUETTES_PASSOIRE)


def est_performant(etiquette: Column | str) -> Column:
    return _col(etiquette).isin(*P.ETIQUETTES_PERFORMANT)


def periode_connue(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(P.PERIODE_INCONNUE))


def periode_tri(c: Column | str) -> Column:
    """Chronological rank of a construction period, 99 for anything else."""
    position = F.array_position(F.array(*[F.lit(p) for p in P.PERIODES_CONSTRUCTION]), _col(c))
    return F.when(position > 0, position.cast("int")).otherwise(P.RANG_PERIODE_INCONNUE)


def taille_commune(population: Column | str) -> Column:
    pop = _col(population)
    expr = F.when(pop.isNull(), F.lit(None).cast("string"))
    for limit, label in P.TAILLES_COMMUNE:
        expr = expr.when(pop < limit, label)
    return expr.otherwise(P.TAILLE_MAX)


def cle(*parts: Column | str, sep: str = "-") -> Column:
    """Concatenated key; any NULL part makes the key NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit(sep))
        pieces.append(_col(part).cast("string"))
    return F.concat(*pieces)


def cle_logement(ban: Column | str, numero: Column | str, type_: Column | str, surface: Column | str) -> Column:
    """Dwelling key: address (or the diagnostic's own number), type, rounded surface."""
    adresse = F.coalesce(_col(ban), F.concat(F.lit("sans-adresse-"), _col(numero)))
    return cle(adresse, type_, F.coalesce(decimal_text(surface), F.lit("?")), sep="|")


def type_conforme(c: Column | str) -> Column:
    """One spelling of the dwelling type for sales and diagnostics alike."""
    return F.lower(_col(c))


def rounded_int(c: Column | str) -> Column:
    return F.round(_col(c)).cast("int")


def mois(c: Column | str) -> Column:
    """First day of the month."""
    return F.trunc(_col(c), "month")


def nieme(labels: Sequence[str], position: Column) -> Column:
    """1-based pick from a fixed list of labels."""
    return F.element_at(F.array(*[F.lit(x) for x in labels]), position.cast("int"))
