"""Texts and colours."""

from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import display as D


def values(spark, schema, data, *cols):
    return [tuple(r) for r in spark.createDataFrame(data, schema).select(*cols).collect()]


def test_change_labels(spark):
    got = values(
        spark, "e double, a int", [(0.0314, 2025), (-0.0004, 2025), (-0.25, 2025), (0.0, 2025), (None, 2025)],
        D.libelle_evolution("e", "a"), D.libelle_evolution("e"), D.couleur_evolution("e"), D.couleur_evolution("e", True),
    )
    assert got == [
        ("▲ +3.1 % vs 2024", "▲ +3.1 %", P.VERT, P.ROUGE),
        ("▼ +0.0 % vs 2024", "▼ +0.0 %", P.ROUGE, P.VERT),
        ("▼ -25.0 % vs 2024", "▼ -25.0 %", P.ROUGE, P.VERT),
        ("▲ +0.0 % vs 2024", "▲ +0.0 %", P.VERT, P.VERT),
        (None, None, P.VERT, P.VERT),
    ]


def test_points_label(spark):
    assert values(spark, "e double, a int", [(-0.0125, 2024)], D.libelle_ecart("e", "a")) == [("▼ -1.3 pts vs 2023",)]


def test_numbers(spark):
    got = values(spark, "x double", [(1234567.5,), (0.4,), (None,)], D.texte_carte("x", " €"), D.entier_espace("x"))
    assert got == [("1,234,568 €", "1 234 568"), ("0 €", "0"), (None, None)]


def test_affordability_colours(spark):
    got = values(spark, "x double", [(8.0,), (7.9,), (6.0,), (5.9,), (None,)], D.couleur_accessibilite("x"))
    assert [c for (c,) in got] == [P.ROUGE, P.ORANGE, P.ORANGE, P.VERT, P.VERT]


def test_titles(spark):
    got = values(
        spark, "a int, n long", [(2025, 12345), (None, 7), (None, None)],
        D.titre("Ventes", "a"), D.sous_titre_ventes("n", "a"), D.pourcentage_entier(F.col("n") / 100, " des communes"),
    )
    assert got[0][:2] == ("Ventes · 2025", "12 345 ventes · le trait bleu foncé indique le même mois en 2024")
    assert got[1] == ("Ventes · 2021-2025", "7 ventes", "7 % des communes")
    assert got[2][1:] == (" ventes", " des communes")


def test_change_classes(spark):
    got = values(spark, "e double", [(0.05,), (0.049,), (0.0,), (-0.01,), (None,)], D.classe_evolution("e"))
    assert [c for (c,) in got] == ["hausse", "stable", "stable", "baisse", None]
