"""Edge cases of the business rules on small literal tables."""

import datetime as dt
from collections import Counter

from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import expressions as X
from terroir.operators import quality as Q
from terroir.operators.groups import most_frequent, single_value
from terroir.operators.history import apply_snapshot, open_history
from terroir.operators.joins import not_in
from terroir.operators.periods import trailing_months, with_prior_year
from terroir.operators.ranking import top_n_with_ties
from terroir.params import Contexte, Params
from terroir.plans import intermediate, marts, staging
from terroir.plans import measures as M
from terroir.plans import reports as R

DVF = (
    "id_mutation string, date_mutation date, annee int, nature_mutation string, valeur_fonciere double, code_postal string, "
    "code_commune string, nom_commune string, code_departement string, id_parcelle string, lot1_numero string, nombre_lots int, "
    "code_type_local string, type_local string, surface_reelle_bati double, nombre_pieces_principales int, surface_terrain double, "
    "longitude double, latitude double"
)


def line(id_, type_, surface, price=200000.0, lot="1", parcel="P1", nature="Vente", lon=2.0, lat=50.0, rooms=3):
    return (
        id_, dt.date(2024, 5, 1), 2024, nature, price, "59000", "59001", "Commune", "59", parcel, lot, 1, None, type_,
        surface, rooms, None, lon, lat,
    )


def sales(spark, *lines):
    return {r.id_mutation: r for r in intermediate.ventes_logement(spark.createDataFrame(list(lines), DVF)).collect()}


def test_only_sales_of_one_dwelling(spark):
    got = sales(
        spark,
        line("two", "Maison", 80.0, lot="1"), line("two", "Appartement", 50.0, lot="2"),
        line("business", "Maison", 80.0), line("business", P.TYPE_ACTIVITE, 200.0),
        line("garage", "Appartement", 60.0), line("garage", "Dépendance", None, lot="9"),
        line("parcels", "Maison", 90.0, parcel="P1"), line("parcels", "Maison", 90.0, parcel="P2"),
        line("land", None, None),
        line("other", "Maison", 80.0, nature="Echange"),
        line("same_but_rooms", "Maison", 80.0, rooms=3), line("same_but_rooms", "Maison", 80.0, rooms=None),
    )
    assert set(got) == {"garage", "parcels"}
    assert got["garage"].type_local == "Appartement"
    assert got["parcels"].prix_m2 == round(200000 / 90, 2)


def test_plausibility_is_three_valued(spark):
    got = sales(
        spark,
        line("no_price", "Maison", 20.0, price=None),
        line("no_price_small", "Maison", 5.0, price=None),
        line("zero", "Maison", 0.0),
        line("no_surface", "Maison", None),
        line("low", "Maison", 10.0, price=2000.0),
        line("high", "Maison", 10.0, price=300000.0),
        line("above", "Maison", 10.0, price=300001.0),
    )
    assert {k: v.est_prix_plausible for k, v in got.items()} == {
        "no_price": None, "no_price_small": False, "low": True, "high": True, "above": False,
    }


def test_unpriced_sales_leave_the_fact(spark):
    df = intermediate.ventes_logement(
        spark.createDataFrame([line("a", "Maison", 20.0, price=None), line("b", "Maison", 100.0)], DVF)
    )
    assert [r.id_mutation for r in marts.fct_ventes(df).collect()] == ["b"]


def test_coordinates_come_from_one_parcel(spark):
    got = sales(
        spark,
        line("a", "Maison", 80.0, lon=3.0, lat=49.0, parcel="P1"), line("a", "Maison", 80.0, lon=2.0, lat=51.0, parcel="P2"),
        line("b", "Maison", 80.0, lon=3.0, lat=None),
    )
    assert (got["a"].longitude, got["a"].latitude) == (2.0, 51.0)
    assert (got["b"].longitude, got["b"].latitude) == (3.0, None)


DPE = (
    "numero_dpe string, numero_dpe_remplace string, date_etablissement_dpe date, code_commune string, nom_commune string, "
    "code_departement string, identifiant_ban string, type_batiment string, periode_construction string, annee_construction int, "
    "surface_habitable double, etiquette_dpe string, etiquette_ges string, conso_energie_primaire_m2 double, emission_ges_m2 double"
)


def diag(num, day, ban="BAN1", surface=44.4, label="C", type_="maison", commune="59001", period="1948-1974"):
    return (num, None, day, commune, "Commune", "59", ban, type_, period, 1950, surface, label, label, 100.0, 10.0)


def test_latest_diagnostic_per_dwelling(spark):
    d1, d2 = dt.date(2022, 1, 1), dt.date(2023, 1, 1)
    rows = [
        diag("DPE1", d1), diag("DPE3", d2), diag("DPE2", d2),
        diag("DPE4", None, ban="BAN2"), diag("DPE5", d1, ban="BAN2"),
        diag("DPE6", d1, ban=None), diag("DPE7", d1, ban="BAN3", surface=None, label=None),
        diag("DPE8", d1, type_="immeuble", ban="BAN4"), diag("DPE9", d1, commune=None, ban="BAN5"),
    ]
    got = {r.cle_logement: r for r in intermediate.dpe_dernier(spark.createDataFrame(rows, DPE)).collect()}
    assert {k: v.numero_dpe for k, v in got.items()} == {
        "BAN1|maison|44.0": "DPE3",
        "BAN2|maison|44.0": "DPE5",
        "sans-adresse-DPE6|maison|44.0": "DPE6",
        "BAN3|maison|?": "DPE7",
    }
    assert got["BAN3|maison|?"].est_passoire_thermique is None


def test_masked_latest_value_wins(spark):
    raw = spark.createDataFrame(
        [
            ("59001", "C", "COM", "MED_SL", "x", "2022", 20000.0, None, "2026"),
            ("59001", "C", "COM", "MED_SL", "x", "2023", 21000.0, "C", "2026"),
            ("59001", "C", "COM", "POP", "x", "2022", 10.0, None, "2026"),
            ("59", "N", "DEP", "POP", "x", "2022", 10.0, None, "2026"),
        ],
        "GEO string, GEO_LABEL string, GEO_OBJECT string, TAB_MEASURE string, TAB_MEASURE_LABEL string, TIME_PERIOD string, "
        "OBS_VALUE double, CONF_STATUS string, GEO_REF string",
    )
    [r] = intermediate.insee_commune(staging.stg_insee(raw)).collect()
    assert (r.niveau_vie_median, r.niveau_vie_sous_secret, r.population) == (None, True, 10.0)


def test_casts_and_rounding(spark):
    df = spark.createDataFrame([("12.0", 0.285), ("2.7", 1.005), ("", 2.5), ("x", -0.004)], "t string, v double")
    got = df.select(X.to_int("t").alias("i"), X.rnd("v", 2).alias("r"), X.decimal_comma(F.lit("12,5")).alias("d")).collect()
    assert [r.i for r in got] == [12, 3, None, None]
    assert [r.r for r in got] == [0.28, 1.0, 2.5, 0.0]
    assert got[0].d == 12.5
    big = df.select(X.decimal_text(F.lit(12345678.4)).alias("s")).first().s
    assert big == "12345678.0"


def test_null_population_has_no_size_class(spark):
    df = spark.createDataFrame([(None,), (1999.0,), (2000.0,), (50000.0,)], "p double")
    assert [r[0] for r in df.select(X.taille_commune("p")).collect()] == [
        None, "1. Moins de 2 000 hab.", "2. 2 000 à 10 000 hab.", "4. Plus de 50 000 hab.",
    ]


def test_most_frequent_breaks_ties_by_label(spark):
    df = spark.createDataFrame([("a", "D"), ("a", "B"), ("a", None), ("a", None), ("a", None), ("b", None)], "k string, l string")
    assert [tuple(r) for r in most_frequent(df, ["k"], "l", "m").collect()] == [("a", "B")]


def test_single_value(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", None), ("c", None), ("d", 1.0), ("d", 2.0)], "k string, x double")
    assert {r.k: r.v for r in df.groupBy("k").agg(single_value("x").alias("v")).collect()} == {"a": 1.0, "b": None, "c": None, "d": None}


def test_top_n_keeps_ties_and_drops_blanks(spark):
    df = spark.createDataFrame([(i, float(10 - min(i, 9))) for i in range(12)] + [(99, None)], "id int, x double")
    got = top_n_with_ties(df, "x", 10).collect()
    assert len(got) == 12 and max(r.rang for r in got) == 10
    assert len(top_n_with_ties(df, "x", 3, ascending=True).collect()) == 3


def test_top_n_limits_rows_before_the_ranking_task(spark):
    df = spark.range(1000).selectExpr("id", "cast(id as double) as x")
    plan = top_n_with_ties(df, "x", 10)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_prior_year_needs_the_exact_year(spark):
    df = spark.createDataFrame([(2021, "a", 5), (2023, "a", 7), (2024, "a", 9), (2024, None, 3), (2023, None, 2)], "annee int, k string, n int")
    got = {(r.annee, r.k): r.n_n1 for r in with_prior_year(df, "annee", ["k"], ["n"]).collect()}
    assert got == {(2021, "a"): None, (2023, "a"): None, (2024, "a"): 7, (2024, None): 2, (2023, None): None}


def test_trailing_window_is_twelve_calendar_months(spark):
    df = spark.createDataFrame([(dt.date(2024, 2, 1), 1), (dt.date(2024, 3, 1), 10)], "mois date, n int")
    ends = trailing_months(df, "mois").groupBy("mois").agg(F.sum("n").alias("n"))
    got = {r.mois: r.n for r in ends.collect()}
    assert got[dt.date(2025, 1, 1)] == 11
    assert got[dt.date(2025, 2, 1)] == 10  # February 2024 has left the window
    assert len(got) == 13


def test_rolling_median_with_a_missing_month(spark):
    rows = [(dt.date(2024, 2, 29), 100.0), (dt.date(2024, 12, 1), 300.0), (dt.date(2025, 2, 10), 500.0)]
    df = spark.createDataFrame(rows, "date_vente date, prix_m2 double").withColumn("mois", X.mois("date_vente"))
    got = {r.mois: (r.nb_ventes, r.nb_ventes_12m, r.prix_m2_median_12m) for r in M.glissant_12_mois(df).collect()}
    assert got == {
        dt.date(2024, 2, 1): (1, 1, 100.0),
        dt.date(2024, 12, 1): (1, 2, 200.0),
        dt.date(2025, 2, 1): (1, 2, 400.0),
    }


def star(spark):
    communes = spark.createDataFrame(
        [("59001", "Un", "Un (59)", "59", "Nord", 20000.0, 1000.0, 50.0, 3.0)],
        "code_commune string, nom_commune string, nom_commune_dep string, code_departement string, nom_departement string, "
        "niveau_vie_median double, population double, latitude double, longitude double",
    )
    sold = spark.createDataFrame(
        [(f"m{i}", dt.date(2025, 1 + i % 12, 1), "59001", "Maison", 100.0, 3, 180000.0, 1800.0, None, None) for i in range(12)],
        "id_mutation string, date_vente date, code_commune string, type_logement string, surface_m2 double, nb_pieces int, "
        "prix double, prix_m2 double, latitude double, longitude double",
    )
    flow = spark.createDataFrame(
        [(dt.date(2025, 3, 1), "59001", "maison", "avant 1948", 1, "C", False, 4, 100.0)],
        "mois date, code_commune string, type_logement string, periode_construction string, periode_construction_tri int, "
        "etiquette_dpe string, est_passoire_thermique boolean, nb_dpe long, surface_totale_m2 double",
    )
    stock = spark.createDataFrame(
        [("k", "59001", "Un", "59", "maison", "avant 1948", 1, "C", 4)],
        "cle string, code_commune string, nom_commune string, code_departement string, type_batiment string, "
        "periode_construction string, periode_construction_tri int, etiquette_dpe string, nb_logements long",
    )
    params = Params(as_of=dt.date(2026, 1, 1))
    return M.Modele(sold, flow, stock, communes, marts.dim_date(spark, params), params)


def test_first_year_is_positive_and_without_comparison(spark):
    cards = {r.carte: r for r in R.cartes(star(spark), 2025).collect()}
    assert cards["ventes"].valeur == 12.0
    assert cards["ventes"].libelle is None and cards["ventes"].couleur == P.VERT
    assert cards["prix_m2"].texte == "1,800 €"
    assert cards["passoires"].valeur is None and cards["passoires"].texte is None


def test_year_without_data_still_has_its_cards(spark):
    cards = {r.carte: r for r in R.cartes(star(spark), 2022).collect()}
    assert len(cards) == 4 and cards["ventes"].valeur is None
    assert cards["ventes"].titre == "Ventes de logements · 2022"


def test_share_without_matching_rows_is_blank(spark):
    [r] = R.parts_du_parc(star(spark)).collect()
    assert (r.nb_logements, r.part_passoires_parc, r.part_logements_ab_parc) == (4, None, None)
    [f] = M.mesures_flux(M.flux(star(spark)), ["annee"]).collect()
    assert f.part_passoires is None


def test_minimum_sales_and_affordability(spark):
    m = star(spark)
    [r] = R.accessibilite_cles(m).collect()
    assert (r.nb_communes_retenues, r.annees_commune_mediane, r.communes_8_ans) == (1, 9.0, 1)
    assert R.communes_moins_accessibles(m).count() == 0
    assert R.communes_moins_accessibles(m, minimum=12).first().couleur == P.ROUGE
    [none] = R.accessibilite_cles(m, minimum=13).collect()
    assert (none.nb_communes_retenues, none.part_communes_8_ans) == (None, None)
    assert none.libelle_communes == " communes · 2024-2025"


def test_slicers(spark):
    m = star(spark)
    assert R.selection(m, Contexte((2025,), ("59",), ("MAISON",))).first().nb_ventes == 12
    assert R.selection(m, Contexte((2025,), ("02",))).count() == 0
    assert R.selection(m, Contexte(types=("appartement",))).count() == 0


def test_not_in_ignores_null_keys(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    members = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.k for r in not_in(df, members, "k").collect()] == ["b"]


def test_checks_find_failures(spark):
    df = spark.createDataFrame([("a", "A"), ("a", None), (None, "Z"), ("c", "Z")], "k string, l string")
    parent = spark.createDataFrame([("a",)], "p string")
    checks = [
        Q.not_null("t", "k"), Q.not_null("t", "l"), Q.unique("t", "k"), Q.accepted_values("t", "l", ["A"]),
        Q.relationship("t", "k", "parents", "p", Q.ALERTE), Q.unique_combination("t", ["l"]),
        Q.not_null("t", "l", F.col("k") == "c"), Q.unique_combination("t", ["k", "l"]),
        Q.rows_failing("lignes", "t", F.col("l") == "Z"), Q.values_failing("valeurs", "t", "l", ["A"]),
    ]
    rows = Q.with_status(Q.verify({"t": df, "parents": parent}.__getitem__, checks)).collect()
    assert Counter((r.controle, r.colonne, r.echecs, r.statut) for r in rows) == Counter([
        ("not_null", "k", 1, "error"), ("not_null", "l", 1, "error"), ("unique", "k", 1, "error"),
        ("accepted_values", "l", 1, "error"), ("relationships", "k", 1, "warn"), ("unique_combinaison", "l", 1, "error"),
        ("not_null", "l", 0, "ok"), ("unique_combinaison", "k,l", 0, "ok"), ("lignes", "", 2, "error"),
        ("valeurs", "", 1, "error"),
    ])


def test_checks_of_empty_tables_pass(spark):
    empty = spark.createDataFrame([], "k string, p string")
    checks = [Q.not_null("t", "k"), Q.unique("t", "k"), Q.relationship("t", "k", "t", "p")]
    assert [r.echecs for r in Q.verify(lambda _: empty, checks).collect()] == [0, 0, 0]


def test_repeated_parents_and_hot_children(spark):
    child = spark.range(1000).select(F.when(F.col("id") > 2, "hot").when(F.col("id") > 0, "lost").alias("k"))
    parent = spark.createDataFrame([("hot",), ("hot",), (None,)], "p string")
    checks = [Q.relationship("c", "k", "p", "p")]
    assert Q.verify({"c": child, "p": parent}.__getitem__, checks).first().echecs == 2


def test_history_versions(spark):
    day = lambda d: F.lit(d).cast("date")
    schema = "k string, v string"
    h0 = open_history(spark.createDataFrame([("a", "1"), ("b", "1"), ("c", None)], schema), day("2024-01-01"))
    h1 = apply_snapshot(h0, spark.createDataFrame([("a", "1"), ("b", "2"), ("d", "1")], schema), "k", ["v"], day("2024-02-01"))
    h2 = apply_snapshot(h1, spark.createDataFrame([("a", "3"), ("b", "2"), ("d", "1")], schema), "k", ["v"], day("2024-03-01"))
    got = sorted((r.k, r.v or "", str(r.valide_du), str(r.valide_au)) for r in h2.collect())
    assert got == [
        ("a", "1", "2024-01-01", "2024-03-01"), ("a", "3", "2024-03-01", "None"),
        ("b", "1", "2024-01-01", "2024-02-01"), ("b", "2", "2024-02-01", "None"),
        ("c", "", "2024-01-01", "2024-02-01"), ("d", "1", "2024-02-01", "None"),
    ]


def test_calendar_ends_with_the_reference_year(spark):
    d = marts.dim_date(spark, Params(as_of=dt.date(2025, 3, 3)))
    assert d.count() == 365 * 4 + 366
    r = d.filter("date = '2024-09-08'").first()
    assert (r.annee_semestre, r.annee_trimestre, r.nom_mois_court, r.nom_jour, r.est_weekend) == (
        "2024-S2", "2024-T3", "sept.", "dimanche", True,
    )
