"""Registered queries: every model, report query, check, source, sink and incremental variant."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terroir import params as P
from terroir.functions import expressions as X
from terroir.operators.groups import most_frequent
from terroir.operators.joins import keep_members, lookup, not_in
from terroir.operators.percentiles import Pct, percentiles
from terroir.operators.periods import with_prior_year
from terroir.params import Contexte
from terroir.operators.history import apply_snapshot, open_history
from terroir.plans import controls, intermediate
from terroir.plans import measures as M
from terroir.plans import reports as R
from terroir.plans.measures import Modele
from terroir.plans.warehouse import EXPORTS, MODELES, Warehouse, warehouse
from terroir.sinks import publish as K
from terroir.sources import landing as L
from terroir.sources.adapters import Faulty
from terroir.streaming import incremental as S

Query = Callable[[SparkSession, str], DataFrame]

def _model(name: str) -> Query:
    return lambda spark, sf: warehouse(spark, sf).plan(name).drop("_loaded_at")


def _report(f: Callable[[Modele], DataFrame]) -> Query:
    return lambda spark, sf: f(Modele.of(warehouse(spark, sf)))


def _tables(f: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, sf: f(warehouse(spark, sf))


def _faulty(f: Callable[[Faulty], DataFrame]) -> Query:
    """A check over tables with faults in them."""
    return lambda spark, sf: f(Faulty(warehouse(spark, sf)))


def _type_conforme(m: Modele) -> DataFrame:
    """Sales, flow and stock under one spelling of the dwelling type."""
    v = m.ventes.groupBy(X.type_conforme("type_logement").alias("type_logement")).agg(F.count(F.lit(1)).alias("nb_ventes"))
    d = m.dpe.groupBy(X.type_conforme("type_logement").alias("type_logement")).agg(F.sum("nb_dpe").alias("nb_dpe"))
    p = m.parc.groupBy(X.type_conforme("type_batiment").alias("type_logement")).agg(F.sum("nb_logements").alias("nb_logements"))
    return v.join(d, "type_logement", "full").join(p, "type_logement", "full")


def _etoile(m: Modele) -> DataFrame:
    """Sales by attributes of both dimensions; prices are summed as decimals, independent of order."""
    fact = m.ventes.withColumnRenamed("date_vente", "date").groupBy("date", "code_commune").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("prix").cast("decimal(18,2)")).alias("p")
    )
    wide = lookup(lookup(fact, m.dates, "date", ["annee_trimestre"]), m.communes, "code_commune", ["taille_commune"])
    return wide.groupBy("annee_trimestre", "taille_commune").agg(
        F.sum("n").alias("nb_ventes"), F.sum("p").cast("double").alias("prix_total")
    )


def _population_couverte(m: Modele) -> DataFrame:
    """Column aggregates on the dimension itself, restricted to communes with sales."""
    return (
        keep_members(m.communes, m.ventes.select("code_commune").distinct(), "code_commune")
        .groupBy("nom_departement")
        .agg(
            F.sum("population").alias("population"),
            F.min("nom_commune").alias("premiere_commune"),
            F.count(F.lit(1)).alias("nb_communes"),
        )
    )


def _calendrier(m: Modele) -> DataFrame:
    """The calendar with the sales of each day and, on the first of a month, its diagnostics."""
    v = m.ventes.groupBy(F.col("date_vente").alias("date")).agg(F.count(F.lit(1)).alias("nb_ventes"))
    d = m.dpe.groupBy(F.col("mois").alias("date")).agg(F.sum("nb_dpe").alias("nb_dpe"))
    return m.dates.join(v, "date", "left").join(d, "date", "left")


def _annee_precedente(m: Modele) -> DataFrame:
    counted = M.nombre_ventes(M.ventes(m), ["annee", "code_commune"])
    return with_prior_year(counted, "annee", ["code_commune"], ["nb_ventes"])


def _quartiles_surface(w: Warehouse) -> DataFrame:
    return percentiles(
        w.table("stg_dpe_logements"),
        ["type_batiment"],
        [
            Pct("q1", "surface_habitable", 0.25),
            Pct("mediane", "surface_habitable"),
            Pct("q3", "surface_habitable", 0.75),
        ],
        counts={"nb": "surface_habitable"},
    )


def _hors_referentiel(w: Warehouse) -> DataFrame:
    counted = w.plan("stg_dvf_mutations").groupBy("code_commune").agg(F.count(F.lit(1)).alias("nb_lignes"))
    return not_in(counted, w.table("int_insee_commune"), "code_commune")


def _etiquette_frequente(w: Warehouse) -> DataFrame:
    return most_frequent(
        w.table("int_dpe_logement_dernier"), ["type_batiment", "periode_construction"], "etiquette_dpe", "etiquette_dpe"
    )


def _counts(spark: SparkSession, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame(list(counts.items()), "nom_table string, nb_lignes long")


def _source(name: str) -> Callable[[Warehouse], DataFrame]:
    def run(w: Warehouse) -> DataFrame:
        return L.READERS[name](w.spark, w.files(name)).drop("filename", "_loaded_at")

    return run


def _chargement(w: Warehouse) -> DataFrame:
    """Full refresh of the raw layer from files, with the rows written per table."""
    return _counts(w.spark, L.land(L.read_raw(w.spark, w.files()), w.scratch("raw")))


def _publication(w: Warehouse) -> DataFrame:
    """Publish the exported tables twice (the second switch replaces the first) and count what readers see."""
    root = w.scratch("publication")
    tables = {t: w.table(t) for t in EXPORTS}
    K.publish(tables, root, only=EXPORTS[:2])
    K.publish(tables, root)
    return _counts(w.spark, {t: K.read_published(w.spark, root, t).count() for t in EXPORTS})


def _published(name: str) -> Callable[[Warehouse], DataFrame]:
    """The rows of a table as readers see them after a second publication."""

    def run(w: Warehouse) -> DataFrame:
        root = w.scratch("publication")
        K.publish({name: w.table(name).limit(0)}, root)
        K.publish({name: w.table(name)}, root)
        return K.read_published(w.spark, root, name)

    return run


def _landed(name: str) -> Callable[[Warehouse], DataFrame]:
    """The rows of a raw table as written by a second full refresh; a reader of the first keeps its version."""

    def run(w: Warehouse) -> DataFrame:
        out, raw = w.scratch("raw"), L.read_raw(w.spark, w.files(name))
        L.land({name: raw[name].limit(0)}, out)
        L.land({name: raw[name]}, out)
        return L.read_landed(w.spark, out, name).drop("filename", "_loaded_at")

    return run


def _stream(w: Warehouse, files_per_batch: int = 1000) -> tuple[DataFrame, str, str]:
    base = w.scratch("flux")
    stream = S.landing_stream(w.spark, f"{w.files('dpe_logements')}/{L.MOTIF_DPE}", files_per_batch)
    return stream, f"{base}/out", f"{base}/checkpoint"


def _ingestion(w: Warehouse) -> DataFrame:
    """Landed files appended once; the second run finds nothing new."""
    stream, out, checkpoint = _stream(w)
    S.append_once(stream, out, checkpoint)
    S.append_once(stream, out, checkpoint)
    return w.spark.read.parquet(out).drop("_loaded_at")


def _dedoublonnage(w: Warehouse) -> DataFrame:
    stream, out, checkpoint = _stream(w, 4)
    S.append_unseen(stream, out, checkpoint)
    return S.lots(w.spark, out).drop("_loaded_at")


def _flux_mensuel(w: Warehouse) -> DataFrame:
    stream, out, checkpoint = _stream(w)
    S.append_unseen(stream, out, checkpoint, {"mois": S.monthly_partial(w.params)})
    return S.monthly_counts(w.spark, out)


def _flux_compacte(w: Warehouse) -> DataFrame:
    """The flow from lots of few files, merged afterwards."""
    stream, out, checkpoint = _stream(w, 4)
    S.append_unseen(stream, out, checkpoint, {"mois": S.monthly_partial(w.params)})
    S.compact(w.spark, out, "mois", S.monthly_sums)
    return S.monthly_counts(w.spark, out)


def _flux_journalier(w: Warehouse) -> DataFrame:
    """Days from two landings: windows closed behind the watermark, late rows from the side table, open days."""
    stream, out, checkpoint = _stream(w, 4)
    S.append_unseen(stream, out, checkpoint)
    S.close_days(w.spark, out, f"{checkpoint}-jours")
    return S.daily_counts(w.spark, out)


def _dernier_courant(w: Warehouse) -> DataFrame:
    stream, out, checkpoint = _stream(w, 4)
    S.merge_latest(stream, out, checkpoint)
    return S.current_rows(w.spark, out)


SUIVIES = ("numero_dpe", "etiquette_dpe", "surface_habitable")


def _historique(w: Warehouse) -> DataFrame:
    """History of the dwellings' diagnostics: as known on 1 January 2024, then as known now."""
    dpe = w.table("stg_dpe_logements")
    opened, now = F.lit("2024-01-01").cast("date"), F.lit(w.params.as_of).cast("date")
    known = intermediate.dpe_dernier(dpe.filter(F.col("date_etablissement_dpe") < opened))
    history = open_history(known.select("cle_logement", *SUIVIES), opened)
    current = w.table("int_dpe_logement_dernier")
    return apply_snapshot(history, current, "cle_logement", SUIVIES, now)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {name: _model(name) for name in MODELES}
    q |= {
        "dim_date": _report(_calendrier),
        "calendrier_activite": _report(_calendrier),
        "q01_cartes": _report(lambda m: R.cartes(m, 2025)),
        "q01_cartes_departement": _report(lambda m: R.cartes(m, 2024, Contexte(departements=("59",), types=("maison",)))),
        "q01_cartes_periode": _report(lambda m: R.cartes(m, None)),
        "q01_cartes_periode_maison": _report(lambda m: R.cartes(m, None, Contexte((2023, 2024), types=("maison",)))),
        "q14_listes": _report(R.listes),
        "q02_carte_communes": _report(R.carte_communes),
        "q03_ventes_par_mois": _report(lambda m: R.ventes_par_mois(m, 2025)),
        "q04_prix_glissant": _report(R.prix_glissant),
        "q05_ventes_par_annee": _report(R.ventes_par_annee),
        **{
            f"q06_classement_{c}": _report(lambda m, c=c: R.classement_communes(m, c))
            for c in R.CLASSEMENTS
        },
        "q07_accessibilite_cles": _report(R.accessibilite_cles),
        "q08_nuage_accessibilite": _report(R.nuage_accessibilite),
        "q09_moins_accessibles": _report(lambda m: R.communes_moins_accessibles(m)),
        "q10_etiquettes_par_periode": _report(R.etiquettes_par_periode),
        "q11_parts_du_parc": _report(R.parts_du_parc),
        "q12_diagnostics_annee": _report(lambda m: R.diagnostics_annee(m, 2025)),
        "q13_passoires_par_mois": _report(R.passoires_par_mois),
        "q14_selection": _report(
            lambda m: R.selection(m, Contexte((2023, 2024, 2025), ("59", "62"), ("maison",)))
        ),
        "q14_selection_communes": _report(
            lambda m: R.selection(m, Contexte(types=("appartement", "maison"), communes=("59001", "62002", "80003")))
        ),
        "mesures_deux_periodes": _report(
            lambda m: M.prix_deux_periodes(m, Contexte(), ["code_commune"], P.MIN_VENTES_CLASSEMENT)
        ),
        "mesures_ensemble": _report(lambda m: M.mesures_ventes(M.ventes(m), [])),
        "mesures_deux_periodes_ensemble": _report(lambda m: M.prix_deux_periodes(m, Contexte(), [], P.MIN_VENTES_CLASSEMENT)),
        "type_conforme": _report(_type_conforme),
        "niveaux_geographiques": _report(R.niveaux),
        "cumul_annuel": _report(R.cumul_annuel),
        "annee_precedente": _report(_annee_precedente),
        "niveau_vie_selection": _report(lambda m: R.niveau_vie_par(m, "taille_commune")),
        "libelles_ventes": _report(lambda m: R.libelles_ventes(m, range(2021, 2026))),
        "etoile_dimensions": _report(_etoile),
        "population_couverte": _report(_population_couverte),
        "passoires_parc_par_commune": _report(lambda m: M.parts_parc(m.parc, ["code_commune"])),
        "etiquette_frequente": _tables(_etiquette_frequente),
        "quartiles_surface": _tables(_quartiles_surface),
        "communes_hors_referentiel": _tables(_hors_referentiel),
        "v01_non_nuls": _tables(controls.non_nuls),
        "v02_uniques": _tables(controls.uniques),
        "v03_valeurs_acceptees": _tables(controls.valeurs),
        "v04_relations": _tables(controls.relations),
        "v05_combinaison_unique": _tables(controls.combinaison),
        "v06_population_renseignee": _tables(controls.population_renseignee),
        "v07_tous_les_controles": _tables(controls.tous),
        "v08_prix_hors_bornes": _tables(controls.prix_hors_bornes),
        "v09_natures": _tables(controls.natures),
        "v09_natures_inconnues": _tables(controls.natures_inconnues),
        "v10_parts_hors_bornes": _tables(controls.parts_hors_bornes),
        "v03_valeurs_fautives": _faulty(controls.valeurs),
        "v05_combinaison_fautive": _faulty(controls.combinaison),
        "v06_population_fautive": _faulty(controls.population_renseignee),
        "v08_prix_fautifs": _faulty(controls.prix_hors_bornes),
        "v09_natures_fautives": _faulty(controls.natures_inconnues),
        "v10_parts_fautives": _faulty(controls.parts_hors_bornes),
        "source_dvf_csv": _tables(_source("dvf_mutations")),
        "source_dpe_json": _tables(_source("dpe_logements")),
        "source_insee_parquet": _tables(_source("insee_comparateur")),
        "chargement_brut": _tables(_chargement),
        "chargement_brut_dpe": _tables(_landed("dpe_logements")),
        "publication": _tables(_publication),
        "publication_mart_prix": _tables(_published("mart_prix_commune_annee")),
        "publication_fct_ventes": _tables(_published("fct_ventes")),
        "st1_ingestion": _tables(_ingestion),
        "st2_dedoublonnage": _tables(_dedoublonnage),
        "st3_flux_mensuel": _tables(_flux_mensuel),
        "st3_flux_compacte": _tables(_flux_compacte),
        "st3_flux_journalier": _tables(_flux_journalier),
        "st4_dernier_courant": _tables(_dernier_courant),
        "st5_historique": _tables(_historique),
    }
    return q
