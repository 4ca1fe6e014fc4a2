"""Wall seconds of the headline queries; prints one JSON line.

``build_*`` entries write the tables of the star once, in dependency order, from the raw test tables; the
other entries read those tables and are the second of two runs, after the JVM has compiled the plan.
"""

from __future__ import annotations

import json
import os
import sys
import time

import pyspark

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from terroir.catalog import queries  # noqa: E402
from terroir.plans.warehouse import EXPORTS, warehouse  # noqa: E402
from terroir.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
BUILD = (
    "stg_dpe_logements", "int_ventes_logement",
    "int_dpe_logement_dernier", "int_insee_commune", *EXPORTS,
)
HEADLINE = (
    "int_ventes_logement", "int_dpe_logement_dernier", "dim_commune", "fct_dpe_mensuel", "mart_prix_commune_annee",
    "mart_logement_commune", "q01_cartes", "q02_carte_communes", "q03_ventes_par_mois", "q04_prix_glissant",
    "q06_classement_prix", "q07_accessibilite_cles", "q09_moins_accessibles", "q10_etiquettes_par_periode",
    "q13_passoires_par_mois", "niveaux_geographiques", "cumul_annuel", "v07_tous_les_controles",
    # Readers, streams and publication, which did not count in the first rounds.
    "source_dvf_csv", "source_dpe_json", "st2_dedoublonnage", "st3_flux_journalier", "st4_dernier_courant", "publication",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    spark = local_session(CPUS, int(CPUS) if CPUS.isdigit() else 8)
    spark.range(1000).selectExpr("sum(id)").collect()
    w = warehouse(spark, SF_DIR)
    times = {f"build_{name}": timed(lambda n=name: w.table(n)) for name in BUILD}
    catalog = queries()
    for name in HEADLINE:
        run = lambda f=catalog[name]: f(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        run()
        times[name] = timed(run)
    print(
        json.dumps(
            {
                "metric": "total wall seconds of the build and the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "spark": pyspark.__version__,
                "cpus": CPUS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
