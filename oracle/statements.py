"""All DuckDB statements by query name."""

from __future__ import annotations

from oracle import other, reports
from oracle.base import with_ctes

MODEL_CTE = {
    "stg_dvf_mutations": "stg_dvf",
    "stg_dpe_logements": "stg_dpe",
    "stg_insee_indicateurs": "stg_insee",
    "int_ventes_logement": "ventes",
    "int_dpe_logement_dernier": "dpe_dernier",
    "int_insee_commune": "insee_commune",
    "dim_date": "dim_date",
    "dim_commune": "dim_commune",
    "fct_ventes": "fct_ventes",
    "fct_dpe_mensuel": "fct_dpe_mensuel",
    "mart_dpe_commune_etiquette": "mart_dpe",
    "mart_prix_commune_annee": "mart_prix",
    "mart_logement_commune": "mart_logement",
}


def statements() -> dict[str, str]:
    out = {name: with_ctes(f"select * from {cte}", cte) for name, cte in MODEL_CTE.items()}
    out["dim_date"] = out["calendrier_activite"] = with_ctes(
        """
        select j.*, v.n as nb_ventes, d.n as nb_dpe
        from dim_date j
        left join (select date_vente as k, count(*) as n from fct_ventes group by date_vente) v on v.k = j.date
        left join (select mois as k, cast(sum(nb_dpe) as bigint) as n from fct_dpe_mensuel group by mois) d on d.k = j.date
        """,
        "dim_date", "fct_ventes", "fct_dpe_mensuel",
    )
    out |= reports.statements()
    out |= other.statements()
    return out
