"""DuckDB statements of checks, sources, publication and incremental variants."""

from __future__ import annotations

from oracle.base import with_ctes

_E = "error"


def _row(check: str, table: str, column: str, count: str, severity: str = _E) -> str:
    return (
        f"select '{check}' as controle, '{table}' as table_controlee, '{column}' as colonne, "
        f"'{severity}' as severite, cast(({count}) as bigint) as echecs"
    )


# Table name -> expression holding its rows.
_T = {
    "dvf_mutations": "dvf_raw",
    "dpe_logements": "dpe_raw",
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
    "mart_prix_commune_annee": "mart_prix",
    "mart_logement_commune": "mart_logement",
    "mart_dpe_commune_etiquette": "mart_dpe",
    "departements": "departements",
}

_NOT_NULL = """
dvf_mutations id_mutation
dpe_logements numero_dpe
stg_dvf_mutations id_mutation date_mutation code_commune
stg_dpe_logements numero_dpe code_commune
stg_insee_indicateurs code_commune indicateur
int_ventes_logement id_mutation surface_reelle_bati
int_dpe_logement_dernier cle_logement
int_insee_commune code_commune
dim_date date
dim_commune code_commune nom_departement
fct_ventes id_mutation date_vente code_commune
fct_dpe_mensuel mois nb_dpe
mart_prix_commune_annee cle code_commune nb_ventes prix_m2_median
mart_logement_commune code_commune population
mart_dpe_commune_etiquette cle
departements code_departement
"""
_UNIQUE = """
dpe_logements numero_dpe warn
stg_dpe_logements numero_dpe error
int_ventes_logement id_mutation error
int_dpe_logement_dernier cle_logement error
int_insee_commune code_commune error
dim_date date error
dim_commune code_commune error
fct_ventes id_mutation error
mart_prix_commune_annee cle error
mart_logement_commune code_commune error
mart_dpe_commune_etiquette cle error
departements code_departement error
"""
_VALUES = (
    ("stg_dpe_logements", "etiquette_dpe", "'A', 'B', 'C', 'D', 'E', 'F', 'G'"),
    ("stg_dpe_logements", "type_batiment", "'maison', 'appartement', 'immeuble'"),
    ("int_ventes_logement", "type_local", "'Maison', 'Appartement'"),
    ("mart_dpe_commune_etiquette", "etiquette_dpe", "'A', 'B', 'C', 'D', 'E', 'F', 'G'"),
)
_REL = """
int_ventes_logement code_commune int_insee_commune code_commune warn
int_dpe_logement_dernier code_commune int_insee_commune code_commune warn
fct_ventes date_vente dim_date date error
fct_ventes code_commune dim_commune code_commune error
fct_dpe_mensuel mois dim_date date error
fct_dpe_mensuel code_commune dim_commune code_commune error
"""
_FLUX = "mois, code_commune, type_logement, periode_construction, etiquette_dpe"
_PARTS = (
    "part_logements_vacants", "part_residences_secondaires", "part_proprietaires",
    "part_passoires_thermiques", "part_logements_performants",
)


def _lines(block: str) -> list[list[str]]:
    return [line.split() for line in block.strip().splitlines()]


def statements() -> dict[str, str]:
    nn = [
        _row("not_null", t, c, f"select count(*) - count({c}) from {_T[t]}") for t, *cols in _lines(_NOT_NULL) for c in cols
    ]
    un = [
        _row("unique", t, c, f"select count(*) from (select {c} from {_T[t]} where {c} is not null group by {c} having count(*) > 1)", s)
        for t, c, s in _lines(_UNIQUE)
    ]
    va = [
        _row("accepted_values", t, c, f"select count(distinct {c}) from {_T[t]} where {c} not in ({v})") for t, c, v in _VALUES
    ]
    re_ = [
        _row(
            "relationships", t, c,
            f"select count(*) from {_T[t]} x left join (select distinct {f} as k from {_T[p]}) y on x.{c} = y.k where x.{c} is not null and y.k is null",
            s,
        )
        for t, c, p, f, s in _lines(_REL)
    ]
    combi = _row("unique_combinaison", "fct_dpe_mensuel", _FLUX.replace(" ", ""), f"select count(*) from (select {_FLUX} from fct_dpe_mensuel group by all having count(*) > 1)")
    pop = _row("not_null", "int_insee_commune", "population", "select count(*) from insee_commune where population is null and code_commune not like '976%'")
    hors = "select * from mart_prix where prix_m2_median < 200 or prix_m2_median > 30000"
    natures = """select nature_mutation, count(*) as nb_lignes,
      nature_mutation in ('Vente', 'Vente en l''état futur d''achèvement', 'Vente terrain à bâtir', 'Adjudication',
                          'Expropriation', 'Echange') as est_connue
      from stg_dvf group by nature_mutation"""
    inconnues = f"select nature_mutation, nb_lignes from ({natures}) n where not est_connue"
    parts = "select code_commune, nom_commune from mart_logement where " + " or ".join(f"{c} < 0 or {c} > 1" for c in _PARTS)
    singular = [
        _row("prix_hors_bornes", "mart_prix_commune_annee", "", f"select count(*) from ({hors}) h"),
        _row("natures_inconnues", "stg_dvf_mutations", "", f"select count(*) from ({inconnues}) h"),
        _row("parts_hors_bornes", "mart_logement_commune", "", f"select count(*) from ({parts}) h"),
    ]
    all_ctes = tuple(_T.values())

    def union(rows: list[str]) -> str:
        return "\nunion all\n".join(rows)

    everything = union([*nn, pop, *un, *va, *re_, combi, *singular])
    counts = union(
        [
            f"select '{t}' as nom_table, count(*) as nb_lignes from {_T[t]}"
            for t in (
                "dim_date", "dim_commune", "fct_ventes", "fct_dpe_mensuel", "mart_dpe_commune_etiquette",
                "mart_prix_commune_annee", "mart_logement_commune",
            )
        ]
    )
    snapshot = """
      select cle_logement, numero_dpe, etiquette_dpe, surface_habitable from (
        select concat(ifnull(identifiant_ban, 'sans-adresse-' || numero_dpe), '|', type_batiment, '|',
                      ifnull(cast(round(surface_habitable) as varchar), '?')) as cle_logement,
               numero_dpe, etiquette_dpe, surface_habitable, date_etablissement_dpe as d
        from stg_dpe where type_batiment <> 'immeuble' and code_commune is not null and {known}
      ) k qualify row_number() over (partition by cle_logement order by d desc nulls last, numero_dpe desc) = 1"""
    a, b = snapshot.format(known="date_etablissement_dpe < date '2024-01-01'"), snapshot.format(known="true")
    history = f"""
      select a.*, date '2024-01-01' as valide_du,
             case when b.cle_logement is null or (a.numero_dpe, a.etiquette_dpe, a.surface_habitable) is distinct from (b.numero_dpe, b.etiquette_dpe, b.surface_habitable)
                  then date '2026-06-30' end as valide_au
      from ({a}) a left join ({b}) b on a.cle_logement = b.cle_logement
      union all
      select b.*, date '2026-06-30', null
      from ({b}) b left join ({a}) a on a.cle_logement = b.cle_logement
      where a.cle_logement is null or (a.numero_dpe, a.etiquette_dpe, a.surface_habitable) is distinct from (b.numero_dpe, b.etiquette_dpe, b.surface_habitable)"""
    # The faults put into the tables of the queries named "faut...".
    faults = {
        "mart_dpe": "(select * replace (translate(etiquette_dpe, 'AG', 'ZH') as etiquette_dpe) from mart_dpe) x",
        "fct_dpe_mensuel": "(select * from fct_dpe_mensuel union all select * from fct_dpe_mensuel where month(mois) = 1) x",
        "insee_commune": "(select * replace (case when code_commune not like '%1' then population end as population) from insee_commune) x",
        "mart_prix": "(select * replace (prix_m2_median * if(annee = 2024, 100.0, 1.0) as prix_m2_median) from mart_prix) x",
        "stg_dvf": "(select * replace (if(code_commune like '59%', 'Don', nature_mutation) as nature_mutation) from stg_dvf) x",
        "mart_logement": "(select * replace (part_proprietaires + if(code_commune like '62%', 1.5, 0.0) as part_proprietaires) from mart_logement) x",
    }
    return {
        "v01_non_nuls": with_ctes(union(nn), *all_ctes),
        "v02_uniques": with_ctes(union(un), *all_ctes),
        "v03_valeurs_acceptees": with_ctes(union(va), *all_ctes),
        "v04_relations": with_ctes(union(re_), *all_ctes),
        "v05_combinaison_unique": with_ctes(combi, "fct_dpe_mensuel"),
        "v06_population_renseignee": with_ctes(pop, "insee_commune"),
        "v07_tous_les_controles": with_ctes(
            f"select *, case when echecs = 0 then 'ok' else severite end as statut from ({everything}) c", *all_ctes
        ),
        "v08_prix_hors_bornes": with_ctes(hors, "mart_prix"),
        "v09_natures": with_ctes(natures, "stg_dvf"),
        "v09_natures_inconnues": with_ctes(inconnues, "stg_dvf"),
        "v10_parts_hors_bornes": with_ctes(parts, "mart_logement"),
        "v03_valeurs_fautives": with_ctes(union(va).replace("from mart_dpe", f"from {faults['mart_dpe']}"), *all_ctes),
        "v05_combinaison_fautive": with_ctes(combi.replace("from fct_dpe_mensuel", f"from {faults['fct_dpe_mensuel']}"), "fct_dpe_mensuel"),
        "v06_population_fautive": with_ctes(pop.replace("from insee_commune", f"from {faults['insee_commune']}"), "insee_commune"),
        "v08_prix_fautifs": with_ctes(hors.replace("from mart_prix", f"from {faults['mart_prix']}"), "mart_prix"),
        "v09_natures_fautives": with_ctes(inconnues.replace("from stg_dvf", f"from {faults['stg_dvf']}"), "stg_dvf"),
        "v10_parts_fautives": with_ctes(parts.replace("from mart_logement", f"from {faults['mart_logement']}"), "mart_logement"),
        "source_dvf_csv": with_ctes(
            """select * replace (nullif(valeur_fonciere, '') as valeur_fonciere), substr(date_mutation, 1, 4) as _annee_fichier,
               case when date_mutation >= '2024' then code_commune end as ancien_code_commune from dvf_raw""",
            "dvf_raw",
        ),
        "source_dpe_json": with_ctes("select * exclude (replica) from dpe_raw", "dpe_raw"),
        "source_insee_parquet": with_ctes("select * from insee_raw", "insee_raw"),
        "chargement_brut": with_ctes(
            union([f"select '{t}' as nom_table, count(*) as nb_lignes from {c}" for t, c in
                   (("dvf_mutations", "dvf_raw"), ("dpe_logements", "dpe_raw"), ("insee_comparateur", "insee_raw"))]),
            "dvf_raw", "dpe_raw", "insee_raw",
        ),
        "chargement_brut_dpe": with_ctes("select * exclude (replica) from dpe_raw", "dpe_raw"),
        "publication": with_ctes(counts, *all_ctes),
        "publication_mart_prix": with_ctes("select * from mart_prix", "mart_prix"),
        "publication_fct_ventes": with_ctes("select * from fct_ventes", "fct_ventes"),
        "st1_ingestion": with_ctes("select * exclude (replica) from dpe_raw", "dpe_raw"),
        "st2_dedoublonnage": with_ctes("select * from stg_dpe", "stg_dpe"),
        "st3_flux_mensuel": with_ctes("select * from fct_dpe_mensuel", "fct_dpe_mensuel"),
        "st3_flux_compacte": with_ctes("select * from fct_dpe_mensuel", "fct_dpe_mensuel"),
        "st3_flux_journalier": with_ctes(
            """select date_etablissement_dpe as jour, etiquette_dpe, count(*) as nb_dpe from stg_dpe
               where date_etablissement_dpe is not null group by all""",
            "stg_dpe",
        ),
        "st4_dernier_courant": with_ctes("select * from dpe_dernier", "dpe_dernier"),
        "st5_historique": with_ctes(history, "stg_dpe"),
    }
