"""DuckDB statements of the report queries and single operators."""

from __future__ import annotations

from oracle.base import with_ctes

VERT, ORANGE, ROUGE = "#1D7A3A", "#E58606", "#B3261E"


def _signed(pct: str) -> str:
    return f"printf('%+.1f', case when round({pct}, 1) = 0 then 0.0 else round({pct}, 1) end)"


def _label(e: str, year: str | None, unit: str = " %") -> str:
    tail = "" if year is None else f" || ' vs ' || cast({year} - 1 as varchar)"
    return f"case when {e} is null then null else if({e} < 0, '▼ ', '▲ ') || {_signed(f'({e}) * 100.0')} || '{unit}'{tail} end"


def _colour(e: str, inverse: bool = False) -> str:
    bad = f"{e} > 0" if inverse else f"{e} < 0"
    return f"case when {bad} then '{ROUGE}' else '{VERT}' end"


def _thousands(x: str) -> str:
    return f"format('{{:,}}', cast(round({x}) as bigint))"


_ACCES = f"case when {{x}} >= 8 then '{ROUGE}' when {{x}} >= 6 then '{ORANGE}' else '{VERT}' end"

# Yearly measures of sales and diagnostics, and the same year shifted by one.
_ANNEES = """
v as (select year(date_vente) as an, median(prix_m2) as m2, count(*) as n, median(prix) as p from fct_ventes {where} group by 1),
f as (select year(mois) as an, sum(nb_dpe) as n, sum(nb_dpe) filter (est_passoire_thermique) as np
      from fct_dpe_mensuel group by 1)
"""


def _cartes(annee: int, where: str = "", where_dpe: str = "") -> str:
    src = _ANNEES.format(where=where).replace("from fct_dpe_mensuel group", f"from fct_dpe_mensuel {where_dpe} group")
    titles = {
        "prix_m2": "Prix médian au m²",
        "ventes": "Ventes de logements",
        "prix_median": "Prix médian d''un logement",
        "passoires": "Passoires (F-G) parmi les DPE",
    }
    exprs = {"prix_m2": ("m2", " €"), "ventes": ("n", ""), "prix_median": ("p", " €")}
    parts = []
    for card, (c, suffix) in exprs.items():
        e = f"(x.{c} - y.{c}) / y.{c}"
        parts.append(
            f"""select cast({annee} as integer) as annee, '{card}' as carte, cast(x.{c} as double) as valeur,
            {_thousands(f'x.{c}')} || '{suffix}' as texte, {_label(e, str(annee))} as libelle,
            {_colour(e)} as couleur, '{titles[card]} · {annee}' as titre
            from (select {annee} as an) a left join v x on x.an = a.an left join v y on y.an = a.an - 1"""
        )
    e = "(x.np / x.n - y.np / y.n)"
    parts.append(
        f"""select cast({annee} as integer), 'passoires', x.np / x.n, printf('%.1f', round(x.np / x.n * 100.0, 1)) || ' %',
        {_label(e, str(annee), ' pts')}, {_colour(e, True)}, '{titles['passoires']} · {annee}'
        from (select {annee} as an) a left join f x on x.an = a.an left join f y on y.an = a.an - 1"""
    )
    sql = with_ctes("select 1", "fct_ventes", "fct_dpe_mensuel", "dim_commune")
    return sql[: -len("select 1")].rstrip() + ",\n" + src.strip() + "\n" + "\nunion all\n".join(parts)


def _cartes_periode(where: str, where_dpe: str) -> str:
    """The cards without a single year: values over all years, no comparison, the period in the titles."""
    sales = f"(select median(prix_m2) as m2, count(*) as n, median(prix) as p from fct_ventes {where})"
    flow = f"(select sum(nb_dpe) filter (est_passoire_thermique) / sum(nb_dpe) as q from fct_dpe_mensuel {where_dpe})"
    cards = [
        ("prix_m2", "Prix médian au m²", "m2", f"{_thousands('m2')} || ' €'", sales),
        ("ventes", "Ventes de logements", "cast(n as double)", _thousands("n"), sales),
        ("prix_median", "Prix médian d''un logement", "p", f"{_thousands('p')} || ' €'", sales),
        ("passoires", "Passoires (F-G) parmi les DPE", "q", "printf('%.1f', round(q * 100.0, 1)) || ' %'", flow),
    ]
    return " union all ".join(
        f"""select cast(null as integer) as annee, '{card}' as carte, {value} as valeur, {text} as texte,
        cast(null as varchar) as libelle, '{VERT}' as couleur, '{title} · 2021-2025' as titre from {source}"""
        for card, title, value, text, source in cards
    )


def _rolling(by_type: bool) -> str:
    t = ", type_logement" if by_type else ""
    cond = " and b.type_logement = a.type_logement" if by_type else ""
    return f"""
    select a.mois as premier_jour_mois{', a.type_logement' if by_type else ''}, any_value(a.n) as nb_ventes, count(b.prix_m2) as nb_ventes_12m,
           median(b.prix_m2) as prix_m2_median_12m
    from (select date_trunc('month', date_vente)::date as mois{t}, count(*) as n from fct_ventes group by all) a
    join fct_ventes b on b.date_vente < a.mois + interval 1 month and b.date_vente >= a.mois - interval 11 month{cond}
    group by a.mois{', a.type_logement' if by_type else ''}
    """


_PERIODES = """
select code_commune, median(prix_m2) filter (year(date_vente) <= 2022) as prix_m2_debut,
       median(prix_m2) filter (year(date_vente) >= 2024) as prix_m2_fin,
       count(*) filter (year(date_vente) <= 2022) as nb_debut, count(*) filter (year(date_vente) >= 2024) as nb_fin
from fct_ventes where year(date_vente) <> 2023 and year(date_vente) between 2021 and 2025 group by code_commune
"""


def _periodes(minimum: int) -> str:
    return f"""
    select *, (prix_m2_fin - prix_m2_debut) / prix_m2_debut as evol_prix_m2,
           case when nb_fin >= {minimum} and nb_debut >= {minimum} then (prix_m2_fin - prix_m2_debut) / prix_m2_debut end as evol_prix_m2_min,
           case when nb_fin >= {minimum} then prix_m2_fin end as prix_m2_min,
           case when nb_fin >= {minimum} then nb_fin end as nb_ventes_min
    from ({_PERIODES}) p
    """


def _classement(measure: str, ascending: bool, minimum: int) -> str:
    op = "<" if ascending else ">"
    return with_ctes(
        f"""
        select cast(1 + (select count(*) from ({_periodes(minimum)}) o where o.{measure} {op} t.{measure}) as integer) as rang,
               t.code_commune, c.nom_commune, t.prix_m2_fin as prix_m2_median, t.nb_fin as nb_ventes,
               t.evol_prix_m2 as evolution,
               case when t.evol_prix_m2 between 0.05 and 100 then 'hausse'
                    when t.evol_prix_m2 >= 0 and t.evol_prix_m2 < 0.05 then 'stable'
                    when t.evol_prix_m2 < 0 and t.evol_prix_m2 >= -1 then 'baisse' end as classe_evolution,
               c.population
        from ({_periodes(minimum)}) t left join dim_commune c on c.code_commune = t.code_commune
        where t.{measure} is not null
          and (select count(*) from ({_periodes(minimum)}) o where o.{measure} {op} t.{measure}) < 10
        """,
        "fct_ventes",
        "dim_commune",
    )


_ACCESSIBLE = """
select v.code_commune, c.nom_commune, c.nom_departement, c.population, c.niveau_vie_median, v.n as nb_ventes,
       v.p as prix_median, v.p / nullif(c.niveau_vie_median, 0) as annees_pour_acheter
from (select code_commune, count(*) as n, median(prix) as p from fct_ventes
      where year(date_vente) in (2024, 2025) group by code_commune) v
left join dim_commune c on c.code_commune = v.code_commune
"""


def statements() -> dict[str, str]:
    star = ("fct_ventes", "dim_commune")
    q: dict[str, str] = {}
    q["q01_cartes"] = _cartes(2025)
    dep59 = "code_commune in (select code_commune from dim_commune where code_departement = '59')"
    q["q01_cartes_departement"] = _cartes(
        2024,
        f"where {dep59} and lower(type_logement) = 'maison'",
        f"where {dep59} and lower(type_logement) = 'maison'",
    )
    q["q02_carte_communes"] = with_ctes(
        """
        select v.*, c.nom_commune_dep, c.latitude, c.longitude, c.population,
               case when v.prix_m2_median < 1300 then 1300.0 when v.prix_m2_median > 2600 then 2600.0
                    else v.prix_m2_median end::double as prix_m2_couleur
        from (select code_commune, count(*) as nb_ventes, median(prix_m2) as prix_m2_median, median(prix) as prix_median
              from fct_ventes where year(date_vente) >= 2024 and year(date_vente) <= 2025 group by code_commune) v
        left join dim_commune c using (code_commune) where v.nb_ventes >= 20
        """,
        *star,
    )
    q["q03_ventes_par_mois"] = with_ctes(
        """
        select cast(2025 as integer) as annee, cast(a.m as integer) as mois,
               (select any_value(nom_mois_court) from dim_date where mois = a.m) as nom_mois_court,
               a.n as nb_ventes, b.n as nb_ventes_n1
        from (select month(date_vente) as m, count(*) as n from fct_ventes where year(date_vente) = 2025 group by 1) a
        left join (select month(date_vente) as m, count(*) as n from fct_ventes where year(date_vente) = 2024 group by 1) b
          on a.m = b.m
        """,
        "fct_ventes",
        "dim_date",
    )
    q["q04_prix_glissant"] = with_ctes(_rolling(True), "fct_ventes")
    q["q05_ventes_par_annee"] = with_ctes(
        f"""
        select cast(a.an as integer) as annee, a.n as nb_ventes, b.n as nb_ventes_n1, (a.n - b.n) / b.n as evolution,
               {_label('(a.n - b.n) / b.n', None)} as libelle, {_colour('(a.n - b.n) / b.n')} as couleur
        from (select year(date_vente) as an, count(*) as n from fct_ventes group by 1) a
        left join (select year(date_vente) + 1 as an, count(*) as n from fct_ventes group by 1) b on a.an = b.an
        """,
        "fct_ventes",
    )
    q["q06_classement_prix"] = _classement("prix_m2_min", False, 30)
    q["q06_classement_hausse"] = _classement("evol_prix_m2_min", False, 30)
    q["q06_classement_baisse"] = _classement("evol_prix_m2_min", True, 30)
    q["q06_classement_ventes"] = _classement("nb_ventes_min", False, 30)
    q["mesures_deux_periodes"] = with_ctes(_periodes(30), "fct_ventes")
    everywhere = _periodes(30).replace("select code_commune, median", "select median").replace(" group by code_commune", "")
    q["mesures_deux_periodes_ensemble"] = with_ctes(everywhere, "fct_ventes")
    q["mesures_ensemble"] = with_ctes(
        "select median(prix_m2) as prix_m2_median, median(prix) as prix_median, count(*) as nb_ventes from fct_ventes", "fct_ventes"
    )
    q["q01_cartes_periode"] = with_ctes(_cartes_periode("", ""), "fct_ventes", "fct_dpe_mensuel", "dim_commune")
    q["q01_cartes_periode_maison"] = with_ctes(
        _cartes_periode(
            "where year(date_vente) in (2023, 2024) and lower(type_logement) = 'maison'",
            "where year(mois) in (2023, 2024) and lower(type_logement) = 'maison'",
        ),
        "fct_ventes", "fct_dpe_mensuel", "dim_commune",
    )
    q["q14_listes"] = with_ctes(
        """
        select 'annee' as segment, cast(year(date) as varchar) as valeur from dim_date where month(date) = 12 and day(date) = 31
        union select 'departement', nom_departement from dim_commune
        union select 'type', lower(type_logement) from fct_ventes
        union select 'type', lower(type_logement) from fct_dpe_mensuel where type_logement is not null
        """,
        "dim_date", "dim_commune", "fct_ventes", "fct_dpe_mensuel",
    )
    q["q07_accessibilite_cles"] = with_ctes(
        f"""
        select *, {_thousands('niveau_vie_commune_mediane')} || ' €/an' as niveau_vie_carte,
               ifnull(replace({_thousands('nb_communes_retenues')}, ',', ' '), '') || ' communes · 2024-2025' as libelle_communes,
               ifnull(cast(cast(round(part_communes_8_ans * 100) as integer) as varchar) || ' %', '') || ' des communes' as libelle_part,
               'INSEE, revenus 2023' as libelle_source
        from (
          select nullif(count(*), 0) as nb_communes_retenues, median(annees_pour_acheter) as annees_commune_mediane,
                 median(niveau_vie_median) as niveau_vie_commune_mediane,
                 nullif(count(*) filter (annees_pour_acheter >= 8), 0) as communes_8_ans,
                 nullif(count(*) filter (annees_pour_acheter >= 8), 0) / nullif(count(*), 0) as part_communes_8_ans
          from ({_ACCESSIBLE}) a where nb_ventes >= 10
        ) k
        """,
        *star,
    )
    q["q08_nuage_accessibilite"] = with_ctes(
        f"""
        select code_commune, nom_commune, niveau_vie_median, prix_median, nb_ventes, population, annees_pour_acheter,
               {_ACCES.format(x='annees_pour_acheter')} as couleur
        from ({_ACCESSIBLE}) a where nb_ventes >= 10
        """,
        *star,
    )
    q["q09_moins_accessibles"] = with_ctes(
        f"""
        select cast(rang as integer) as rang, code_commune, nom_commune, nom_departement, annees_pour_acheter, prix_median,
               {_ACCES.format(x='annees_pour_acheter')} as couleur
        from (select *, 1 + count(*) over (order by annees_pour_acheter desc range between unbounded preceding and current row)
                     - count(*) over (partition by annees_pour_acheter) as rang
              from ({_ACCESSIBLE}) a where nb_ventes >= 30 and annees_pour_acheter is not null) r
        where rang <= 10
        """,
        *star,
    )
    q["q10_etiquettes_par_periode"] = with_ctes(
        """
        select e.*, e.nb_logements / t.total as part
        from (select periode_construction, periode_construction_tri, etiquette_dpe, sum(nb_logements)::bigint as nb_logements
              from mart_dpe group by all) e
        join (select periode_construction, sum(nb_logements) as total from mart_dpe group by all) t using (periode_construction)
        """,
        "mart_dpe",
    )
    q["q11_parts_du_parc"] = with_ctes(
        """
        select count(*) as nb_logements, count(*) filter (etiquette_dpe in ('F', 'G')) / count(*) as part_passoires_parc,
               count(*) filter (etiquette_dpe in ('A', 'B')) / count(*) as part_logements_ab_parc
        from dpe_dernier
        """,
        "dpe_dernier",
    )
    q["q12_diagnostics_annee"] = with_ctes(
        f"""
        select cast(2025 as integer) as annee, a.n as nb_dpe, b.n as nb_dpe_n1, (a.n - b.n) / b.n as evolution,
               {_thousands('a.n')} as texte, {_label('(a.n - b.n) / b.n', '2025')} as libelle
        from (select sum(nb_dpe)::bigint as n from fct_dpe_mensuel where year(mois) = 2025) a,
             (select sum(nb_dpe)::bigint as n from fct_dpe_mensuel where year(mois) = 2024) b
        """,
        "fct_dpe_mensuel",
    )
    q["q13_passoires_par_mois"] = with_ctes(
        """
        select mois as premier_jour_mois, sum(nb_dpe)::bigint as nb_dpe,
               (sum(nb_dpe) filter (est_passoire_thermique))::bigint as nb_passoires,
               sum(nb_dpe) filter (est_passoire_thermique) / sum(nb_dpe) as part_passoires
        from fct_dpe_mensuel group by mois
        """,
        "fct_dpe_mensuel",
    )
    q["q14_selection"] = with_ctes(
        """
        select cast(year(date_vente) as integer) as annee, median(prix_m2) as prix_m2_median, median(prix) as prix_median,
               count(*) as nb_ventes
        from fct_ventes v join dim_commune c using (code_commune)
        where c.code_departement in ('59', '62') and v.type_logement = 'Maison' and year(date_vente) in (2023, 2024, 2025)
        group by year(date_vente)
        """,
        *star,
    )
    q["q14_selection_communes"] = with_ctes(
        """
        select cast(year(date_vente) as integer) as annee, median(prix_m2) as prix_m2_median, median(prix) as prix_median,
               count(*) as nb_ventes
        from fct_ventes where code_commune in ('59001', '62002', '80003') and type_logement in ('Maison', 'Appartement')
        group by year(date_vente)
        """,
        "fct_ventes",
    )
    q["type_conforme"] = with_ctes(
        """
        select ifnull(v.t, d.t) as type_logement, v.n as nb_ventes, d.n as nb_dpe, p.n as nb_logements
        from (select lower(type_logement) as t, count(*) as n from fct_ventes group by 1) v
        full join (select type_logement as t, sum(nb_dpe)::bigint as n from fct_dpe_mensuel group by 1) d on d.t = v.t
        full join (select type_batiment as t, sum(nb_logements)::bigint as n from mart_dpe group by 1) p on p.t = v.t
        """,
        "fct_ventes",
        "fct_dpe_mensuel",
        "mart_dpe",
    )
    q["niveaux_geographiques"] = with_ctes(
        """
        select case grouping(c.code_departement, v.code_commune) when 0 then 'commune' when 1 then 'departement' else 'total' end as niveau,
               c.code_departement as departement, v.code_commune as commune, median(v.prix_m2) as prix_m2_median, count(*) as nb_ventes
        from fct_ventes v left join dim_commune c on c.code_commune = v.code_commune
        group by grouping sets ((), (c.code_departement), (c.code_departement, v.code_commune))
        """,
        *star,
    )
    q["cumul_annuel"] = with_ctes(
        """
        select cast(year(m) as integer) as annee, cast(month(m) as integer) as mois, n as nb_ventes,
               (select count(*) from fct_ventes where date_vente < t.m + interval 1 month and date_vente >= t.m - interval 11 month) as nb_ventes_12m,
               (select count(*) from fct_ventes where date_vente < t.m + interval 1 month and year(date_vente) = year(t.m)) as nb_ventes_cumul
        from (select date_trunc('month', date_vente)::date as m, count(*) as n from fct_ventes group by 1) t
        """,
        "fct_ventes",
    )
    q["annee_precedente"] = with_ctes(
        """
        select cast(a.an as integer) as annee, a.c as code_commune, a.n as nb_ventes, b.n as nb_ventes_n1
        from (select year(date_vente) as an, code_commune as c, count(*) as n from fct_ventes group by all) a
        left join (select year(date_vente) as an, code_commune as c, count(*) as n from fct_ventes group by all) b
          on b.c = a.c and b.an = a.an - 1
        """,
        "fct_ventes",
    )
    q["niveau_vie_selection"] = with_ctes(
        """
        select taille_commune, count(*) as nb_communes,
               case when count(distinct coalesce(cast(niveau_vie_median as varchar), 'vide')) = 1 then max(niveau_vie_median) end as niveau_vie_median
        from dim_commune group by taille_commune
        """,
        "dim_commune",
    )
    q["libelles_ventes"] = with_ctes(
        f"""
        select cast(an as integer) as annee, 'Ventes par mois · ' || ifnull(cast(an as varchar), '2021-2025') as titre,
               replace({_thousands('n')}, ',', ' ') || ' ventes'
               || ifnull(' · le trait bleu foncé indique le même mois en ' || cast(an - 1 as varchar), '') as sous_titre
        from (select year(date_vente) as an, count(*) as n from fct_ventes where year(date_vente) between 2021 and 2025
              group by rollup (year(date_vente))) t
        """,
        "fct_ventes",
    )
    q["etoile_dimensions"] = with_ctes(
        """
        select d.annee_trimestre, c.taille_commune, count(*) as nb_ventes, sum(v.prix) as prix_total
        from fct_ventes v left join dim_date d on d.date = v.date_vente left join dim_commune c on c.code_commune = v.code_commune
        group by all
        """,
        *star,
        "dim_date",
    ).replace("sum(v.prix) as prix_total", "cast(sum(cast(v.prix as decimal(18, 2))) as double) as prix_total")
    q["population_couverte"] = with_ctes(
        """
        select c.nom_departement, sum(c.population) as population, min(c.nom_commune) as premiere_commune, count(*) as nb_communes
        from dim_commune c where exists (select 1 from fct_ventes v where v.code_commune = c.code_commune)
        group by c.nom_departement
        """,
        *star,
    )
    q["passoires_parc_par_commune"] = with_ctes(
        """
        select code_commune, count(*) as nb_logements,
               nullif(count(*) filter (etiquette_dpe in ('F', 'G')), 0) / count(*) as part_passoires_parc,
               nullif(count(*) filter (etiquette_dpe in ('A', 'B')), 0) / count(*) as part_logements_ab_parc
        from dpe_dernier group by code_commune
        """,
        "dpe_dernier",
    )
    q["etiquette_frequente"] = with_ctes(
        """
        select type_batiment, periode_construction,
               (list(etiquette_dpe order by n desc, etiquette_dpe))[1] as etiquette_dpe
        from (select type_batiment, periode_construction, etiquette_dpe, count(*) as n from dpe_dernier
              where etiquette_dpe is not null group by all) t
        group by all
        """,
        "dpe_dernier",
    )
    q["quartiles_surface"] = with_ctes(
        """
        select type_batiment, quantile_cont(surface_habitable, 0.25) as q1, quantile_cont(surface_habitable, 0.5) as mediane,
               quantile_cont(surface_habitable, 0.75) as q3, count(surface_habitable) as nb
        from stg_dpe group by type_batiment
        """,
        "stg_dpe",
    )
    q["communes_hors_referentiel"] = with_ctes(
        """
        select code_commune, count(*) as nb_lignes from stg_dvf
        where code_commune not in (select code_commune from insee_commune) group by code_commune
        """,
        "stg_dvf",
        "insee_commune",
    )
    return q
