"""DuckDB statements for the raw tables and the models, as named common table expressions.

Written to be plainly checkable: tuples are counted, rows are ranked, nothing is shared with the Spark
plans. ``with_ctes(sql, *names)`` prefixes a query with the expressions it needs.
"""

from __future__ import annotations

_DEP = "list_extract(['02', '59', '60', '62', '80'], cast({n} % 5 as integer) + 1)"


def _com(k: str, n: str) -> str:
    rank = f"case when {k} % 7 <> 6 then ({k} // 7) % 2 + 1 else ({k} // 7) % (cast(floor(sqrt({k})) as bigint) + 1) % 997 + 3 end"
    return f"({_DEP.format(n=n)} || lpad(cast(cast({rank} as integer) as varchar), 3, '0'))"


_SCOPE = "('02', '59', '60', '62', '80')"

CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (needs, sql)


_cte(
    "dvf_raw",
    f"""
select cast(o_orderkey as varchar) as id_mutation,
       cast(date '2021-01-01' + cast(date_diff('day', date '1995-01-01', cast(o_orderdate as date)) % 1826 as integer) as varchar) as date_mutation,
       case o_orderpriority when '1-URGENT' then 'Vente en l''état futur d''achèvement'
                            when '5-LOW' then 'Adjudication' else 'Vente' end as nature_mutation,
       case when o_orderkey % 3 = 0 then replace(cast(o_totalprice as varchar), '.', ',')
            when o_orderkey % 97 = 0 then ''
            else cast(o_totalprice as varchar) end as valeur_fonciere,
       '59' || lpad(cast(c_custkey % 1000 as varchar), 3, '0') as code_postal,
       {_com('c_custkey', 'c_nationkey')} as code_commune,
       'Commune ' || {_com('c_custkey', 'c_nationkey')} as nom_commune,
       {_DEP.format(n='c_nationkey')} as code_departement,
       'P' || l_partkey || '-' || k as id_parcelle,
       cast(l_linenumber as varchar) as lot1_numero,
       l_linenumber || '.0' as nombre_lots,
       case p_type when 'STANDARD' then '1' when 'MEDIUM' then '2' when 'LARGE' then '4'
                   when 'ECONOMY' then null else '3' end as code_type_local,
       case p_type when 'STANDARD' then 'Maison' when 'MEDIUM' then 'Appartement'
                   when 'LARGE' then 'Local industriel. commercial ou assimilé'
                   when 'ECONOMY' then null else 'Dépendance' end as type_local,
       case when l_suppkey % 50 <> 0 then cast(l_quantity * 4 as varchar) end as surface_reelle_bati,
       cast(p_size % 8 as varchar) as nombre_pieces_principales,
       case when l_linenumber = 1 then cast(l_quantity * 10 as varchar) end as surface_terrain,
       case when l_partkey % 11 <> 0 then cast(2 + (c_custkey % 50) * cast(0.01 as double) as varchar) end as longitude,
       case when l_partkey % 11 <> 0 then cast(49 + (c_custkey % 70) * cast(0.01 as double) as varchar) end as latitude
from lineitem
join orders on o_orderkey = l_orderkey
join customer on c_custkey = o_custkey
join part on p_partkey = l_partkey
join (values (1), (2)) copies(k) on k = 1 or l_returnflag = 'R'
""",
)

_NUM = "'DPE' || lpad(cast({e} as varchar), 8, '0')"
_cte(
    "dpe_raw",
    f"""
select {_NUM.format(e='event_id')} as numero_dpe,
       case when event_id % 7 = 0 then {_NUM.format(e='(event_id - 1)')} end as numero_dpe_remplace,
       case when event_id % 211 = 0 then 'inconnue'
            else cast(date '2021-07-01' + cast((event_id * 37) % 1600 as integer) as varchar) end as date_etablissement_dpe,
       case when event_id % 53 <> 0 then {_com('user_id', 'user_id')} end as code_insee_ban,
       'Commune ' || {_com('user_id', 'user_id')} as nom_commune_ban,
       {_DEP.format(n='user_id')} as code_departement_ban,
       case when event_id % 40 <> 0 then 'BAN' || user_id end as identifiant_ban,
       case event_type when 'view' then 'Maison' when 'signup' then 'maison' when 'error' then 'immeuble'
                       else 'Appartement' end as type_batiment,
       case when k % 23 <> 0 then list_extract(['avant 1948', '1948-1974', '1975-1977', '1978-1982', '1983-1988',
            '1989-2000', '2001-2005', '2006-2012', '2013-2021', 'après 2021'], k % 10 + 1) end as periode_construction,
       (1900 + k) || '.0' as annee_construction,
       cast(cast(floor(value / 4) * 5 + 9 as double) as varchar) as surface_habitable_logement,
       lower(substr('ABCDEFG', cast(floor(value) as bigint) % 7 + 1, 1)) as etiquette_dpe,
       lower(substr('ABCDEFG', cast(floor(value / 2) as bigint) % 7 + 1, 1)) as etiquette_ges,
       cast(cast(floor(value * 4) as bigint) as varchar) as conso_5_usages_par_m2_ep,
       cast(cast(floor(value / 2) as bigint) as varchar) as emission_ges_5_usages_par_m2,
       replica
from (select *, cast(json_extract_string(props, '$.k') as integer) as k from events) e
join (values (1), (2)) copies(replica) on replica = 1 or event_id % 100 = 0
""",
)

_cte(
    "insee_raw",
    f"""
select geo as GEO, 'Commune ' || geo as GEO_LABEL, 'COM' as GEO_OBJECT, m as TAB_MEASURE, m as TAB_MEASURE_LABEL,
       cast(an as varchar) as TIME_PERIOD, cast(v as double) as OBS_VALUE,
       case when m = 'MED_SL' and geo like '%004' then 'C' end as CONF_STATUS, '2026' as GEO_REF
from (
  select geo, an,
         unnest(['POP', 'SUP', 'MED_SL', 'PR_MD60', 'DWELLINGS', 'DWELLINGS_OCS_DW_MAIN',
                 'DWELLINGS_OCS_DW_MAIN_TSH_100', 'DWELLINGS_OCS_DW_VAC', 'DWELLINGS_OCS_DW_SEC_DW_OCC']) as m,
         unnest([cast(n * 100 + an - 2022 as double), n * 0.25, 18000 + (n * 37) % 9000, 10 + n % 15, n * 50.5,
                 n * 40, n * 22, n * 4, n * 6.5]) as v
  from (select {_com('c_custkey', 'c_nationkey')} as geo, count(*) as n from customer group by 1) g
  join (values (2022), (2023)) y(an) on geo not like '%005'
) t
union all
select '59', 'Nord', 'DEP', 'POP', 'POP', '2023', cast(2600000 as double), null, '2026'
""",
)

_INT = "cast(round(try_cast({c} as double)) as integer)"
_cte(
    "stg_dvf",
    f"""
select id_mutation, cast(date_mutation as date) as date_mutation,
       cast(substr(date_mutation, 1, 4) as integer) as annee,
       nature_mutation, try_cast(replace(valeur_fonciere, ',', '.') as double) as valeur_fonciere,
       code_postal, code_commune, nom_commune, code_departement, id_parcelle, lot1_numero,
       {_INT.format(c='nombre_lots')} as nombre_lots, code_type_local, type_local,
       try_cast(surface_reelle_bati as double) as surface_reelle_bati,
       {_INT.format(c='nombre_pieces_principales')} as nombre_pieces_principales,
       try_cast(surface_terrain as double) as surface_terrain,
       try_cast(longitude as double) as longitude, try_cast(latitude as double) as latitude
from dvf_raw
""",
    "dvf_raw",
)
_cte(
    "stg_dpe",
    f"""
select numero_dpe, numero_dpe_remplace, try_cast(date_etablissement_dpe as date) as date_etablissement_dpe,
       code_insee_ban as code_commune, nom_commune_ban as nom_commune, code_departement_ban as code_departement,
       identifiant_ban, lower(type_batiment) as type_batiment, periode_construction,
       {_INT.format(c='annee_construction')} as annee_construction,
       try_cast(surface_habitable_logement as double) as surface_habitable,
       upper(etiquette_dpe) as etiquette_dpe, upper(etiquette_ges) as etiquette_ges,
       try_cast(conso_5_usages_par_m2_ep as double) as conso_energie_primaire_m2,
       try_cast(emission_ges_5_usages_par_m2 as double) as emission_ges_m2
from (select *, row_number() over (partition by numero_dpe order by replica) as rang from dpe_raw) d
where rang = 1
""",
    "dpe_raw",
)
_cte(
    "stg_insee",
    """
select GEO as code_commune, GEO_LABEL as nom_commune, TAB_MEASURE as indicateur,
       TAB_MEASURE_LABEL as libelle_indicateur, cast(TIME_PERIOD as integer) as annee,
       if(CONF_STATUS is not distinct from 'C', null, OBS_VALUE) as valeur,
       CONF_STATUS is not distinct from 'C' as est_secret_statistique, GEO_REF as millesime_geographie
from insee_raw where GEO_OBJECT = 'COM'
""",
    "insee_raw",
)

# A sale is kept when it counts exactly one distinct dwelling tuple and no business premises.
_cte(
    "ventes",
    """
select s.id_mutation, s.date_mutation, cast(year(s.date_mutation) as integer) as annee, s.code_commune,
       s.nom_commune, s.code_departement, h.type_local, h.surface_reelle_bati, h.nombre_pieces_principales,
       s.valeur_fonciere, round(s.valeur_fonciere / h.surface_reelle_bati, 2) as prix_m2,
       coalesce(xy.longitude, s.lon) as longitude, coalesce(xy.latitude, s.lat) as latitude,
       h.surface_reelle_bati >= 9 and s.valeur_fonciere >= 1000
         and s.valeur_fonciere / h.surface_reelle_bati between 200 and 30000 as est_prix_plausible
from (
  select id_mutation, min(date_mutation) as date_mutation, min(valeur_fonciere) as valeur_fonciere,
         min(code_commune) as code_commune, min(nom_commune) as nom_commune,
         min(code_departement) as code_departement, min(longitude) as lon, min(latitude) as lat,
         sum(case when type_local like 'Local industriel%' then 1 else 0 end) as activites
  from stg_dvf where nature_mutation = 'Vente' group by id_mutation
) s
join (
  select id_mutation, max(type_local) as type_local, max(surface_reelle_bati) as surface_reelle_bati,
         max(nombre_pieces_principales) as nombre_pieces_principales, count(*) as nb
  from (select id_mutation, type_local, surface_reelle_bati, nombre_pieces_principales, lot1_numero
        from stg_dvf where nature_mutation = 'Vente' and type_local in ('Maison', 'Appartement')
        group by all) t
  group by id_mutation
) h on h.id_mutation = s.id_mutation
left join (
  select id_mutation, longitude, latitude,
         row_number() over (partition by id_mutation order by longitude, latitude) as rang
  from stg_dvf where nature_mutation = 'Vente' and longitude is not null and latitude is not null
) xy on xy.id_mutation = s.id_mutation and xy.rang = 1
where h.nb = 1 and s.activites = 0 and h.surface_reelle_bati > 0
""",
    "stg_dvf",
)
_cte(
    "dpe_dernier",
    """
select cle_logement, numero_dpe, date_etablissement_dpe, code_commune, nom_commune, code_departement,
       type_batiment, periode_construction, annee_construction, surface_habitable, etiquette_dpe, etiquette_ges,
       conso_energie_primaire_m2, emission_ges_m2,
       etiquette_dpe in ('F', 'G') as est_passoire_thermique,
       etiquette_dpe in ('A', 'B') as est_logement_performant
from (
  select *, row_number() over (partition by cle_logement
                               order by date_etablissement_dpe desc nulls last, numero_dpe desc) as rang
  from (
    select *, concat(ifnull(identifiant_ban, 'sans-adresse-' || numero_dpe), '|', type_batiment, '|',
                     ifnull(cast(round(surface_habitable) as varchar), '?')) as cle_logement
    from stg_dpe
    where (type_batiment = 'maison' or type_batiment = 'appartement') and code_commune is not null
  ) k
) r
where rang = 1
""",
    "stg_dpe",
)


def _indicateur(code: str, name: str) -> str:
    return f"max(case when indicateur = '{code}' then valeur end) as {name}"


_INDICATEURS = {
    "POP": "population",
    "SUP": "superficie_km2",
    "MED_SL": "niveau_vie_median",
    "PR_MD60": "taux_pauvrete",
    "DWELLINGS": "nb_logements",
    "DWELLINGS_OCS_DW_MAIN": "nb_residences_principales",
    "DWELLINGS_OCS_DW_MAIN_TSH_100": "nb_proprietaires",
    "DWELLINGS_OCS_DW_VAC": "nb_logements_vacants",
    "DWELLINGS_OCS_DW_SEC_DW_OCC": "nb_residences_secondaires",
}
_cte(
    "insee_commune",
    f"""
select code_commune, min(nom_commune) as nom_commune, substr(code_commune, 1, 2) as code_departement,
       {', '.join(_indicateur(c, n) for c, n in _INDICATEURS.items())},
       count(*) filter (est_secret_statistique and indicateur = 'MED_SL') > 0 as niveau_vie_sous_secret
from stg_insee i
where annee = (select max(j.annee) from stg_insee j
               where j.code_commune = i.code_commune and j.indicateur = i.indicateur)
group by code_commune
""",
    "stg_insee",
)
_cte(
    "departements",
    """
select * from (values ('02', 'Aisne', '32', 'Hauts-de-France'), ('59', 'Nord', '32', 'Hauts-de-France'),
  ('60', 'Oise', '32', 'Hauts-de-France'), ('62', 'Pas-de-Calais', '32', 'Hauts-de-France'),
  ('80', 'Somme', '32', 'Hauts-de-France')) d(code_departement, nom_departement, code_region, nom_region)
""",
)

# The calendar is compared up to 31 December 2026.
_cte(
    "dim_date",
    """
select d as date, cast(year(d) as integer) as annee, cast(s as integer) as semestre,
       year(d) || '-S' || s as annee_semestre, cast(quarter(d) as integer) as trimestre,
       year(d) || '-T' || quarter(d) as annee_trimestre, cast(month(d) as integer) as mois,
       list_extract(['janvier', 'février', 'mars', 'avril', 'mai', 'juin', 'juillet', 'août', 'septembre',
                     'octobre', 'novembre', 'décembre'], month(d)) as nom_mois,
       list_extract(['janv.', 'févr.', 'mars', 'avr.', 'mai', 'juin', 'juil.', 'août', 'sept.', 'oct.',
                     'nov.', 'déc.'], month(d)) as nom_mois_court,
       substr(cast(d as varchar), 1, 7) as annee_mois,
       cast(replace(substr(cast(d as varchar), 1, 7), '-', '') as integer) as annee_mois_tri,
       make_date(year(d), month(d), 1) as premier_jour_mois, cast(isodow(d) as integer) as jour_semaine,
       list_extract(['lundi', 'mardi', 'mercredi', 'jeudi', 'vendredi', 'samedi', 'dimanche'], isodow(d)) as nom_jour,
       isodow(d) in (6, 7) as est_weekend
from (select cast(t.x as date) as d, case when month(t.x) <= 6 then 1 else 2 end as s
      from range(timestamp '2021-01-01', timestamp '2027-01-01', interval 1 day) t(x)) j
""",
)
_cte(
    "dim_commune",
    f"""
select c.code_commune, c.nom_commune, c.nom_commune || ' (' || c.code_departement || ')' as nom_commune_dep,
       c.code_departement, d.nom_departement, d.nom_region, c.h as est_commune_historique,
       round(g.lat, 5) as latitude, round(g.lon, 5) as longitude,
       i.population, i.superficie_km2, round(i.population / nullif(i.superficie_km2, 0), 1) as densite_hab_km2,
       case when i.population >= 50000 then '4. Plus de 50 000 hab.'
            when i.population >= 10000 then '3. 10 000 à 50 000 hab.'
            when i.population >= 2000 then '2. 2 000 à 10 000 hab.'
            when i.population is not null then '1. Moins de 2 000 hab.' end as taille_commune,
       i.niveau_vie_median, i.niveau_vie_sous_secret, i.taux_pauvrete,
       cast(round(i.nb_logements) as integer) as nb_logements,
       cast(round(i.nb_residences_principales) as integer) as nb_residences_principales,
       cast(round(i.nb_logements_vacants) as integer) as nb_logements_vacants,
       cast(round(i.nb_residences_secondaires) as integer) as nb_residences_secondaires,
       cast(round(i.nb_proprietaires) as integer) as nb_proprietaires
from (
  select code_commune, nom_commune, code_departement, false as h from insee_commune
  where code_departement in {_SCOPE}
  union all
  select code_commune, min(nom_commune), min(code_departement), true
  from (select code_commune, nom_commune, code_departement from stg_dvf
        union select code_commune, nom_commune, code_departement from stg_dpe) f
  where code_departement in {_SCOPE} and code_commune is not null
    and not exists (select 1 from insee_commune x
                    where x.code_commune = f.code_commune and x.code_departement in {_SCOPE})
  group by code_commune
) c
left join departements d on d.code_departement = c.code_departement
left join (select code_commune, quantile_cont(latitude, 0.5) as lat, quantile_cont(longitude, 0.5) as lon
           from stg_dvf where latitude + longitude is not null group by code_commune) g
  on g.code_commune = c.code_commune
left join insee_commune i on i.code_commune = c.code_commune
""",
    "stg_dvf",
    "stg_dpe",
    "insee_commune",
    "departements",
)
_cte(
    "fct_ventes",
    f"""
select id_mutation, date_mutation as date_vente, code_commune, type_local as type_logement,
       surface_reelle_bati as surface_m2, nombre_pieces_principales as nb_pieces, valeur_fonciere as prix,
       prix_m2, latitude, longitude
from ventes where est_prix_plausible and code_departement in {_SCOPE}
""",
    "ventes",
)

_RANG_PERIODE = """ifnull(nullif(list_position(['avant 1948', '1948-1974', '1975-1977', '1978-1982', '1983-1988',
  '1989-2000', '2001-2005', '2006-2012', '2013-2021', 'après 2021'], {c}), 0), 99)"""
_cte(
    "fct_dpe_mensuel",
    f"""
select mois, code_commune, type_logement, p as periode_construction,
       cast({_RANG_PERIODE.format(c='p')} as integer) as periode_construction_tri, etiquette_dpe,
       etiquette_dpe in ('F', 'G') as est_passoire_thermique, count(*) as nb_dpe,
       round(sum(surface_habitable), 1) as surface_totale_m2
from (select cast(strftime(date_etablissement_dpe, '%Y-%m-01') as date) as mois, code_commune,
             type_batiment as type_logement, ifnull(periode_construction, 'inconnue') as p, etiquette_dpe,
             surface_habitable
      from stg_dpe
      where type_batiment <> 'immeuble' and code_departement in {_SCOPE} and date_etablissement_dpe is not null) d
group by mois, code_commune, type_logement, p, etiquette_dpe
""",
    "stg_dpe",
)
_cte(
    "mart_dpe",
    f"""
select code_commune || '-' || type_batiment || '-' || etiquette_dpe || '-' || p as cle, code_commune,
       min(nom_commune) as nom_commune, min(code_departement) as code_departement, type_batiment,
       p as periode_construction, cast({_RANG_PERIODE.format(c='p')} as integer) as periode_construction_tri,
       etiquette_dpe, count(*) as nb_logements
from (select *, ifnull(periode_construction, 'inconnue') as p from dpe_dernier) d
group by code_commune, type_batiment, p, etiquette_dpe
""",
    "dpe_dernier",
)
_cte(
    "mart_prix",
    """
select code_commune || '-' || cast(annee as varchar) || '-' || type_local as cle, code_commune,
       min(nom_commune) as nom_commune, min(code_departement) as code_departement, annee, type_local,
       count(*) as nb_ventes, round(quantile_cont(prix_m2, 0.5), 0) as prix_m2_median,
       round(quantile_cont(prix_m2, 0.25), 0) as prix_m2_q1, round(quantile_cont(prix_m2, 0.75), 0) as prix_m2_q3,
       round(quantile_cont(valeur_fonciere, 0.5), 0) as prix_median,
       round(quantile_cont(surface_reelle_bati, 0.5), 1) as surface_mediane, count(*) >= 5 as est_fiable
from ventes where est_prix_plausible group by code_commune, annee, type_local
""",
    "ventes",
)
_cte(
    "mart_logement",
    f"""
select c.code_commune, c.nom_commune, c.code_departement, c.population, c.superficie_km2,
       round(c.population / nullif(c.superficie_km2, 0), 1) as densite_hab_km2, c.niveau_vie_median,
       c.niveau_vie_sous_secret, c.taux_pauvrete, c.nb_logements,
       round(c.nb_logements_vacants / nullif(c.nb_logements, 0), 4) as part_logements_vacants,
       round(c.nb_residences_secondaires / nullif(c.nb_logements, 0), 4) as part_residences_secondaires,
       round(c.nb_proprietaires / nullif(c.nb_residences_principales, 0), 4) as part_proprietaires,
       ifnull(v.n, 0) as nb_ventes, v.na as nb_ventes_appartement, v.nm as nb_ventes_maison,
       round(v.ma, 0) as prix_m2_median_appartement, round(v.mm, 0) as prix_m2_median_maison,
       round(v.mp, 0) as prix_median_logement, round(v.ms, 1) as surface_mediane_vendue,
       ifnull(v.n, 0) >= 10 as prix_est_fiable,
       round(round(v.mp, 0) / nullif(c.niveau_vie_median, 0), 1) as annees_niveau_vie_pour_acheter,
       ifnull(e.n, 0) as nb_logements_diagnostiques, round(e.pp, 4) as part_passoires_thermiques,
       round(e.pl, 4) as part_logements_performants, round(e.mc, 0) as conso_energie_mediane_m2,
       l.etiquette_dpe as etiquette_dpe_la_plus_frequente, ifnull(e.n, 0) >= 20 as dpe_est_fiable,
       '2024-2025' as periode_dvf
from (select * from insee_commune where code_departement in {_SCOPE}) c
left join (
  select code_commune, count(*) as n, sum(if(type_local = 'Appartement', 1, 0))::bigint as na,
         sum(if(type_local = 'Maison', 1, 0))::bigint as nm,
         quantile_cont(if(type_local = 'Appartement', prix_m2, null), 0.5) as ma,
         quantile_cont(if(type_local = 'Maison', prix_m2, null), 0.5) as mm,
         quantile_cont(valeur_fonciere, 0.5) as mp, quantile_cont(surface_reelle_bati, 0.5) as ms
  from ventes where est_prix_plausible and annee between 2024 and 2025 group by code_commune
) v on v.code_commune = c.code_commune
left join (
  select code_commune, count(*) as n,
         sum(if(est_passoire_thermique, 1, 0)) / nullif(count(est_passoire_thermique), 0) as pp,
         sum(if(est_logement_performant, 1, 0)) / nullif(count(est_logement_performant), 0) as pl,
         quantile_cont(conso_energie_primaire_m2, 0.5) as mc
  from dpe_dernier group by code_commune
) e on e.code_commune = c.code_commune
left join (
  select code_commune, etiquette_dpe, row_number() over (partition by code_commune order by n desc, etiquette_dpe) as rang
  from (select code_commune, etiquette_dpe, count(*) as n from dpe_dernier where etiquette_dpe is not null
        group by code_commune, etiquette_dpe) t
) l on l.code_commune = c.code_commune and l.rang = 1
""",
    "insee_commune",
    "ventes",
    "dpe_dernier",
)


def with_ctes(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named expressions and everything they need, in order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        for need in CTES[name][0]:
            add(need)
        ordered.append(name)

    for name in names:
        add(name)
    if not ordered:
        return sql
    body = ",\n".join(f"{n} as materialized ({CTES[n][1].strip()})" for n in ordered)
    return f"with {body}\n{sql.strip()}"
