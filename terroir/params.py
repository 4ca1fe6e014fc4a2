"""Parameters and fixed values shared by every layer."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

# Fixed values -- scope and reference lists of the public data sets.
DEPARTEMENTS = ("02", "59", "60", "62", "80")
ANNEES_RECENTES = (2024, 2025)
ANNEES_DEBUT = (2021, 2022)
DEBUT_CALENDRIER = dt.date(2021, 1, 1)

SEED_DEPARTEMENTS = (
    ("02", "Aisne", "32", "Hauts-de-France"),
    ("59", "Nord", "32", "Hauts-de-France"),
    ("60", "Oise", "32", "Hauts-de-France"),
    ("62", "Pas-de-Calais", "32", "Hauts-de-France"),
    ("80", "Somme", "32", "Hauts-de-France"),
)

PERIODES_CONSTRUCTION = (
    "avant 1948",
    "1948-1974",
    "1975-1977",
    "1978-1982",
    "1983-1988",
    "1989-2000",
    "2001-2005",
    "2006-2012",
    "2013-2021",
    "après 2021",
)
PERIODE_INCONNUE = "inconnue"
RANG_PERIODE_INCONNUE = 99

TYPES_DVF = ("Maison", "Appartement")
TYPE_ACTIVITE = "Local industriel. commercial ou assimilé"
TYPES_DPE = ("maison", "appartement")
ETIQUETTES = ("A", "B", "C", "D", "E", "F", "G")
ETIQUETTES_PASSOIRE = ("F", "G")
ETIQUETTES_PERFORMANT = ("A", "B")

NATURE_VENTE = "Vente"
NATURES_MUTATION = (
    "Vente",
    "Vente en l'état futur d'achèvement",
    "Vente terrain à bâtir",
    "Adjudication",
    "Expropriation",
    "Echange",
)

# Fixed values -- census measure code and output column.
INDICATEURS_INSEE = (
    ("POP", "population"),
    ("SUP", "superficie_km2"),
    ("MED_SL", "niveau_vie_median"),
    ("PR_MD60", "taux_pauvrete"),
    ("DWELLINGS", "nb_logements"),
    ("DWELLINGS_OCS_DW_MAIN", "nb_residences_principales"),
    ("DWELLINGS_OCS_DW_MAIN_TSH_100", "nb_proprietaires"),
    ("DWELLINGS_OCS_DW_VAC", "nb_logements_vacants"),
    ("DWELLINGS_OCS_DW_SEC_DW_OCC", "nb_residences_secondaires"),
)
INDICATEUR_NIVEAU_VIE = "MED_SL"

# Fixed values -- names of months and days, size classes of communes.
MOIS = (
    "janvier", "février", "mars", "avril", "mai", "juin",
    "juillet", "août", "septembre", "octobre", "novembre", "décembre",
)
MOIS_COURTS = (
    "janv.", "févr.", "mars", "avr.", "mai", "juin",
    "juil.", "août", "sept.", "oct.", "nov.", "déc.",
)
JOURS = ("lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche")

TAILLES_COMMUNE = (
    (2000, "1. Moins de 2 000 hab."),
    (10000, "2. 2 000 à 10 000 hab."),
    (50000, "3. 10 000 à 50 000 hab."),
)
TAILLE_MAX = "4. Plus de 50 000 hab."

# Fixed values -- plausibility limits of a dwelling sale.
SURFACE_MIN = 9
PRIX_MIN = 1000
PRIX_M2_MIN = 200
PRIX_M2_MAX = 30000

# Fixed values -- colours and thresholds of the report.
VERT, ORANGE, ROUGE = "#1D7A3A", "#E58606", "#B3261E"
SEUIL_ACCES_ROUGE, SEUIL_ACCES_ORANGE = 8, 6
BORNES_CARTE = (1300.0, 2600.0)

# Fixed values -- minimum counts behind the reliability flags and the report filters.
MIN_VENTES_CELLULE = 5
MIN_VENTES_COMMUNE = 10
MIN_DPE_COMMUNE = 20
MIN_VENTES_CARTE = 20
MIN_VENTES_CLASSEMENT = 30

# Fixed values -- texts of the report.
LIBELLE_PERIODE_COMPLETE = "2021-2025"
SOURCE_INSEE = "INSEE, revenus 2023"
TITRE_PRIX_M2 = "Prix médian au m²"
TITRE_VENTES = "Ventes de logements"
TITRE_PRIX = "Prix médian d'un logement"
TITRE_PASSOIRES = "Passoires (F-G) parmi les DPE"
TITRE_MOIS = "Ventes par mois"
SOUS_TITRE_MOIS = " · le trait bleu foncé indique le même mois en "


@dataclass(frozen=True)
class Params:
    """Scope of one build: departments, recent years and the calendar's reference day."""

    departements: tuple[str, ...] = DEPARTEMENTS
    annees_recentes: tuple[int, ...] = ANNEES_RECENTES
    annees_debut: tuple[int, ...] = ANNEES_DEBUT
    debut_calendrier: dt.date = DEBUT_CALENDRIER
    as_of: dt.date | None = None

    @property
    def fin_calendrier(self) -> dt.date:
        """31 December of the reference year (today's year when ``as_of`` is unset)."""
        return dt.date((self.as_of or dt.date.today()).year, 12, 31)

    @property
    def periode_dvf(self) -> str:
        return f"{self.annees_recentes[0]}-{self.annees_recentes[-1]}"


@dataclass(frozen=True)
class Contexte:
    """Report slicers: ``None`` means "all"."""

    annees: tuple[int, ...] | None = None
    departements: tuple[str, ...] | None = None
    types: tuple[str, ...] | None = None
    communes: tuple[str, ...] | None = None

    def sur(self, annees: tuple[int, ...]) -> Contexte:
        """The same slicers over other years."""
        return replace(self, annees=annees)
