"""Code lists and table layouts of the traffic-count domain."""

from __future__ import annotations

#: The 24 columns of hourly counts.
HOURS = [f"h{h}_{h + 1}" for h in range(24)]
#: The twelve month keys.
MONTHS = ["janv", "fevr", "mars", "avri", "mai", "juin", "juil", "aout", "sept", "octo", "nove", "dece"]
#: Days of the week.
DAYS = ["lundi", "mardi", "mercredi", "jeudi", "vendredi", "samedi", "dimanche"]
#: Kinds of vehicles, kinds of counters, and the number that stands for an invalid value.
VEHICLES = ["TV", "VL", "PL", "2R"]
POST_TYPES = ["permanent", "tournant", "ponctuel"]
INVALID = -99
#: Allowed speed limits in km/h, and the limit of heavy vehicles where the car's is given.
SPEED_LIMITS = [30, 50, 60, 70, 80, 90, 100, 110, 130]
HEAVY_LIMIT = {130: 90, 110: 90, 100: 80, 90: 80}
#: School holidays (start, end); the reference calendar is not public, so this is a table of our own.
HOLIDAYS = [
    *[(f"{y}-02-10", f"{y}-02-25") for y in range(1992, 2026)],
    *[(f"{y}-07-01", f"{y}-08-31") for y in range(1992, 2026)],
    *[(f"{y}-12-20", f"{y}-12-31") for y in range(1992, 2026)],
]
#: The stored tables and their columns.
TABLES = {
    "compteur": ["id_comptag", "dep", "route", "pr", "abs", "gestionnai", "type_poste", "src_geo", "x_l93", "y_l93", "fictif", "concession", "convention"],
    "comptage": ["id_comptag", "annee", "periode", "src", "obs", "type_veh"],
    "indic_agrege": ["id_comptag_uniq", "indicateur", "valeur", "fichier"],
    "indic_mensuel": ["id_comptag_uniq", "indicateur", "mois", "valeur", "fichier"],
    "indic_horaire": ["id_comptag_uniq", "jour", "indicateur", *HOURS, "fichier"],
    "corresp_id_comptag": ["id_gest", "id_gti"],
}
