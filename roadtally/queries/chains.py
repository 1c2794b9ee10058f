"""Whole chains and provider layouts, registered beside the single operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import standins as S
from ..plans import chains, layouts
from ..schemas import HOURS, MONTHS
from ..scratch import materialise
from . import aggregations  # noqa: F401  (its steps)
from .registry import STEPS, query
from .spatial import _NEAREST

_ZEROS = " + ".join(f"CAST({h} = 0 AS INTEGER)" for h in HOURS)
_TOTAL = " + ".join(HOURS)
_MONTH = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"
_KEPT = f"""
bad AS (SELECT DISTINCT jour, id_comptag FROM hw WHERE {_ZEROS} > 22),
k1 AS (SELECT * FROM hw WHERE (jour, id_comptag) NOT IN (SELECT (jour, id_comptag) FROM bad)),
k2 AS (SELECT * FROM k1 WHERE (jour, id_comptag) NOT IN (SELECT (jour, id_comptag) FROM k1 GROUP BY jour, id_comptag HAVING count(*) = 2 AND count(*) FILTER (WHERE indicateur = 'VL') = 1 AND count(*) FILTER (WHERE indicateur = 'PL') = 1)),
asy AS (SELECT id_comptag FROM (SELECT id_comptag, jour, indicateur, sum(CASE WHEN sens = 1 THEN {_TOTAL} END) AS a, sum(CASE WHEN sens = 2 THEN {_TOTAL} END) AS b FROM k2 GROUP BY 1, 2, 3) WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY 1 HAVING count(*) FILTER (WHERE a > 3 * b OR b > 3 * a) > count(*) / 10),
k3 AS (SELECT * FROM k2 WHERE id_comptag NOT IN (SELECT id_comptag FROM asy))"""


@query(f"""
WITH {_KEPT}
SELECT DISTINCT id_comptag, 'jours invalides' AS reason FROM bad UNION ALL SELECT id_comptag, 'asymetrie' FROM asy
UNION ALL SELECT id_comptag, 'accepte' FROM k3 GROUP BY 1 HAVING count(DISTINCT jour) >= 7""")
def chain_hourly_report(spark, d):
    return chains.hourly_to_indicators(S.hw(spark, d), most_zeros=22)["rapport"]


def _after_checks(step: str) -> str:
    """The SQL of a step over the rows that the checks leave."""
    kept = "SELECT * FROM k3 WHERE id_comptag IN (SELECT id_comptag FROM k3 GROUP BY 1 HAVING count(DISTINCT jour) >= 7)"
    return f"SELECT * FROM (WITH {_KEPT}, kept AS ({kept}) SELECT * FROM (WITH hw AS (SELECT * FROM kept) SELECT * FROM ({STEPS[step]})))"


def hourly(table: str, step: str) -> None:
    """Registers one table of the hourly chain."""

    def run(spark, d):
        return chains.hourly_to_indicators(S.hw(spark, d), most_zeros=22)[table]

    run.__name__ = f"chain_hourly_{table}"
    query(_after_checks(step))(run)


hourly("horaire", "agg_directions")
hourly("annuel", "agg_tmja_from_hourly")
hourly("mensuel", "agg_monthly_from_hourly")
hourly("periode", "agg_period_from_hourly")

#: Campaigns with enough days, their ends folded: as the chain's own passages.
_FOLDED = """
e AS (SELECT id_comptag, min(date_heure) AS a, max(date_heure) AS b, count(DISTINCT CAST(date_heure AS DATE)) AS n FROM campagnes GROUP BY 1),
f AS (SELECT c.*, n, CAST(a AS DATE) AS ja, CAST(b AS DATE) AS jb, CAST(b AS TIME) AS tb, CAST(date_heure AS DATE) AS j, CAST(date_heure AS TIME) AS t
      FROM campagnes c JOIN e USING (id_comptag) WHERE n > 8 OR n = 8 AND CAST(a AS TIME) <= CAST(b AS TIME)),
folded AS (SELECT event_id, id_comptag, sens, CASE WHEN n = 8 AND j = jb THEN date_heure - to_days(jb - ja) ELSE date_heure END AS date_heure, type_veh, vitesse, nb_veh
      FROM f WHERE NOT (n > 8 AND (j = ja OR j = jb) OR n = 8 AND j = ja AND t <= tb))"""


def vehicles(table: str, step: str) -> None:
    """Registers one table of the vehicle chain."""

    def run(spark, d):
        return chains.vehicles_to_week(S.campagnes(spark, d))[table]

    run.__name__ = f"chain_vehicles_{table}"
    query(f"SELECT * FROM (WITH {_FOLDED} SELECT * FROM (WITH passages AS (SELECT * FROM folded) SELECT * FROM ({STEPS[step]})))")(run)


vehicles("semaine", "agg_average_week")
vehicles("profil_horaire", "agg_hourly_profile")
vehicles("periodes", "agg_peak_periods")
vehicles("jours_charges", "agg_busiest_day")
vehicles("indicateurs", "agg_fim_indicators")


@query(f"""
SELECT id_comptag, sens, jour, indicateur, {', '.join(f"CAST(count(*) FILTER (WHERE h = {k}) AS BIGINT) AS {c}" for k, c in enumerate(HOURS))} FROM (
  SELECT id_comptag, sens, CAST(date_heure AS DATE) AS jour, hour(date_heure) AS h, unnest(CASE WHEN type_veh = 'PL' THEN ['TV', 'PL'] ELSE ['TV'] END) AS indicateur FROM passages) GROUP BY ALL""")
def chain_individual_to_hourly(spark, d):
    h = chains.individual_to_hourly(S.passages(spark, d), ["id_comptag", "sens", "jour"])
    return h.where(sum((F.col(c) for c in HOURS), F.lit(0)) > 0)  # days that only zero-filling made are left out


@query(f"""
WITH n AS (SELECT c.*, m.gid, m.distance FROM compteur c JOIN {_NEAREST} m USING (id_comptag)),
p AS (SELECT *, CASE type_poste WHEN 'permanent' THEN 3 WHEN 'tournant' THEN 2 ELSE 1 END AS rang FROM n WHERE dep % 2 = 0),
r AS (SELECT gid, arg_min(id_comptag, (-rang, CASE WHEN pr % 2 = 0 THEN -1 ELSE -2 END, -tmja, -pc_pl, id_comptag)) AS id_ref FROM p GROUP BY 1),
t AS (SELECT gid, arg_min(id_comptag, (distance, id_comptag)) AS id_db FROM n WHERE dep % 2 = 1 GROUP BY 1),
k AS (SELECT id_comptag AS id_db, type_poste AS type_db, CASE type_poste WHEN 'permanent' THEN 3 WHEN 'tournant' THEN 2 ELSE 1 END AS rang_db, pr AS pr_db FROM compteur)
SELECT p.id_comptag, p.gid, r.id_ref, t.id_db, CASE
  WHEN p.id_comptag <> r.id_ref THEN 'associe' WHEN t.id_db IS NULL THEN 'nouveau' WHEN p.pr % 3 = 0 AND type_poste = type_db THEN 'correspondance'
  WHEN rang < rang_db THEN 'associe' WHEN rang > rang_db THEN 'nouveau, ancien associe' WHEN rang = 1 AND p.pr % 2 = 0 THEN 'associe' WHEN rang = 1 THEN 'nouveau, ancien associe'
  WHEN p.pr <> pr_db THEN 'nouveau, ancien associe' ELSE 'nouveau' END AS classe
FROM p JOIN r USING (gid) LEFT JOIN t USING (gid) LEFT JOIN k USING (id_db)
UNION ALL SELECT id_comptag, NULL, NULL, NULL, 'loin' FROM compteur WHERE dep % 2 = 0 AND id_comptag NOT IN (SELECT id_comptag FROM p)""")
def chain_place_new_points(spark, d):
    c = S.compteur(spark, d).withColumn("vacances", F.col("pr") % 2 == 0)
    return chains.place_new_points(c.where("dep % 2 = 0"), c.where("dep % 2 = 1"), S.sections(spark, d), 30.0, F.col("pr") % 3 == 0, F.col("pr") == F.col("pr_db"), cell=100.0)


@query("SELECT dep || '-' || route || '-' || pr || '+' || abs AS id_comptag, route, pr, abs, tmja, pc_pl, 'TV' AS type_veh FROM compteur")
def layout_annual_by_marker(spark, d):
    c = S.compteur(spark, d).select("dep", F.concat(F.lit("R"), "route").alias("axe"), F.concat_ws("+", F.col("pr").cast("string"), F.col("abs").cast("string")).alias("localisation"), F.col("tmja").alias("trafic"), F.col("pc_pl").alias("part_pl"))
    return layouts.shape_table(c, layouts.ANNUAL_BY_MARKER)


@query("SELECT '17-' || route || '-' || (tmja // 1000) || '+' || (tmja % 1000) AS id_comptag, route, CAST(tmja // 1000 AS INTEGER) AS pr, tmja % 1000 AS abs, tmja, CASE WHEN pc_pl / 100 < 1 THEN pc_pl / 100 * 100 ELSE pc_pl / 100 END AS pc_pl FROM compteur")
def layout_annual_by_metres(spark, d):
    from dataclasses import replace

    c = S.compteur(spark, d).select(F.col("route").alias("axe"), F.col("tmja").alias("distance"), F.col("tmja").alias("trafic"), (F.col("pc_pl") / 100).alias("part_pl"))
    return layouts.shape_table(c, replace(layouts.ANNUAL_BY_METRES, dep=17))


@query("SELECT '24-D' || (id % 30) || '-' || (id % 50) || '+' || 0 AS id_comptag, 'D' || (id % 30) AS route, id % 50 AS pr, 0 AS abs, tmja, pc_pl, periode, 'ponctuel' AS type_poste FROM comptage WHERE month(debut) NOT IN (7, 8) AND month(fin) NOT IN (7, 8)")
def layout_one_off_counts(spark, d):
    from dataclasses import replace

    c = S.comptage(spark, d).select(F.concat(F.lit("d 0"), (F.col("id") % 30).cast("string")).alias("axe"), (F.col("id") % 50).cast("string").alias("localisation"), F.col("tmja").alias("trafic"), F.col("pc_pl").alias("part_pl"), "debut", "fin")
    return layouts.shape_table(c, replace(layouts.ONE_OFF_COUNTS, dep=24))


@query(f"SELECT id_comptag, annee, ({_MONTH})[3 * q + k] AS mois, 'tmja' AS indicateur, CAST(tmja + q AS DOUBLE) AS valeur FROM annuel, (VALUES (0), (1), (2), (3)) AS x(q), (VALUES (1), (2), (3)) AS y(k) WHERE q < 3 OR annee % 2 = 0")
def layout_quarters(spark, d):
    a = S.annuel(spark, d).select("id_comptag", "annee", *[F.when((F.col("annee") % 2 == 0) | F.lit(q < 3), F.col("tmja") + q).alias(f"t{q + 1}") for q in range(4)])
    return layouts.monthly_table(a, layouts.QUARTERS, ["id_comptag", "annee"])


@query(f"""
SELECT id, mois, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([CAST(t AS DOUBLE), CAST(pc_pl AS DOUBLE)]) AS valeur
FROM (SELECT id, tmja + k AS t, pc_pl, ({_MONTH})[month(CASE WHEN date_trunc('month', a) = date_trunc('month', a + 7) OR CAST(date_trunc('month', a + 7) AS DATE) - a >= (a + 7) - CAST(date_trunc('month', a + 7) AS DATE) + 1 THEN a ELSE a + 7 END)] AS mois
      FROM (SELECT id, tmja, pc_pl, k, debut + 80 * CAST(k AS INTEGER) AS a FROM comptage, range(4) AS r(k) WHERE k < 3 OR id % 2 = 0))""")
def layout_four_periods(spark, d):
    text = lambda c: F.date_format(c, "yyyy/MM/dd")
    period = lambda k: F.concat(text(F.date_add("debut", 80 * k)), F.lit("-"), text(F.date_add("debut", 80 * k + 7)))
    c = S.comptage(spark, d).select("id", *[x for k in range(4) for x in (F.when((F.col("id") % 2 == 0) | F.lit(k < 3), period(k)).alias(f"periode_{k + 1}"), (F.col("tmja") + k).alias(f"tmja_{k + 1}"), F.col("pc_pl").alias(f"pc_pl_{k + 1}"))])
    return layouts.monthly_table(c, layouts.FOUR_PERIODS, ["id"])


@query(f"SELECT id_comptag, annee, ({_MONTH})[mois] AS mois, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([CAST(tmja AS DOUBLE), pc_pl]) AS valeur FROM mensuel")
def layout_twelve_months(spark, d):
    one = lambda k, c: F.max(F.when(F.col("mois") == k, F.col(c)))
    m = S.mensuel(spark, d).groupBy("id_comptag", "annee").agg(*[one(k, c).cast("double").alias(f"{x}_{c}") for k, x in enumerate(MONTHS, 1) for c in ("tmja", "pc_pl")])
    return layouts.monthly_table(m, layouts.TWELVE_MONTHS, ["id_comptag", "annee"])


@query(f"""
SELECT id_comptag, annee, ({_MONTH})[mois] AS mois, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([CAST(vl + pl AS DOUBLE), CAST(round(pl / (vl + pl) * 100, 2) AS DOUBLE)]) AS valeur
FROM (SELECT id_comptag, annee, month(jour) AS mois, sum(valeur) FILTER (WHERE indicateur = 'VL') AS vl, sum(valeur) FILTER (WHERE indicateur = 'PL') AS pl FROM horaire GROUP BY ALL) WHERE vl + pl IS NOT NULL""")
def layout_light_and_heavy_months(spark, d):
    h = S.horaire(spark, d).withColumn("mois", F.month("jour"))
    one = lambda k, i: F.sum(F.when((F.col("mois") == k) & (F.col("indicateur") == i), F.col("valeur")))
    m = h.groupBy("id_comptag", "annee").agg(*[one(k, i.upper()).cast("double").alias(f"{x}_{i}") for k, x in enumerate(MONTHS, 1) for i in ("vl", "pl")])
    return layouts.monthly_table(m, layouts.LIGHT_AND_HEAVY_MONTHS, ["id_comptag", "annee"])


@query("""
SELECT '79-D' || (id % 30) || '-' || (id % 50) || '+' || 0 AS id_comptag, 'D' || (id % 30) AS route, id % 50 AS pr, 0 AS abs, tmja, pc_pl,
       strftime(date_trunc('week', debut), '%Y/%m/%d') || '-' || strftime(CAST(date_trunc('week', debut) AS DATE) + 6, '%Y/%m/%d') AS periode, 'tournant' AS type_poste FROM comptage""")
def layout_by_iso_week(spark, d):
    from dataclasses import replace

    c = S.comptage(spark, d).select(F.concat(F.lit("d 0"), (F.col("id") % 30).cast("string")).alias("axe"), (F.col("id") % 50).cast("string").alias("localisation"), F.col("tmja").alias("trafic"), F.col("pc_pl").alias("part_pl"), F.extract(F.lit("YEAROFWEEK"), F.col("debut")).cast("int").alias("annee"), F.weekofyear("debut").alias("semaine"))
    return layouts.shape_table(c, replace(layouts.BY_ISO_WEEK, dep=79))


@query("""
WITH b AS (SELECT s_suppkey // 2 AS k, s_suppkey, b, h, s_suppkey + h + 100 AS tv, s_nationkey AS pl FROM supplier, range(3) AS x(b), range(24) AS y(h))
SELECT 'C' || k AS id_comptag, DATE '2021-03-01' + CAST(b AS INTEGER) AS jour, CAST(sum(tv) AS DOUBLE) AS tv, count(DISTINCT s_suppkey) AS fichiers, CAST(sum(pl) AS DOUBLE) AS pl, round(sum(pl) / sum(tv) * 100, 2) AS pc_pl FROM b GROUP BY k, b""")
def layout_day_blocks(spark, d):
    """A sheet of each supplier is a direction of a counter: three days in blocks of 30 lines."""
    s = S.table(spark, d, "supplier").withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(2)))).withColumn("h", F.explode(F.sequence(F.lit(0), F.lit(23)))).withColumn("col", F.explode(F.array(F.lit(0), F.lit(1))))
    value = F.when(F.col("col") == 0, F.col("s_suppkey") + F.col("h") + 100).otherwise(F.col("s_nationkey")).cast("string")
    k = F.floor(F.col("s_suppkey") / 2).cast("string")
    cells = s.select(F.concat(F.lit("C"), k).alias("id_comptag"), F.lit("2021-03-01").cast("date").alias("jour0"), F.concat(F.lit("f"), F.col("s_suppkey").cast("string")).alias("file"), (5 + 30 * F.col("b") + F.col("h")).alias("line"), "col", value.alias("value"))
    return layouts.day_blocks(cells, 5, 30)


@query("""
SELECT '19-D' || (id % 30 + 1) || '-' || (id % 50) || '+' || (id % 90) AS id_comptag, 'D' || (id % 30 + 1) AS route, CAST(id % 50 AS INTEGER) AS pr, CAST(id % 90 AS INTEGER) AS abs, tmja, CAST(pc_pl AS DOUBLE) AS pc_pl, 'tournant' AS type_poste
FROM comptage WHERE id % 11 > 0 AND id % 13 > 0 AND id % 17 > 0 AND tmja > 0""")
def layout_cells(spark, d):
    """Traffic and share on two lines of a cell; some cells are empty or crossed out, some markers missing."""
    from dataclasses import replace

    text = lambda c: F.col(c).cast("string") if isinstance(c, str) else c.cast("string")
    cell = F.concat(text("tmja"), F.lit("\n"), F.replace(text("pc_pl"), F.lit("."), F.lit(",")), F.lit("%"))
    k = F.col("id")
    c = S.comptage(spark, d).select(
        F.concat(F.lit("D "), text(k % 30 + 1)).alias("rd"), F.when(k % 17 > 0, F.concat(text(k % 50), F.lit("+"), F.lpad(text(k % 90), 4, "0"))).alias("p_r"),
        F.when(k % 11 == 0, None).when(k % 13 == 0, "x").otherwise(cell).alias("cellule"),
    )
    return layouts.shape_table(c, replace(layouts.ANNUAL_CELLS, dep=19))


@query(f"""
WITH m AS (SELECT *, CAST(substr(id_comptag, 2) AS INTEGER) AS k, ({_MONTH})[mois] AS cle FROM mensuel),
v AS (SELECT annee, k, cle, CASE WHEN k % 3 > 0 THEN 2 * tmja + 1 ELSE 2 * tmja END AS t, CASE WHEN k % 3 > 0 THEN pc_pl + 0.5 ELSE pc_pl END AS p FROM m)
SELECT annee AS feuille, k || '-N' || (k % 7 + 1) || '-' || k || '+0' AS id_comptag, cle AS mois, 'tmja' AS indicateur, CAST(trunc(t) AS DOUBLE) AS valeur, CASE WHEN k % 3 = 0 THEN '1 seul sens *2' END AS obs FROM v
UNION ALL SELECT annee, k || '-N' || (k % 7 + 1) || '-' || k || '+0', cle, 'pc_pl', round(CAST(p AS DOUBLE), 2), NULL FROM v WHERE p > 0""")
def layout_monthly_sheets(spark, d):
    """A sheet a year; a counter has two lines, or four: a road's and a marker's of each direction."""
    k = F.substring("id_comptag", 2, 9).cast("int")
    one = lambda n, c: F.max(F.when(F.col("mois") == n, F.col(c)))
    wide = S.mensuel(spark, d).groupBy("annee", k.alias("k")).agg(*[one(n, c).cast("double").alias(f"{c}_{m}") for n, m in enumerate(MONTHS, 1) for c in ("tmja", "pc_pl")])
    side = F.explode(F.when(F.col("k") % 3 > 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    kind = F.explode(F.array(F.lit(0), F.lit(1)))
    lines = wide.withColumn("side", side).withColumn("kind", kind)
    text = F.col("k").cast("string")
    road = F.concat(F.lit("RN "), (F.col("k") % 7 + 1).cast("string"))
    value = lambda m: F.when(F.col("kind") == 0, F.col(f"tmja_{m}") + F.col("side")).otherwise((F.col(f"pc_pl_{m}") + F.col("side")) / 100)
    first = F.col("kind") == 0
    return layouts.monthly_sheets(lines.select(
        F.col("annee").alias("feuille"), (F.col("k") * 10 + F.col("side") * 2 + F.col("kind")).alias("ligne"), F.when(first, text).alias("intitule"),
        F.when(first, road).otherwise(F.concat(text, F.lit(" + 0"))).alias("route"), F.when(first, 1000.0).otherwise(0.1).alias("annuel"), *[value(m).alias(m) for m in MONTHS],
    ))


def sheets_of_loops(spark, d):
    """A sheet a counter, year and direction: title, hours from the last to the first, days with the date on their first line, an empty line, the means."""
    h = S.hw(spark, d).withColumn("k", F.substring("id_comptag", 2, 9).cast("int"))
    h = h.withColumn("feuille", F.concat_ws("-", "id_comptag", F.col("annee").cast("string"), F.col("sens").cast("string")))
    lost = (F.col("k") + F.col("annee")) % 5 == 0
    hours = [(F.when(lost, "").otherwise(F.col(c).cast("string")) if k == 5 else F.col(c).cast("string")) for k, c in reversed(list(enumerate(HOURS)))]
    w = Window.partitionBy("feuille").orderBy("jour", F.desc("indicateur"))
    day = F.when(F.coalesce(F.lag("jour").over(w) != F.col("jour"), F.lit(True)), F.col("jour").cast("string"))
    rows = h.select("feuille", "k", (4 + F.row_number().over(w)).alias("ligne"), F.array(day, F.when(F.col("indicateur") == "VL", "TV").otherwise("PL"), *hours).alias("cells"))
    text = F.col("k").cast("string")
    sheet = rows.groupBy("feuille", "k").agg(F.max("ligne").alias("last"))
    line = lambda at, *cells: F.struct(at.cast("int").alias("ligne"), F.array(*[c.cast("string") for c in cells]).alias("cells"))
    lit = F.lit
    others = F.array(
        line(lit(0), F.concat(lit("voie_"), text), F.concat(lit("B"), text)), line(lit(4), lit("jour"), lit("type"), *[lit(f"{k}-{k + 1}h") for k in reversed(range(24))]),
        line(F.col("last") + 1, lit(None)), line(F.col("last") + 2, lit("Moyenne Jours")),
    )
    # the sheets are written once, as a delivery is
    lines = materialise(rows.select("feuille", "ligne", "cells").union(sheet.select("feuille", F.explode(others).alias("l")).select("feuille", "l.*")), "sheets")
    n = S.table(spark, d, "supplier").select((F.col("s_suppkey") % 20).alias("k")).distinct().where("k % 3 < 2")
    text = F.col("k").cast("string")
    known = n.select(F.when(F.col("k") % 3 == 0, F.concat(F.lit("B"), text)).alias("cle1"), F.when(F.col("k") % 3 == 1, F.concat(F.lit("voie "), text)).alias("cle2"), F.concat(F.lit("Z"), text).alias("id_comptag"))
    return layouts.hourly_sheets(lines, known, most_zeros=23)


_SHEETS = "(SELECT *, id_comptag || '-' || annee || '-' || sens AS feuille, CAST(substr(id_comptag, 2) AS INTEGER) AS k FROM hw)"


@query(f"SELECT feuille, 'Z' || k AS id_comptag, jour, CASE indicateur WHEN 'VL' THEN 'TV' ELSE 'PL' END AS indicateur, {', '.join(HOURS)} FROM {_SHEETS} WHERE k % 3 < 2 AND (k + annee) % 5 > 0")
def layout_hourly_sheets(spark, d):
    return sheets_of_loops(spark, d)["horaire"]


@query(f"SELECT DISTINCT feuille, CASE WHEN k % 3 = 2 THEN 'boucle inconnue' ELSE 'trop de nuls ou de zeros' END AS motif FROM {_SHEETS} WHERE k % 3 = 2 OR (k + annee) % 5 = 0")
def layout_hourly_sheets_refused(spark, d):
    return sheets_of_loops(spark, d)["rejets"]


@query("""
WITH p AS (SELECT id, 'Z' || z AS zone, annee, debut, tmja, pc_pl, 'Rue ' || z AS voie, z + 2.0 * (q % (1 + z // 5 % 3)) AS x, CAST(z AS DOUBLE) AS y,
    CASE WHEN z % 5 = 0 AND q % 7 = 0 THEN 'Double' WHEN z % 5 = 3 OR z % 5 = 4 AND q % 2 = 0 THEN 'Detecteur' ELSE 'Simple' END AS type
  FROM (SELECT *, id % 300 AS z, id // 300 AS q FROM comptage)),
n AS (SELECT zone, bool_or(type = 'Double') AS dbl, bool_and(type = 'Simple') AS smp, count(DISTINCT x) FILTER (WHERE type = 'Simple') AS ns, count(DISTINCT x) FILTER (WHERE type = 'Detecteur') AS nd, max(type) = 'Detecteur' AS det FROM p GROUP BY 1),
c AS (SELECT zone, CASE WHEN dbl THEN 'double' WHEN ns IN (1, 2) THEN CASE WHEN smp THEN 'simple ' ELSE 'mixte ' END || ns WHEN det AND nd = 1 THEN 'detecteur' END AS cas FROM n),
u AS (SELECT p.*, cas, cas LIKE '% 2' AS paire FROM p JOIN c USING (zone) WHERE type = CASE cas WHEN 'double' THEN 'Double' WHEN 'detecteur' THEN 'Detecteur' ELSE 'Simple' END AND cas IS NOT NULL),
a AS (SELECT zone, cas, paire, annee, CAST(CASE WHEN paire THEN sum(tmja) ELSE max(tmja) END AS BIGINT) AS tmja, round(CASE WHEN paire THEN avg(pc_pl) ELSE arg_max(pc_pl, (tmja, debut, id)) END, 4) AS pc_pl FROM u GROUP BY zone, cas, paire, annee),
g AS (SELECT zone, CASE WHEN any_value(paire) THEN (min(x) + max(x)) / 2 ELSE min(x) END AS x, min(y) AS y, min(voie) AS voie, count(DISTINCT CASE WHEN annee BETWEEN 1993 AND 1997 THEN annee END) AS ans FROM u GROUP BY 1)
SELECT zone, 'LimMet-' || lower(voie) || printf('-%.3f;%.3f', x, y) AS id_comptag, cas, paire AS fictif, x, y, CASE WHEN ans = 5 THEN 'permanent' WHEN ans >= 3 THEN 'tournant' ELSE 'ponctuel' END AS type_poste,
       CASE WHEN annee < 1995 THEN 'autr' ELSE CAST(annee AS VARCHAR) END AS periode, annee, tmja, pc_pl
FROM a JOIN g USING (zone) WHERE annee >= 1995 OR (zone, annee) IN (SELECT (zone, max(annee)) FROM a WHERE annee < 1995 GROUP BY zone)""")
def layout_zones_by_year(spark, d):
    """Zones of one to three positions, of each kind of point and of several."""
    z, q = F.col("id") % 300, F.floor(F.col("id") / 300)
    kind = F.when((z % 5 == 0) & (q % 7 == 0), "Double").when((z % 5 == 3) | (z % 5 == 4) & (q % 2 == 0), "Detecteur").otherwise("Simple")
    text = z.cast("string")
    p = S.comptage(spark, d).select(
        "id", F.concat(F.lit("Z"), text).alias("zone"), kind.alias("type"), (z + 2.0 * (q % (1 + F.floor(z / 5) % 3))).alias("x"), z.cast("double").alias("y"),
        "annee", "debut", "tmja", "pc_pl", F.concat(F.lit("Rue "), text).alias("voie"),
    )
    return layouts.zones_by_year(p, since=1995, span=(1993, 1997))


def classified(spark, d):
    """Counters of even départements under a provider's id, some of them mapped; the others are stored."""
    c, k = S.compteur(spark, d), F.substring("id_comptag", 2, 9)
    new = c.where("dep % 2 = 0").select(F.concat(F.lit("G"), k).alias("id_comptag"), "x", "y", "tmja")
    mapping = S.table(spark, d, "customer").select(F.concat(F.lit("G"), (F.col("c_custkey") * 4).cast("string")).alias("id_gest"), S.counter(F.col("c_custkey")).alias("id_gti"))
    return chains.classify(new, c.where("dep % 2 = 1"), mapping, S.sections(spark, d), 30.0, cell=100.0)


_CLASSIFIED = f"""
n AS (SELECT CAST(substr(c.id_comptag, 2) AS INTEGER) AS k, c.tmja, m.gid FROM compteur c LEFT JOIN {_NEAREST} m USING (id_comptag) WHERE c.dep % 2 = 0),
i AS (SELECT n.*, coalesce('C' || c_custkey, 'G' || k) AS un FROM n LEFT JOIN customer ON c_custkey * 4 = k),
s AS (SELECT id_comptag FROM compteur WHERE dep % 2 = 1),
t AS (SELECT gid, arg_min(id_comptag, (distance, id_comptag)) AS id_gti FROM {_NEAREST} JOIN s USING (id_comptag) GROUP BY 1),
f AS (SELECT un AS id_gest, id_gti FROM i JOIN t USING (gid) WHERE un NOT IN (SELECT id_comptag FROM s))"""


@query(f"WITH {_CLASSIFIED} SELECT id_gest, id_gti FROM f")
def chain_classify_mapping(spark, d):
    return classified(spark, d)["correspondances"]


@query(f"WITH {_CLASSIFIED} SELECT coalesce(id_gti, un) AS id_comptag, tmja, coalesce(id_gti, un) IN (SELECT id_comptag FROM s) AS connu FROM i LEFT JOIN f ON un = id_gest")
def chain_classify_counts(spark, d):
    return classified(spark, d)["comptages"].select("id_comptag", "tmja", "connu")


def city(spark, d):
    p = S.passages(spark, d).withColumn("fichier", F.concat("id_comptag", F.lit("_"), "sens", F.lit(".csv")))
    files = p.select("fichier", F.concat(F.lit("Ville-"), "id_comptag").alias("id_comptag"), "sens").distinct()
    return chains.city_files(p.select("fichier", "date_heure", "type_veh"), files)


@query(f"""
SELECT 'Ville-' || id_comptag AS id_comptag, jour, indicateur, {', '.join(f"CAST(count(*) FILTER (WHERE h = {k}) AS BIGINT) AS {c}" for k, c in enumerate(HOURS))} FROM (
  SELECT id_comptag, CAST(date_heure AS DATE) AS jour, hour(date_heure) AS h, unnest(CASE WHEN type_veh = 'PL' THEN ['TV', 'PL'] ELSE ['TV'] END) AS indicateur FROM passages) GROUP BY ALL""")
def chain_city_hourly(spark, d):
    return city(spark, d)["horaire"]


@query(f"""
SELECT 'Ville-' || id_comptag AS id_comptag, tmja, pc_pl_mja, tmjo, pc_pl_mjo, nb_sens, fichier, annee, periode FROM ({STEPS['agg_csv_indicators']}) JOIN (
  SELECT id_comptag, count(DISTINCT sens) AS nb_sens, min(id_comptag || '_' || sens || '.csv') AS fichier, year(min(date_heure)) AS annee, strftime(min(date_heure), '%Y/%m/%d') || '-' || strftime(max(date_heure), '%Y/%m/%d') AS periode FROM passages GROUP BY 1) USING (id_comptag)""")
def chain_city_indicators(spark, d):
    return city(spark, d)["agrege"]


_FILLED = f"""
SELECT id_comptag, jour, year(jour) AS annee, indicateur, {', '.join(f"CAST(sum(CASE WHEN h = {k} THEN nb_veh ELSE 0 END) AS BIGINT) AS {c}" for k, c in enumerate(HOURS))} FROM (
  SELECT id_comptag, CAST(pas AS DATE) AS jour, hour(pas) AS h, nb_veh, unnest(CASE WHEN type_veh = 'PL' THEN ['TV', 'PL'] ELSE ['TV'] END) AS indicateur
  FROM (WITH {_FOLDED} SELECT * FROM (WITH passages AS (SELECT * FROM folded) SELECT * FROM ({STEPS['agg_hourly_counts']}))) WHERE type_veh <> 'TV') GROUP BY ALL"""


def recorded(spark, d):
    p = S.campagnes(spark, d)
    n = F.substring("id_comptag", 2, 1).cast("int")
    notes = p.select("id_comptag").distinct().where(n % 3 > 0).withColumn("qualite", n % 3)
    return chains.records_to_indicators(p, notes)


@query(_FILLED)
def chain_records_hourly(spark, d):
    return recorded(spark, d)["horaire"]


@query(f"""
SELECT id_comptag, annee, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([CAST(tv AS DOUBLE), round(pl / tv * 100, 2)]) AS valeur, CASE WHEN k % 3 > 0 THEN k % 3 END AS qualite FROM (
  SELECT id_comptag, annee, CAST(substr(id_comptag, 2, 1) AS INTEGER) AS k, CAST(trunc(avg({_TOTAL}) FILTER (WHERE indicateur = 'TV')) AS INTEGER) AS tv, CAST(trunc(avg({_TOTAL}) FILTER (WHERE indicateur = 'PL')) AS INTEGER) AS pl FROM ({_FILLED}) GROUP BY ALL) WHERE tv > 0 AND pl IS NOT NULL""")
def chain_records_indicators(spark, d):
    return recorded(spark, d)["agrege"]


def mapped(spark, d):
    """Counts as rows of a road map's table; those of some counters break a rule."""
    c, k, n = S.comptage(spark, d), F.col("id"), F.substring("id_comptag", 2, 9).cast("int")
    on = k % 3 > 0
    odd, missing = (n % 10 == 3) & (k % 20 == 1), k % 90 == 1
    obs = F.when(missing & ~((n % 10 == 4) & (k % 4 == 3)), "suite: Donnees Non Disponibles").when(k % 2 == 0, "ok")
    sheet = c.select("id_comptag", F.when(on, "t").otherwise("f").alias("carto"), F.when(on & ~odd, "t").alias("diffusable"), F.when(on, F.col("src")).alias("src"), F.when(~missing, F.col("tmja")).alias("tmja"), "pc_pl", obs.alias("obs"))
    return chains.map_table(sheet, c.where("src = '1-URGENT'"), 1995, "carte.ods")


_MAPPED = """
m AS (SELECT *, id % 90 = 1 AS manque, k % 10 = 3 AND id % 20 = 1 AS impair, k % 10 = 4 AND id % 4 = 3 AND id % 90 = 1 AS muet FROM (SELECT *, CAST(substr(id_comptag, 2) AS INTEGER) AS k FROM comptage) WHERE id % 3 > 0),
e AS (SELECT id_comptag, 'carto, diffusable et src' AS regle, count(*) AS n FROM m WHERE impair GROUP BY 1 UNION ALL SELECT id_comptag, 'mention', count(*) FROM m WHERE muet GROUP BY 1)"""


@query(f"WITH {_MAPPED} SELECT * FROM e")
def chain_map_checks(spark, d):
    return mapped(spark, d)["ecarts"]


@query(f"""
WITH {_MAPPED} SELECT id_comptag, CASE WHEN NOT bool_or(manque) THEN CAST(sum(tmja) AS BIGINT) END AS tmja, CASE WHEN NOT bool_or(manque) THEN round(avg(pc_pl), 4) END AS pc_pl, min(src) AS src, 1995 AS annee, 'carte.ods' AS fichier,
  CASE WHEN id_comptag IN (SELECT id_comptag FROM comptage WHERE annee = 1995 AND src = '1-URGENT') THEN 'update' ELSE 'insert' END AS action
FROM m WHERE id_comptag NOT IN (SELECT id_comptag FROM e) GROUP BY 1""")
def chain_map_counts(spark, d):
    return mapped(spark, d)["comptages"]
