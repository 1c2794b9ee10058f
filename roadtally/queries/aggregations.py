"""Aggregations: hourly counts, vehicles, yearly deliveries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import standins as S
from ..operators import hourly as ho
from ..operators import vehicles as ve
from ..operators import yearly as ye
from ..schemas import DAYS, HOLIDAYS, HOURS
from .registry import query

_HOLIDAYS = ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in HOLIDAYS)
_WORKING = f"isodow(jour) < 6 AND NOT EXISTS (SELECT 1 FROM (VALUES {_HOLIDAYS}) AS h(a, b) WHERE jour BETWEEN h.a AND h.b)"
_SUMS = ", ".join(f"sum({h}) AS {h}" for h in HOURS)
_TOTAL = " + ".join(HOURS)
_DAYS = f"""(
  SELECT id_comptag, annee, jour, 'TV' AS indicateur, {_SUMS}, string_agg(DISTINCT fichier, ' ; ' ORDER BY fichier) AS fichier FROM hw GROUP BY 1, 2, 3
  UNION ALL SELECT id_comptag, annee, jour, 'PL', {_SUMS}, string_agg(DISTINCT fichier, ' ; ' ORDER BY fichier) FROM hw WHERE indicateur = 'PL' GROUP BY 1, 2, 3)"""
_MEANS = f"trunc(sum(CASE WHEN indicateur = 'TV' THEN {_TOTAL} END) / count(*) FILTER (WHERE indicateur = 'TV')) AS tv, trunc(sum(CASE WHEN indicateur = 'PL' THEN {_TOTAL} END) / nullif(count(*) FILTER (WHERE indicateur = 'PL'), 0)) AS pl"
_DAY = "[" + ", ".join(f"'{x}'" for x in DAYS) + "]"
#: The average week, in SQL.
_WEEK = """(
  SELECT id_comptag, jour, heure, type_veh, sens, s / occurrences AS nb_veh
  FROM (SELECT id_comptag, isodow(date_heure) - 1 AS jour, hour(date_heure) AS heure, type_veh, sens, count(*) AS s FROM passages GROUP BY ALL)
  JOIN (SELECT id_comptag, isodow(date_heure) - 1 AS jour, count(DISTINCT CAST(date_heure AS DATE)) AS occurrences FROM passages GROUP BY ALL) USING (id_comptag, jour))"""
_QUANTILES = "quantile_cont(vitesse, 0.1) AS v10, quantile_cont(vitesse, 0.5) AS v50, quantile_cont(vitesse, 0.85) AS v85"
_V85 = """(
  SELECT sens, id_comptag, date_trunc('hour', date_heure) AS pas, quantile_cont(vitesse, 0.85) AS v85 FROM passages GROUP BY ALL)"""


@query("""
SELECT indicateur, CASE WHEN isodow(jour) < 6 THEN 'semaine' ELSE 'weekend' END AS type_jour, round(stddev_samp(h7_8), 6) AS sigma, round(avg(h7_8), 6) AS moyenne, median(h7_8) AS mediane,
       round(avg(h7_8) - 2 * stddev_samp(h7_8), 6) AS bas, round(avg(h7_8) + 2 * stddev_samp(h7_8), 6) AS haut FROM hw GROUP BY ALL""")
def agg_hour_stats(spark, d):
    return ho.hour_stats(S.hw(spark, d), "h7_8").withColumns({c: F.round(c, 6) for c in ("sigma", "moyenne", "bas", "haut")})


@query(f"SELECT * FROM {_DAYS}")
def agg_directions(spark, d):
    return ho.directions(S.hw(spark, d))


@query(f"""
SELECT id_comptag, annee, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([tv, round(pl / tv * 100, 2)]) AS valeur
FROM (SELECT id_comptag, annee, {_MEANS} FROM {_DAYS} GROUP BY ALL) WHERE tv > 0 AND pl IS NOT NULL""")
def agg_tmja_from_hourly(spark, d):
    return ho.tmja_from_hourly(ho.directions(S.hw(spark, d)))


@query(f"""
SELECT id_comptag, annee, mois, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([tv, round(pl / tv * 100, 2)]) AS valeur
FROM (SELECT id_comptag, annee, month(jour) AS mois, {_MEANS} FROM {_DAYS} GROUP BY ALL) WHERE tv > 0 AND pl IS NOT NULL""")
def agg_monthly_from_hourly(spark, d):
    return ho.monthly_from_hourly(ho.directions(S.hw(spark, d)))


@query("SELECT id_comptag, strftime(min(jour), '%Y/%m/%d') || '-' || strftime(max(jour), '%Y/%m/%d') AS periode FROM hw GROUP BY 1")
def agg_period_from_hourly(spark, d):
    return ho.period_from_hourly(S.hw(spark, d))


_TRUNC = ", ".join(f"CAST(trunc(sum({h}) / count(*)) AS INTEGER) AS {h}" for h in HOURS)
_TYPICAL = f"(SELECT id_comptag, 'MJA' AS type_jour, {_TRUNC} FROM {_DAYS} WHERE indicateur = 'TV' GROUP BY 1 UNION ALL SELECT id_comptag, 'MJO', {_TRUNC} FROM {_DAYS} WHERE indicateur = 'TV' AND {_WORKING} GROUP BY 1)"


@query(f"SELECT * FROM {_TYPICAL}")
def agg_typical_day(spark, d):
    return ho.typical_day(ho.directions(S.hw(spark, d)))


@query(f"SELECT id_comptag, type_jour, printf('%02d:00', CAST(regexp_extract(label, 'h([0-9]+)', 1) AS INTEGER)) AS horaire, valeur FROM (UNPIVOT {_TYPICAL} ON {', '.join(HOURS)} INTO NAME label VALUE valeur)")
def rs_typical_day_long(spark, d):
    return ho.typical_day_long(ho.directions(S.hw(spark, d)))


_FULL = """(
  SELECT g.id_comptag, g.sens, g.pas, g.type_veh, coalesce(n.nb_veh, 0) AS nb_veh FROM (
    SELECT e.id_comptag, s.sens, u.pas, k.type_veh FROM (SELECT id_comptag, date_trunc('hour', min(date_heure)) AS a, date_trunc('hour', max(date_heure)) AS b FROM passages GROUP BY 1) e
    JOIN (SELECT DISTINCT id_comptag, sens FROM passages) s USING (id_comptag), unnest(generate_series(e.a, e.b, INTERVAL 1 HOUR)) AS u(pas), (VALUES ('VL'), ('PL'), ('2R')) AS k(type_veh)) g
  LEFT JOIN (SELECT id_comptag, sens, date_trunc('hour', date_heure) AS pas, type_veh, count(*) AS nb_veh FROM passages GROUP BY ALL) n USING (id_comptag, sens, pas, type_veh))"""


@query(f"SELECT * FROM {_FULL} UNION ALL SELECT id_comptag, sens, pas, 'TV', CAST(sum(nb_veh) AS BIGINT) FROM {_FULL} GROUP BY ALL")
def agg_hourly_counts(spark, d):
    return ve.hourly_counts(S.passages(spark, d))


@query("""
SELECT id_comptag, sens, time_bucket(INTERVAL 6 MINUTES, date_heure) AS pas, count(*) FILTER (WHERE type_veh = 'VL') AS VL, count(*) FILTER (WHERE type_veh = 'PL') AS PL, count(*) FILTER (WHERE type_veh = '2R') AS "2R"
FROM passages GROUP BY ALL""")
def agg_step_6min(spark, d):
    return ve.steps_pivot(S.passages(spark, d))


@query(f"""
SELECT id_comptag, sens, date_trunc('hour', date_heure) AS pas, type_veh, {_QUANTILES} FROM passages GROUP BY ALL
UNION ALL SELECT id_comptag, sens, date_trunc('hour', date_heure), 'TV', {_QUANTILES} FROM passages GROUP BY 1, 2, 3""")
def agg_speed_percentiles(spark, d):
    return ve.speed_percentiles(S.passages(spark, d))


@query("SELECT id_comptag, sens, date_trunc('hour', date_heure) AS pas, count(*) AS nb_veh, 'TV' AS type_veh FROM passages GROUP BY ALL")
def agg_total_vehicle(spark, d):
    p = S.passages(spark, d).withColumn("pas", ve.step_of(F.col("date_heure"), "1 hour"))
    n = p.groupBy("id_comptag", "sens", "pas", "type_veh").agg(F.count("*").alias("nb_veh"))
    return ve.total_vehicle(n, ["id_comptag", "sens", "pas"])


@query("""
SELECT id_comptag, isodow(j) - 1 AS jour, count(*) AS occurrences, any_value(jours) AS jours, any_value(ouvres) AS jours_ouvres FROM (
  SELECT id_comptag, j, count(*) OVER (PARTITION BY id_comptag) AS jours, count(*) FILTER (WHERE isodow(j) < 6) OVER (PARTITION BY id_comptag) AS ouvres FROM (SELECT DISTINCT id_comptag, CAST(date_heure AS DATE) AS j FROM passages)) GROUP BY 1, 2""")
def agg_day_counts(spark, d):
    return ve.day_counts(S.passages(spark, d))


@query(f"SELECT * FROM {_WEEK}")
def agg_average_week(spark, d):
    return ve.average_week(S.passages(spark, d))


@query(f"""
SELECT id_comptag, type_jour, direction, heure, type_veh, CAST(round_even(round(sum(nb_veh) / div, 9), 0) AS INTEGER) AS nb_veh FROM (
  SELECT w.*, unnest([sens, '2sens']) AS direction FROM {_WEEK} w) x, LATERAL (SELECT unnest(CASE WHEN jour < 5 THEN ['mja', 'mjo', ({_DAY})[jour + 1]] ELSE ['mja', ({_DAY})[jour + 1]] END) AS type_jour) t, LATERAL (SELECT CASE type_jour WHEN 'mja' THEN 7 WHEN 'mjo' THEN 5 ELSE 1 END AS div) v
GROUP BY id_comptag, type_jour, direction, heure, type_veh, div""")
def agg_hourly_profile(spark, d):
    return ve.hourly_profile(ve.average_week(S.passages(spark, d)))


@query(f"SELECT id_comptag, ({_DAY})[jour + 1] AS nom_jour, type_veh, sens, round(sum(nb_veh), 6) AS nb_veh FROM {_WEEK} GROUP BY ALL")
def agg_daily_profile(spark, d):
    return ve.daily_profile(ve.average_week(S.passages(spark, d))).withColumn("nb_veh", F.round("nb_veh", 6))


@query(f"SELECT id_comptag, jour, round(sum(CASE WHEN sens = 'sens1' THEN nb_veh ELSE 0 END), 6) AS sens1, round(sum(CASE WHEN sens = 'sens2' THEN nb_veh ELSE 0 END), 6) AS sens2 FROM {_WEEK} GROUP BY ALL")
def agg_direction_compare(spark, d):
    return ve.direction_compare(ve.average_week(S.passages(spark, d))).withColumns({c: F.round(c, 6) for c in ve.SIDES})


@query(f"""
SELECT id_comptag, sens, type_veh, round_even(round(sum(CASE WHEN heure IN (7, 8) THEN nb_veh ELSE 0 END) / 3, 9), 0) AS HPM, round_even(round(sum(CASE WHEN heure IN (16, 17) THEN nb_veh ELSE 0 END) / 3, 9), 0) AS HPS,
       round_even(round(sum(CASE WHEN heure BETWEEN 6 AND 21 THEN nb_veh ELSE 0 END) / 16, 9), 0) AS jour, round_even(round(sum(CASE WHEN heure NOT BETWEEN 6 AND 21 THEN nb_veh ELSE 0 END) / 8, 9), 0) AS nuit FROM {_WEEK} GROUP BY ALL""")
def agg_peak_periods(spark, d):
    return ve.peak_periods(ve.average_week(S.passages(spark, d)))


@query("SELECT id_comptag, type_veh, date, nb_veh FROM (SELECT id_comptag, type_veh, CAST(date_heure AS DATE) AS date, count(*) AS nb_veh FROM passages GROUP BY ALL) QUALIFY rank() OVER (PARTITION BY id_comptag, type_veh ORDER BY nb_veh DESC) = 1")
def agg_busiest_day(spark, d):
    return ve.busiest_day(S.passages(spark, d))


@query(f"SELECT id_comptag, tmja, pl, round(pl / tmja * 100, 2) AS pc_pl FROM (SELECT id_comptag, CAST(round_even(round(sum(nb_veh) / 7, 9), 0) AS INTEGER) AS tmja, CAST(round_even(round(sum(CASE WHEN type_veh = 'PL' THEN nb_veh ELSE 0 END) / 7, 9), 0) AS INTEGER) AS pl FROM {_WEEK} GROUP BY 1)")
def agg_fim_indicators(spark, d):
    return ve.week_indicators(ve.average_week(S.passages(spark, d)))


@query(f"""
SELECT coalesce(sens, 'tous') AS sens, coalesce(type_veh, 'TV') AS type_veh, {_QUANTILES}, count(*) / count(DISTINCT CAST(date_heure AS DATE)) AS mjo
FROM passages WHERE isodow(date_heure) < 6 GROUP BY GROUPING SETS ((sens, type_veh), (type_veh), (sens), ())""")
def agg_mjo_grouping_sets(spark, d):
    return ve.mjo_grouping_sets(S.passages(spark, d))


@query("""
SELECT sens, type_veh, CASE WHEN vitesse <= 0 THEN NULL WHEN vitesse <= 20 THEN '(0,20]' WHEN vitesse <= 110 THEN '(' || CAST(ceil(vitesse / 10) * 10 - 10 AS INTEGER) || ',' || CAST(ceil(vitesse / 10) * 10 AS INTEGER) || ']' WHEN vitesse <= 9999 THEN '(110,9999]' END AS classe,
       isodow(date_heure) - 1 AS jour, CAST(date_heure AS DATE) AS date, count(*) AS nb_veh FROM passages GROUP BY ALL""")
def agg_speed_class_table(spark, d):
    return ve.speed_class_table(S.passages(spark, d))


@query(f"""
SELECT sens, hour(pas) AS heure, type_jour, round(avg(v85), 8) AS v85 FROM {_V85}, LATERAL (SELECT unnest(CASE isodow(pas) WHEN 6 THEN ['mja', 'samedi'] WHEN 7 THEN ['mja', 'dimanche'] ELSE ['mja', 'mjo'] END) AS type_jour) GROUP BY ALL""")
def agg_speed_profile(spark, d):
    return ve.speed_profile(S.passages(spark, d)).withColumn("v85", F.round("v85", 8))


@query("""
SELECT id_comptag, va + pa AS tmja, round(pa / (va + pa) * 100, 2) AS pc_pl_mja, vo + po AS tmjo, round(po / (vo + po) * 100, 2) AS pc_pl_mjo FROM (
  SELECT id_comptag, CAST(sum(va) AS BIGINT) AS va, CAST(sum(pa) AS BIGINT) AS pa, CAST(sum(vo) AS BIGINT) AS vo, CAST(sum(po) AS BIGINT) AS po FROM (
    SELECT id_comptag, sens, CAST(round_even(avg(vl), 0) AS INTEGER) AS va, CAST(round_even(avg(pl), 0) AS INTEGER) AS pa, CAST(round_even(avg(vl) FILTER (WHERE isodow(j) < 6), 0) AS INTEGER) AS vo, CAST(round_even(avg(pl) FILTER (WHERE isodow(j) < 6), 0) AS INTEGER) AS po
    FROM (SELECT id_comptag, sens, CAST(date_heure AS DATE) AS j, count(*) FILTER (WHERE type_veh = 'VL') AS vl, count(*) FILTER (WHERE type_veh = 'PL') AS pl FROM passages GROUP BY ALL) GROUP BY 1, 2) GROUP BY 1)""")
def agg_csv_indicators(spark, d):
    return ve.csv_indicators(S.passages(spark, d))


@query(f"SELECT id_comptag, CAST(pas AS DATE) AS date, CAST(sum(nb_veh) AS BIGINT) AS nb_veh, CAST(count(*) FILTER (WHERE nb_veh = 0) AS BIGINT) AS vides FROM {_FULL} GROUP BY ALL")
def agg_resample(spark, d):
    h = ve.hourly_counts(S.passages(spark, d)).where("type_veh <> 'TV'")
    return h.groupBy("id_comptag", F.to_date("pas").alias("date")).agg(F.sum("nb_veh").alias("nb_veh"), F.count_if(F.col("nb_veh") == 0).alias("vides"))


@query("SELECT id_comptag, CAST(trunc(avg(tmja)) AS INTEGER) AS tmja, round(avg(pc_pl) FILTER (WHERE pc_pl > 0), 2) AS pc_pl, count(*) AS fichiers FROM comptage GROUP BY 1")
def agg_files_mean(spark, d):
    return ye.files_mean(S.comptage(spark, d), "id_comptag")


@query(f"SELECT id_comptag, jour, tv, pl, fichiers, round(pl / nullif(tv, 0) * 100, 2) AS pc_pl FROM (SELECT id_comptag, jour, sum({_TOTAL}) AS tv, sum(CASE WHEN indicateur = 'PL' THEN {_TOTAL} ELSE 0 END) AS pl, count(DISTINCT fichier) AS fichiers FROM hw GROUP BY 1, 2)")
def agg_two_files_sum(spark, d):
    return ho.two_files_sum(S.hw(spark, d))


def months_by_side(spark, d):
    g = S.horaire(spark, d).groupBy("id_comptag", "annee", F.month("jour").alias("mois"), "sens")
    return g.agg(F.sum("valeur").alias("tmja"), (F.count_if(F.col("indicateur") == "PL") / F.count("*")).alias("part"))


_SIDES = "(SELECT id_comptag, annee, month(jour) AS mois, sens, sum(valeur) AS tmja, count(*) FILTER (WHERE indicateur = 'PL') / count(*) AS part FROM horaire GROUP BY ALL)"


@query(f"SELECT id_comptag, annee, mois, sum(tmja) AS tmja, round(CASE WHEN avg(part) > 0 THEN avg(part) * 100 ELSE -99 END, 2) AS pc_pl FROM {_SIDES} GROUP BY ALL HAVING avg(part) * 100 <= 99")
def agg_monthly_two_directions(spark, d):
    return ye.monthly_two_directions(months_by_side(spark, d), ["id_comptag", "annee", "mois"])


@query(f"SELECT id_comptag, annee, mois, CASE WHEN count(DISTINCT sens) = 1 THEN sum(tmja) * 2 ELSE sum(tmja) END AS tmja, round(avg(part) * 100, 2) AS pc_pl, CASE WHEN count(DISTINCT sens) = 1 THEN '1 seul sens *2' END AS obs FROM {_SIDES} WHERE sens = 1 OR mois % 3 > 0 GROUP BY ALL")
def agg_monthly_one_or_two(spark, d):
    return ye.monthly_one_or_two(months_by_side(spark, d).where("sens = 1 or mois % 3 > 0"), ["id_comptag", "annee", "mois"], "sens")


@query("SELECT id_comptag, annee, vl + pl AS tv, round(pl / (vl + pl) * 100, 2) AS pc_pl FROM (SELECT id_comptag, annee, sum(valeur) FILTER (WHERE indicateur = 'VL') AS vl, sum(valeur) FILTER (WHERE indicateur = 'PL') AS pl FROM horaire GROUP BY 1, 2)")
def agg_vl_pl_to_share(spark, d):
    pick = lambda k: F.sum(F.when(F.col("indicateur") == k, F.col("valeur")))
    return ye.vl_pl_to_share(S.horaire(spark, d).groupBy("id_comptag", "annee").agg(pick("VL").alias("vl"), pick("PL").alias("pl")))


@query("SELECT id_comptag, CASE WHEN NOT bool_or(id % 900 = 0) THEN CAST(sum(tmja) AS BIGINT) END AS tmja, CASE WHEN NOT bool_or(id % 900 = 0) THEN round(avg(pc_pl), 4) END AS pc_pl, min(src) AS src FROM comptage GROUP BY 1")
def agg_map_counts(spark, d):
    c = S.comptage(spark, d).withColumn("obs", F.when(F.col("id") % 900 == 0, "Donnees Non Disponibles").otherwise("ok"))
    return ye.map_counts(c)


@query("SELECT id, id_comptag, annee, tmja FROM comptage QUALIFY rank() OVER (PARTITION BY id_comptag, annee ORDER BY tmja DESC) = 1")
def agg_max_per_year(spark, d):
    return ye.max_per_year(S.comptage(spark, d), ["id_comptag", "annee"], "tmja").select("id", "id_comptag", "annee", "tmja")


@query("SELECT src AS zone, annee, CAST(sum(tmja) AS BIGINT) AS tmja, round(avg(pc_pl), 4) AS pc_pl FROM comptage GROUP BY ALL")
def agg_single_direction_pair(spark, d):
    return ye.single_direction_pair(S.comptage(spark, d).withColumnRenamed("src", "zone"), "zone")


@query("SELECT dep, min(CASE WHEN pr % 3 <> 0 THEN route END) AS route FROM compteur GROUP BY 1")
def agg_harmonise_group(spark, d):
    return ye.harmonise_group(S.compteur(spark, d).withColumn("route", F.when(F.col("pr") % 3 != 0, F.col("route"))), "dep", "route")


@query("SELECT id_comptag, string_agg(DISTINCT src, ' ; ' ORDER BY src) AS fichiers FROM comptage GROUP BY 1")
def agg_concat_files(spark, d):
    return ye.concat_files(S.comptage(spark, d), "id_comptag", "src")


@query("SELECT id_comptag, min(src) AS src FROM comptage GROUP BY 1")
def agg_station_per_counter(spark, d):
    return ye.station_per_counter(S.comptage(spark, d), "id_comptag", "src")


@query("""
SELECT id_comptag, n AS jours, round(CASE WHEN n > 8 THEN (s - a - z) / (n - 2) WHEN n >= 7 THEN s / (n - 1) ELSE s / n END, 6) AS moyenne FROM (
  SELECT id_comptag, count(*) AS n, sum(v) AS s, arg_min(v, j) AS a, arg_max(v, j) AS z FROM (SELECT id_comptag, CAST(date_heure AS DATE) AS j, count(*) AS v FROM campagnes GROUP BY ALL) GROUP BY 1)""")
def agg_daily_mean_trim(spark, d):
    t = S.campagnes(spark, d).groupBy("id_comptag", F.to_date("date_heure").alias("j")).agg(F.count("*").alias("v"))
    return ho.daily_mean_trim(t, "id_comptag", "j", "v").withColumn("moyenne", F.round("moyenne", 6))


_Q = "['NC', 'faible', 'moyenne', 'bonne']"


def graded(spark, d):
    texts = F.array(*[F.lit(x) for x in ye.QUALITIES])
    c = S.comptage(spark, d).withColumns({"qualite": F.get(texts, (F.col("id") % 4).cast("int")), "coherence": F.get(texts, (F.col("tmja") % 4).cast("int")), "note": F.col("id") % 3 + 1})
    return c.join(S.compteur(spark, d).select("id_comptag", "type_poste"), "id_comptag")


@query(f"SELECT ({_Q})[id % 4 + 1] AS qualite, id % 3 + 1 AS note, type_poste, count(*) AS n FROM comptage JOIN compteur USING (id_comptag) GROUP BY ALL")
def agg_quality_by_type(spark, d):
    return ye.quality_by_type(graded(spark, d))


@query(f"""
SELECT ({_Q})[id % 4 + 1] AS qualite, count(*) FILTER (WHERE t = 0) AS NC, count(*) FILTER (WHERE t = 1) AS faible, count(*) FILTER (WHERE t = 2) AS moyenne, count(*) FILTER (WHERE t = 3) AS bonne, id % 4 + 1 AS rang
FROM (SELECT id, comptage.tmja % 4 AS t FROM comptage JOIN compteur USING (id_comptag)) GROUP BY id % 4""")
def agg_quality_crosstab(spark, d):
    return ye.quality_crosstab(graded(spark, d), "qualite", "coherence")


@query("SELECT id_comptag, min(annee) AS premiere, max(annee) AS derniere, string_agg(DISTINCT indicateur, ',' ORDER BY indicateur) AS indicateurs FROM horaire GROUP BY 1")
def agg_counter_span(spark, d):
    return ye.counter_span(S.horaire(spark, d))


@query("SELECT id_comptag, annee, tmja FROM annuel WHERE annee <= 1996")
def agg_year_filtered(spark, d):
    return ye.year_filtered(S.annuel(spark, d), 1996).select("id_comptag", "annee", "tmja")


@query("SELECT id_comptag, annee, tmja, tmja / lag(tmja) OVER w AS evolution_an, tmja / first_value(tmja) OVER w AS evolution_totale FROM annuel WINDOW w AS (PARTITION BY id_comptag ORDER BY annee)")
def agg_yearly_evolution(spark, d):
    return ye.yearly_evolution(S.annuel(spark, d))


@query("SELECT id_comptag, round(abs(tmja / 1000 - pr / 10) * 100, 6) AS impact, dep % 2 = 0 AS avec_gestionnaire FROM compteur")
def agg_evolution_impact(spark, d):
    c = S.compteur(spark, d).withColumn("gestionnai", F.when(F.col("dep") % 2 == 0, F.col("gestionnai")))
    return ye.evolution_impact(c, F.col("tmja") / 1000, F.col("pr") / 10).select("id_comptag", F.round("impact", 6).alias("impact"), "avec_gestionnaire")


@query("SELECT id_comptag, annee, CAST(tmja AS DOUBLE) AS tmja, CASE WHEN annee % 2 = 0 THEN pc_pl END AS pc_pl FROM annuel WHERE id_comptag NOT IN ('C1', 'C2')")
def agg_annual_from_monthly_rows(spark, d):
    a = S.annuel(spark, d).withColumn("tmja", F.col("tmja").cast("double")).unpivot(["id_comptag", "annee"], ["tmja", "pc_pl"], "indicateur", "annuel")
    excluded = S.compteur(spark, d).where(F.col("id_comptag").isin("C1", "C2")).select("id_comptag")
    return ye.annual_from_monthly_rows(a.where("indicateur = 'tmja' or annee % 2 = 0"), excluded)


def zones(spark, d):
    kind = F.when(F.col("pr") % 7 == 0, "Double").when(F.col("dep") % 3 == 0, "Detecteur").otherwise("Simple")
    return S.compteur(spark, d).select(F.concat(F.lit("Z"), (F.col("tmja") % 50).cast("string")).alias("zone"), kind.alias("type"), (F.col("x") % 3).alias("x"), (F.col("y") % 2).alias("y"))


_ZONES = "(SELECT 'Z' || (tmja % 50) AS zone, CASE WHEN pr % 7 = 0 THEN 'Double' WHEN dep % 3 = 0 THEN 'Detecteur' ELSE 'Simple' END AS type, x % 3 AS x, y % 2 AS y FROM compteur)"


@query(f"SELECT zone, type, count(DISTINCT (x, y)) AS positions, count(*) AS points FROM {_ZONES} GROUP BY ALL")
def agg_zone_geometries(spark, d):
    return ye.zone_geometries(zones(spark, d))


@query(f"""
SELECT zone, CASE WHEN dbl THEN 'double' WHEN smp AND n IN (1, 2) THEN 'simple ' || n WHEN det AND n = 1 THEN 'detecteur' WHEN smp OR det THEN 'rejete' ELSE 'mixte' END AS cas FROM (
  SELECT zone, bool_or(type = 'Double') AS dbl, bool_and(type = 'Simple') AS smp, bool_and(type = 'Detecteur') AS det, sum(p) AS n FROM (SELECT zone, type, count(DISTINCT (x, y)) AS p FROM {_ZONES} GROUP BY ALL) GROUP BY 1)""")
def match_zone_case(spark, d):
    return ye.zone_case(zones(spark, d))


@query("SELECT event_id, file, rangenum, 'voie ' || rangenum AS lane, CASE WHEN rangenum = 1 THEN 1 ELSE 2 END AS sens_num FROM (SELECT event_id, user_id % 50 AS file, 1 + user_id % 3 AS rangenum FROM events) WHERE rangenum <> 2")
def agg_calibrated_merge(spark, d):
    e = S.table(spark, d, "events").select("event_id", (F.col("user_id") % 50).alias("file"), (1 + F.col("user_id") % 3).alias("rangenum"))
    # the file headers: one row for each lane of each file
    header = e.select("file").distinct().withColumn("rangenum", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(3).cast("long"))))
    header = header.withColumn("lane", F.when(F.col("rangenum") == 2, " ").otherwise(F.concat(F.lit("voie "), F.col("rangenum").cast("string"))))
    return ye.calibrated_merge(e, header)
