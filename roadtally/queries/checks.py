"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import standins as S
from ..operators import checks as q
from ..schemas import HOURS
from .registry import query

_ZEROS = " + ".join(f"CAST({h} = 0 AS INTEGER)" for h in HOURS)
_FEW_ZEROS = " + ".join(f"coalesce(CAST({h} = 0 AS INTEGER), 0)" for h in HOURS)
_TOTAL = " + ".join(HOURS)


@query("SELECT count(*) AS n, count(DISTINCT id_comptag) AS compteurs FROM hw")
def q_columns(spark, d):
    return q.require_columns(S.hw(spark, d), ["id_comptag", "jour", *HOURS]).agg(F.count("*").alias("n"), F.countDistinct("id_comptag").alias("compteurs"))


@query("SELECT type_veh, count(*) AS n FROM passages WHERE type_veh NOT IN ('VL', 'PL') GROUP BY 1")
def q_values(spark, d):
    return q.values_outside(S.passages(spark, d), "type_veh", ["VL", "PL"])


@query("SELECT count(*) FILTER (WHERE id % 3 = 0) AS tmja, 0 AS id_comptag FROM comptage")
def q_not_null(spark, d):
    return q.null_counts(S.comptage(spark, d).withColumn("tmja", F.when(F.col("id") % 3 != 0, F.col("tmja"))), ["tmja", "id_comptag"])


@query("SELECT id_comptag, annee, count(*) AS n FROM comptage GROUP BY 1, 2 HAVING count(*) > 1")
def q_unique(spark, d):
    return q.duplicates(S.comptage(spark, d), ["id_comptag", "annee"])


@query("SELECT type_poste, count(*) AS n, CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM compteur GROUP BY 1")
def q_partition_sizes(spark, d):
    return q.class_sizes(S.compteur(spark, d), "type_poste")


@query("""
SELECT count(*) AS left_rows, count(*) FILTER (WHERE n IS NULL) AS unmatched, count(*) FILTER (WHERE n > 1) AS multiplied, CAST(sum(coalesce(n, 1)) AS BIGINT) AS joined_rows
FROM comptage LEFT JOIN (SELECT 'C' || (s_suppkey % 40) AS id_comptag, count(*) AS n FROM supplier GROUP BY 1) USING (id_comptag)""")
def q_join_cardinality(spark, d):
    right = S.table(spark, d, "supplier").select(S.counter(F.col("s_suppkey") % 40).alias("id_comptag"))
    return q.join_cardinality(S.comptage(spark, d), right, "id_comptag")


@query("SELECT jour, id_comptag, count(*) AS n FROM hw GROUP BY 1, 2 HAVING count(*) > 2")
def q_max_two_indicators(spark, d):
    return q.group_over(S.hw(spark, d), ["jour", "id_comptag"], 2)


@query("SELECT id FROM comptage WHERE NOT ((id % 2 = 0) = (src <> '5-LOW') AND (id % 2 = 0) = (id % 4 < 2))")
def q_flags_concordant(spark, d):
    return q.flags_concordant(S.comptage(spark, d), F.col("id") % 2 == 0, F.col("src") != "5-LOW", F.col("id") % 4 < 2).select("id")


@query("SELECT id FROM comptage WHERE (id % 3 = 0) <> (id % 6 = 0)")
def q_missing_mention(spark, d):
    c = S.comptage(spark, d).select("id", F.when(F.col("id") % 3 != 0, F.col("tmja")).alias("tmja"), F.when(F.col("id") % 6 == 0, "x Donnees Non Disponibles").otherwise("x").alias("obs"))
    return q.flags_concordant(c, F.col("tmja").isNull(), F.col("obs").contains("Donnees Non Disponibles")).select("id")


@query("SELECT annee, count(*) AS n FROM comptage WHERE annee <> 1900 AND NOT (annee > 1993 AND annee <= 1997) GROUP BY 1")
def q_year_range(spark, d):
    return q.years_outside(S.comptage(spark, d), after=1993, last=1997)


@query(f"""
SELECT id_comptag, jour, indicateur, sens, (jour, id_comptag) IN (SELECT (jour, id_comptag) FROM hw WHERE {_ZEROS} > 22) AS removed FROM hw""")
def qc_invalid_days(spark, d):
    kept, removed = q.invalid_days(S.hw(spark, d), most_zeros=22)
    cols = ["id_comptag", "jour", "indicateur", "sens"]
    return kept.select(*cols, F.lit(False).alias("removed")).union(removed.select(*cols, F.lit(True).alias("removed")))


@query(f"""
SELECT id_comptag, annee, count(*) AS n FROM hw WHERE (id_comptag, annee) NOT IN (
  SELECT (id_comptag, annee) FROM (SELECT * REPLACE (CASE WHEN NOT (day(jour) % 16 < 15 AND annee % 3 = sens % 3) THEN {HOURS[5]} END AS {HOURS[5]}) FROM hw) GROUP BY id_comptag, annee, sens, indicateur
  HAVING count(*) FILTER (WHERE {_FEW_ZEROS} > 22) > 0.97 * count(*) OR count(*) FILTER (WHERE {HOURS[5]} IS NULL) > 0.97 * count(*)) GROUP BY 1, 2""")
def qc_invalid_sheet(spark, d):
    lost = (F.dayofmonth("jour") % 16 < 15) & (F.col("annee") % 3 == F.col("sens") % 3)
    sheets = S.hw(spark, d).withColumn(HOURS[5], F.when(~lost, F.col(HOURS[5])))
    return q.invalid_sheets(sheets, most_zeros=22, share=0.97, key=("id_comptag", "annee")).groupBy("id_comptag", "annee").agg(F.count("*").alias("n"))


@query("SELECT id_comptag, annee, count(*) AS n FROM horaire WHERE (id_comptag) IN (SELECT id_comptag FROM horaire GROUP BY 1 HAVING count(DISTINCT jour) >= 900) GROUP BY 1, 2")
def qc_min_days(spark, d):
    return q.min_days(S.horaire(spark, d), 900).groupBy("id_comptag", "annee").agg(F.count("*").alias("n"))


@query("""
SELECT id_comptag, jours, suffisant, CASE WHEN suffisant THEN NULL WHEN jours = 8 THEN jours - 2 WHEN jours = 7 THEN jours - 1 ELSE jours END AS jours_pleins, CASE WHEN NOT suffisant THEN 1 END AS qualite
FROM (SELECT id_comptag, jours, CASE WHEN jours > 8 THEN true WHEN jours = 8 THEN strftime(a, '%H:%M:%S') <= strftime(b, '%H:%M:%S') ELSE false END AS suffisant
      FROM (SELECT id_comptag, count(DISTINCT CAST(date_heure AS DATE)) AS jours, min(date_heure) AS a, max(date_heure) AS b FROM campagnes GROUP BY 1))""")
def qc_enough_days(spark, d):
    return q.enough_days(S.campagnes(spark, d))


#: Hourly rows with lane names: a counter in four calls its second direction a ramp, one in three has rows of an exit besides.
_LANES = """(
  SELECT *, CASE WHEN sens = 1 THEN 'Sens 1' WHEN k % 4 = 2 THEN 'Bretelle entrée' WHEN k % 4 = 1 THEN 'Sens_1' ELSE 'SENS_Intér' END AS voie FROM (SELECT *, CAST(substr(id_comptag, 2) AS INTEGER) AS k FROM hw)
  UNION ALL SELECT *, 'Bretelle de sortie' FROM (SELECT * REPLACE (CAST(3 AS INTEGER) AS sens), CAST(substr(id_comptag, 2) AS INTEGER) AS k FROM hw) WHERE k % 3 = 0)"""
_MAIN = "replace(replace(translate(lower(voie), 'éèêç', 'eeec'), ' ', ''), '_', '') IN ('sens1', 'sens2', 'deportsens1', 'deportsens2', 'sensexter', 'sensinter', 'sens1n137', 'sens2n137', 'sens1n11', 'sens2n11', 'sens1n10', 'sens2n10', 'sens1n141', 'sens2n141')"


def lanes(spark, d):
    h, k = S.hw(spark, d), F.substring("id_comptag", 2, 9).cast("int")
    name = F.when(F.col("sens") == 1, "Sens 1").when(k % 4 == 2, "Bretelle entrée").when(k % 4 == 1, "Sens_1").otherwise("SENS_Intér")
    return h.withColumn("voie", name).unionByName(h.where(k % 3 == 0).withColumns({"sens": F.lit(3), "voie": F.lit("Bretelle de sortie")}))


@query(f"""
SELECT id_comptag, jour, indicateur, sens, voie FROM {_LANES} WHERE (jour, id_comptag) NOT IN (
  SELECT (jour, id_comptag) FROM {_LANES} WHERE {_MAIN} GROUP BY jour, id_comptag HAVING count(*) = 2 AND count(*) FILTER (WHERE indicateur = 'VL') = 1 AND count(*) FILTER (WHERE indicateur = 'PL') = 1)""")
def qc_two_directions_present(spark, d):
    return q.two_directions_present(lanes(spark, d), lane="voie").select("id_comptag", "jour", "indicateur", "sens", "voie")


@query(f"""
WITH r AS (
  SELECT id_comptag, jour, indicateur, voie AS s, {_TOTAL} AS t, CASE WHEN k % 5 = 0 THEN 'sens unique' ELSE 'double sens' END AS circu FROM {_LANES} WHERE {_MAIN}),
t AS (SELECT id_comptag, jour, indicateur, s, sum(t) AS t FROM r GROUP BY ALL),
p AS (SELECT a.id_comptag, count(*) AS jours, count(*) FILTER (WHERE a.t > 3 * b.t OR b.t > 3 * a.t) AS ecarts FROM t a JOIN t b USING (id_comptag, jour, indicateur) WHERE a.s < b.s GROUP BY 1),
c AS (SELECT id_comptag, count(DISTINCT s) AS n, any_value(circu) AS circu FROM r GROUP BY 1)
SELECT id_comptag, coalesce(jours, 0) AS jours, coalesce(ecarts, 0) AS ecarts, etat, etat <> 'ok' AS rejete
FROM (SELECT *, CASE WHEN n = 2 AND circu = 'double sens' AND ecarts > jours / 10 THEN 'asymetrique' WHEN n = 2 AND circu = 'double sens' THEN 'ok' WHEN n = 2 THEN 'sens unique a deux sens'
             WHEN n = 1 AND circu = 'sens unique' THEN 'ok' WHEN n = 1 THEN 'double sens a un seul sens' ELSE 'cas non prevu' END AS etat FROM c LEFT JOIN p USING (id_comptag))""")
def qc_direction_asymmetry(spark, d):
    n = F.substring("id_comptag", 2, 9).cast("int")
    return q.direction_asymmetry(lanes(spark, d), declared=F.when(n % 5 == 0, q.ONE_WAY).otherwise(q.TWO_WAY), lane="voie")


@query("""
WITH m AS (
  SELECT id_comptag, annee, mois, sens, indicateur, CASE WHEN sum(valeur) > 100 THEN sum(valeur) END AS v
  FROM (SELECT * REPLACE (CASE WHEN k % 5 = 1 OR k % 5 = 2 AND indicateur = 'PL' THEN 1 ELSE sens END AS sens), month(jour) AS mois FROM (SELECT *, CAST(substr(id_comptag, 2) AS INTEGER) AS k FROM horaire)) GROUP BY ALL),
lines AS (SELECT id_comptag, annee, count(*) AS n FROM (SELECT DISTINCT id_comptag, annee, sens, indicateur FROM m) GROUP BY ALL)
SELECT a.id_comptag, a.annee, a.mois, a.sens, a.indicateur, CASE n WHEN 4 THEN 'deux sens' WHEN 3 THEN 'non prevu' ELSE 'un sens' END AS cas,
       CASE WHEN n = 4 AND (a.v IS NULL OR b.v IS NULL) THEN -99 WHEN n <= 2 AND a.v IS NULL THEN -99 ELSE a.v END AS valeur
FROM m a JOIN lines l ON l.id_comptag = a.id_comptag AND l.annee = a.annee
LEFT JOIN m b ON b.id_comptag = a.id_comptag AND b.annee = a.annee AND b.mois = a.mois AND b.indicateur = a.indicateur AND b.sens = 3 - a.sens""")
def qc_monthly_pairs(spark, d):
    n = F.substring("id_comptag", 2, 9).cast("int")
    h = S.horaire(spark, d).withColumn("sens", F.when((n % 5 == 1) | ((n % 5 == 2) & (F.col("indicateur") == "PL")), 1).otherwise(F.col("sens")))
    m = h.groupBy("id_comptag", "annee", F.month("jour").alias("mois"), "sens", "indicateur").agg(F.sum("valeur").alias("v"))
    return q.monthly_pairs(m.withColumn("valeur", F.when(F.col("v") > 100, F.col("v"))).drop("v"))


@query("""
SELECT id_comptag, jour, heure, indicateur, sens, valeur,
  CASE WHEN valeur < avg(valeur) OVER w - 2 * stddev_samp(valeur) OVER w THEN -99 ELSE valeur END AS corrige
FROM (SELECT *, isodow(jour) >= 6 AS weekend FROM horaire) WINDOW w AS (PARTITION BY id_comptag, indicateur, weekend, heure)""")
def qc_outlier_hours(spark, d):
    h = S.horaire(spark, d).withColumn("weekend", F.weekday("jour") >= 5)
    return q.outlier_hours(h).drop("weekend", "annee")


@query("""
SELECT id_comptag, annee, a.tmja, round(m.t, 6) AS tmja_mensuel, round(abs(a.tmja - m.t) / m.t * 100, 6) AS ecart_tmja, CASE WHEN abs(a.tmja - m.t) / m.t * 100 <= 5 THEN 'OK' ELSE 'KO' END AS etat_tmja,
       a.pc_pl, round(m.p, 6) AS pc_pl_mensuel, round(abs(a.pc_pl - m.p), 6) AS ecart_pc_pl, CASE WHEN abs(a.pc_pl - m.p) <= 1 THEN 'OK' ELSE 'KO' END AS etat_pc_pl
FROM annuel a JOIN (SELECT id_comptag, annee, avg(tmja) AS t, sum(tmja * pc_pl) / sum(tmja) AS p FROM mensuel GROUP BY ALL) m USING (id_comptag, annee)""")
def qc_annual_vs_monthly(spark, d):
    r = q.annual_vs_monthly(S.annuel(spark, d), S.mensuel(spark, d), ["id_comptag", "annee"])
    return r.withColumns({c: F.round(c, 6) for c in ("tmja_mensuel", "ecart_tmja", "pc_pl_mensuel", "ecart_pc_pl")})


_RAW = """
SELECT event_id, user_id % 50 AS file, CASE WHEN user_id % 9 = 0 THEN 114870 ELSE 0 END AS advice, CASE WHEN event_id % 11 = 0 THEN 30000.0 WHEN event_id % 13 = 0 THEN 182.0 ELSE value END AS len, CASE WHEN event_id % 17 = 0 THEN 60000.0 ELSE value END AS speed
FROM events"""
_FAIL = "concat_ws(',', CASE WHEN advice = 114870 THEN 'adviceCode' END, CASE WHEN len >= 30000 THEN 'longueur' END, CASE WHEN speed >= 50000 THEN 'vitesse' END, CASE WHEN len = 182 OR speed = 182 THEN 'value0' END)"


def calibrated(spark, d):
    e, i = S.table(spark, d, "events"), F.col("event_id")
    return e.select(
        "event_id", (F.col("user_id") % 50).alias("file"), F.when(F.col("user_id") % 9 == 0, 114870).otherwise(0).alias("AdviceCode"),
        F.when(i % 11 == 0, 30000.0).when(i % 13 == 0, 182.0).otherwise(F.col("value")).alias("Length"), F.when(i % 17 == 0, 60000.0).otherwise(F.col("value")).alias("Speed"),
    )


@query(f"SELECT event_id, {_FAIL} AS fail FROM ({_RAW})")
def qc_vehicle_outliers(spark, d):
    return q.vehicle_outliers(calibrated(spark, d)).select("event_id", F.array_join("fail", ",").alias("fail"))


@query(f"""
WITH t(note, casse, sens) AS (VALUES
  (1, 'plus de 30% de valeur de longueur ou de vitesse aberrantes ou a 0, ou d''adviceCode speciaux', '0 ou plus de 2 sens, peu importe le nom'),
  (2, 'entre 10% et 30% de valeur de longueur ou de vitesse aberrantes ou a 0, ou d''adviceCode speciaux', '1 ou 2 sens, certains ou tous non nommés'),
  (3, 'moins de 10% de valeur de longueur ou de vitesse aberrantes ou a 0, ou d''adviceCode speciaux', '1 ou 2 sens nommé')),
v AS (SELECT *, {_FAIL} AS fail FROM ({_RAW})),
f AS (SELECT file, count(*) FILTER (WHERE fail <> '' AND (event_id % 3 = 0 OR file % 2 = 0)) AS bad, count(*) AS n FROM v GROUP BY 1),
s AS (SELECT DISTINCT file, event_id % (file % 4) AS sens FROM v WHERE file % 4 > 0),
c AS (SELECT file, count(*) AS n_sens, count(*) FILTER (WHERE file % 3 = 0 AND sens = 0) AS sans_nom FROM s GROUP BY 1),
x AS (SELECT f.file, bad / n AS part, CASE WHEN bad / n >= 0.3 THEN 1 WHEN bad / n > 0.1 THEN 2 ELSE 3 END AS a, CASE WHEN coalesce(n_sens, 0) NOT IN (1, 2) THEN 1 WHEN sans_nom > 0 THEN 2 ELSE 3 END AS b FROM f LEFT JOIN c USING (file))
SELECT file, round(part, 9) AS part, CASE WHEN a = 1 OR b = 1 THEN 1 WHEN a <> b THEN 2 ELSE a END AS qualite, ta.casse || ' ; ' || tb.sens AS commentaire
FROM x JOIN t ta ON ta.note = a JOIN t tb ON tb.note = b""")
def qc_vehicle_quality_note(spark, d):
    # files of no, one, two or three directions; a third of them leaves one unnamed
    v = q.vehicle_outliers(calibrated(spark, d))
    v = v.withColumn("fail", F.when((F.col("event_id") % 3 == 0) | (F.col("file") % 2 == 0), F.col("fail")).otherwise(F.array().cast("array<string>")))
    sens = F.when(F.col("file") % 4 > 0, F.col("event_id") % F.nullif(F.col("file") % 4, F.lit(0)))
    r = q.vehicle_quality_note(v.withColumn("sens", sens), "file", F.col("sens"), F.when(~((F.col("file") % 3 == 0) & (F.col("sens") == 0)), F.lit("voie")))
    return r.withColumn("part", F.round("part", 9))


@query("SELECT 'f' || o_custkey AS file FROM orders GROUP BY 1 HAVING bool_and(o_orderkey % 3 <> 0)")
def qc_files_accounted(spark, d):
    o = S.table(spark, d, "orders").withColumn("file", F.concat(F.lit("f"), F.col("o_custkey").cast("string")))
    return q.files_accounted(o.select("file").distinct(), o.where("o_orderkey % 3 = 0").select("file"), "file")


@query("SELECT o_custkey, count(DISTINCT s) AS n, CASE count(DISTINCT s) WHEN 0 THEN 'aucune' WHEN 1 THEN 'une' ELSE 'plusieurs' END AS stations FROM (SELECT o_custkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 4 END AS s FROM orders) GROUP BY 1")
def qc_station_count(spark, d):
    o = S.table(spark, d, "orders").withColumn("station", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 4))
    return q.station_count(o, "o_custkey", "station")


@query(f"""
SELECT DISTINCT id_comptag, 'jours invalides' AS reason FROM hw WHERE {_ZEROS} > 22
UNION ALL SELECT id_comptag, 'trop peu de jours' FROM hw GROUP BY 1 HAVING count(DISTINCT jour) < 900
UNION ALL SELECT DISTINCT id_comptag, 'accepte' FROM hw WHERE id_comptag IN (SELECT id_comptag FROM hw GROUP BY 1 HAVING count(DISTINCT jour) >= 900) AND (jour, id_comptag) NOT IN (SELECT (jour, id_comptag) FROM hw WHERE {_ZEROS} > 22)""")
def qc_report(spark, d):
    h = S.hw(spark, d)
    kept, removed = q.invalid_days(h, most_zeros=22)
    enough = q.min_days(h, 900).select("id_comptag").distinct()
    return q.report(kept.join(enough, "id_comptag", "left_semi"), {"jours invalides": removed, "trop peu de jours": h.join(enough, "id_comptag", "left_anti")}, "id_comptag")
