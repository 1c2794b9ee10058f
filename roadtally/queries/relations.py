"""Joins, windows, reshaping and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import standins as S
from ..operators import hourly as ho
from ..operators import joins as jo
from ..operators import reshape as rs
from ..operators import windows as wi
from ..schemas import HOURS, MONTHS
from .registry import query

_KEY = "(SELECT id_comptag, annee, min(id) AS id_comptag_uniq FROM comptage GROUP BY 1, 2)"


def incoming(spark, d):
    """Provider rows: every count under the id of the provider."""
    return S.comptage(spark, d).select("id", F.concat(F.lit("C"), (F.col("id") % 3000).cast("string")).alias("id_comptag"), "annee", "tmja")


_INCOMING = "(SELECT id, 'C' || (id % 3000) AS id_comptag, annee, tmja FROM comptage)"


@query(f"SELECT id, coalesce(id_gti, id_comptag) AS id_comptag, annee, tmja FROM {_INCOMING} i LEFT JOIN corresp ON id_gest = id_comptag")
def join_id_mapping(spark, d):
    return jo.id_mapping(incoming(spark, d), S.corresp(spark, d))


@query(f"SELECT id, id_comptag, id_comptag IN (SELECT id_comptag FROM compteur) AS connu FROM {_INCOMING}")
def join_known_unknown(spark, d):
    return jo.known_unknown(incoming(spark, d), S.compteur(spark, d), ["id_comptag"]).select("id", "id_comptag", "connu")


@query(f"SELECT id, (id_comptag, annee) IN (SELECT (id_comptag, annee) FROM comptage) AS connu FROM {_INCOMING}")
def join_known_unknown_year(spark, d):
    return jo.known_unknown(incoming(spark, d), S.comptage(spark, d), ["id_comptag", "annee"]).select("id", "connu")


@query(f"SELECT m.id_comptag, m.annee, m.mois, k.id_comptag_uniq FROM mensuel m LEFT JOIN {_KEY} k USING (id_comptag, annee)")
def join_count_key(spark, d):
    return jo.count_key(S.mensuel(spark, d), S.comptage(spark, d)).select("id_comptag", "annee", "mois", "id_comptag_uniq")


@query("SELECT c.id_comptag, k.id_comptag_uniq FROM compteur c LEFT JOIN (SELECT id_comptag, id AS id_comptag_uniq FROM comptage QUALIFY row_number() OVER (PARTITION BY id_comptag ORDER BY annee DESC, id) = 1) k USING (id_comptag)")
def join_count_key_latest(spark, d):
    return jo.count_key_latest(S.compteur(spark, d), S.comptage(spark, d)).select("id_comptag", "id_comptag_uniq")


@query("SELECT a.id, a.id_comptag AS id_cptag_ref, a.periode FROM comptage a JOIN (SELECT DISTINCT id_comptag, periode FROM comptage WHERE id % 7 = 0) r USING (id_comptag, periode)")
def join_assoc_key(spark, d):
    a = S.comptage(spark, d).select("id", F.col("id_comptag").alias("id_cptag_ref"), "periode")
    return jo.assoc_key(a, a.where("id % 7 = 0").select("id_cptag_ref", "periode").distinct())


def indicators(spark, d):
    """Stored indicators: most counts have a tmja."""
    c = S.comptage(spark, d).where("id % 5 <> 0").select(F.col("id").alias("id_comptag_uniq"), F.col("tmja").cast("double").alias("tmja"), "pc_pl")
    return c.unpivot("id_comptag_uniq", ["tmja", "pc_pl"], "indicateur", "valeur")


_INDIC = "(SELECT id AS id_comptag_uniq, 'tmja' AS indicateur, CAST(tmja AS DOUBLE) AS valeur FROM comptage WHERE id % 5 <> 0 UNION ALL SELECT id, 'pc_pl', pc_pl FROM comptage WHERE id % 5 <> 0)"


@query("SELECT id, id_comptag, annee FROM comptage WHERE id % 5 = 0")
def join_missing_traffic(spark, d):
    return jo.missing_traffic(S.comptage(spark, d), indicators(spark, d)).select("id", "id_comptag", "annee")


@query("""
SELECT id_comptag, arg_max(tmja, annee) FILTER (WHERE id_uniq % 2 = 0) AS tmja, max(annee) FILTER (WHERE id_uniq % 2 = 0) AS annee_tmja, arg_max(pc_pl, annee) AS pc_pl, max(annee) AS annee_pc_pl FROM annuel GROUP BY 1""")
def join_last_known_year(spark, d):
    return jo.last_known(S.annuel(spark, d).withColumn("tmja", F.when(F.col("id_uniq") % 2 == 0, F.col("tmja"))))


_TOTAL = " + ".join(HOURS)


@query(f"""
SELECT id_comptag, jour, tv, pl, round(pl / nullif(tv, 0) * 100, 2) AS pc_pl FROM (
  SELECT id_comptag, jour, sum({_TOTAL}) AS tv, sum(CASE WHEN indicateur = 'PL' THEN {_TOTAL} END) AS pl FROM hw GROUP BY 1, 2) WHERE pl IS NOT NULL""")
def join_tv_pl(spark, d):
    days = ho.directions(S.hw(spark, d)).withColumn("v", sum((F.col(h) for h in HOURS), F.lit(0.0)))
    return jo.tv_pl(days, ["id_comptag", "jour"], "v")


@query("SELECT id_comptag, c.type_poste, m.annee, m.mois, m.tmja FROM compteur c JOIN mensuel m USING (id_comptag)")
def join_month_wide(spark, d):
    return S.compteur(spark, d).select("id_comptag", "type_poste").join(S.mensuel(spark, d), "id_comptag").select("id_comptag", "type_poste", "annee", "mois", "tmja")


@query("""
SELECT id, coalesce(a.x, b.x) AS id_comptag FROM comptage
LEFT JOIN (SELECT id_comptag AS k, id_comptag AS x FROM compteur WHERE dep % 2 = 0) a ON a.k = comptage.id_comptag
LEFT JOIN (SELECT pr AS k, min(id_comptag) AS x FROM compteur GROUP BY 1) b ON b.k = comptage.id % 200""")
def join_fallback_key(spark, d):
    cat = S.compteur(spark, d).select(F.when(F.col("dep") % 2 == 0, F.col("id_comptag")).alias("cle1"), F.col("pr").cast("long").alias("cle2"), F.col("id_comptag").alias("found"))
    c = S.comptage(spark, d).select("id", "id_comptag")
    return jo.fallback_key(c, cat, F.col("id_comptag"), F.col("id") % 200, "found").select("id", F.col("found").alias("id_comptag"))


@query("SELECT c.id_comptag, route, 'ST' || pr AS station, 'G' || pr AS compteur FROM compteur c WHERE route <> 'D0' UNION ALL SELECT id_comptag, route, 'D0_ST' || pr, NULL FROM compteur WHERE route = 'D0'")
def join_station(spark, d):
    c = S.compteur(spark, d)
    files = c.select("id_comptag", "route", F.concat("route", F.lit("_ST"), F.col("pr").cast("string")).alias("fichier"))
    rules = c.select("route").distinct().where("route <> 'D0'").withColumn("prefixe", F.concat("route", F.lit("_")))
    stations = c.select(F.concat(F.lit("ST"), F.col("pr").cast("string")).alias("station"), F.concat(F.lit("G"), F.col("pr").cast("string")).alias("compteur")).distinct()
    return jo.station(files, rules, stations).drop("fichier")


@query("""
SELECT o.o_orderkey, coalesce(s.id_section, c.id_route) AS id_comptag FROM orders o
LEFT JOIN (SELECT n_nationkey * 60 AS section, 'S' || n_nationkey AS id_section FROM nation) s ON s.section = o.o_custkey
LEFT JOIN (SELECT route, min(id_comptag) AS id_route FROM compteur GROUP BY 1) c ON c.route = 'D' || (o.o_orderkey % 80)""")
def join_section_then_db(spark, d):
    o = S.table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("section"), F.concat(F.lit("D"), (F.col("o_orderkey") % 80).cast("string")).alias("route"))
    sections = S.table(spark, d, "nation").select((F.col("n_nationkey") * 60).cast("long").alias("section"), F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("id_section"))
    cat = S.compteur(spark, d).groupBy("route").agg(F.min("id_comptag").alias("id_route"))
    return jo.section_then_catalogue(o, sections, cat).select("o_orderkey", "id_comptag")


@query("SELECT id_comptag, CAST(h AS INTEGER) AS heure, k AS type_veh, 'sens' || s AS sens FROM compteur, range(24) AS r(h), (VALUES ('VL'), ('PL'), ('2R')) AS v(k), (VALUES (1), (2)) AS w(s)")
def join_cross_complete(spark, d):
    return jo.cross_complete(S.compteur(spark, d), "id_comptag", range(24), ["VL", "PL", "2R"], ["sens1", "sens2"])


@query("SELECT id_comptag, jour, indicateur, sens FROM hw WHERE (id_comptag, jour) NOT IN (SELECT (id_comptag, jour) FROM horaire WHERE valeur > 49)")
def join_anti_pairs(spark, d):
    bad = S.horaire(spark, d).where("valeur > 49").select("id_comptag", "jour").distinct()
    return jo.anti_pairs(S.hw(spark, d), bad, ["id_comptag", "jour"]).select("id_comptag", "jour", "indicateur", "sens")


@query("SELECT coalesce(a.k, b.k) AS cle, CASE WHEN a.k IS NULL THEN 'droite' WHEN b.k IS NULL THEN 'gauche' ELSE 'deux' END AS presence FROM (SELECT DISTINCT o_custkey AS k FROM orders) a FULL JOIN (SELECT c_custkey AS k FROM customer WHERE c_custkey % 2 = 0) b ON a.k = b.k")
def join_set_reconcile(spark, d):
    return jo.reconcile(S.table(spark, d, "orders").select(F.col("o_custkey").alias("cle")), S.table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("cle")), "cle")


@query("SELECT id, k.i AS id_point FROM comptage LEFT JOIN (SELECT round(pr / 100, 2) AS v, min(id_comptag) AS i FROM compteur GROUP BY 1) k ON round(id % 90 / 100, 2) = k.v")
def join_counter_from_points(spark, d):
    points = S.compteur(spark, d).withColumn("pr_deb", F.col("pr") / 100)
    c = S.comptage(spark, d).select("id", (F.col("id") % 90 / 100).alias("pr_deb"))
    return jo.from_points(c, points, "pr_deb").select("id", "id_point")


@query("SELECT id_comptag, CASE WHEN dep % 2 = 0 THEN 'rue ' || route ELSE 'main ' || pr END AS adresse FROM compteur")
def join_manual_address(spark, d):
    c = S.compteur(spark, d)
    manual = c.select("id_comptag", F.concat(F.lit("main "), F.col("pr").cast("string")).alias("adresse"))
    return jo.manual_address(c.select("id_comptag", F.when(F.col("dep") % 2 == 0, F.concat(F.lit("rue "), "route")).alias("adresse")), manual)


@query(f"SELECT c.id_comptag, c.annee, i.indicateur, i.valeur, CASE WHEN c.id % 4 = 1 THEN 'faible' END AS qualite FROM {_INDIC} i JOIN comptage c ON c.id = i.id_comptag_uniq")
def join_counter_quality(spark, d):
    q = S.comptage(spark, d).where("id % 4 = 1").select(F.col("id").alias("id_comptag_uniq"), F.lit("faible").alias("qualite"))
    return jo.counter_quality(indicators(spark, d), S.comptage(spark, d), q).select("id_comptag", "annee", "indicateur", "valeur", "qualite")


@query("SELECT DISTINCT 'pont' || (id % 25) AS cle, tmja % 7 AS janv, 'L' || (id % 25) AS voie FROM comptage WHERE id % 25 IN (SELECT dep FROM compteur)")
def join_lane_monthly(spark, d):
    sheet = S.comptage(spark, d).select(F.concat(F.lit(" PONT"), (F.col("id") % 25).cast("string")).alias("cle"), (F.col("tmja") % 7).alias("janv"))
    lanes = S.compteur(spark, d).select(F.concat(F.lit("pont"), F.col("dep").cast("string")).alias("cle"), F.concat(F.lit("L"), F.col("dep").cast("string")).alias("voie")).distinct()
    return jo.lane_monthly(sheet, lanes, ["janv"])


@query(f"SELECT c.id_comptag, c.annee, i.* FROM comptage c JOIN {_INDIC} i ON i.id_comptag_uniq = c.id WHERE c.id_comptag = 'C7' AND c.annee = 1995 AND i.indicateur IN ('tmja')")
def join_indicator_series(spark, d):
    return jo.indicator_series(S.comptage(spark, d), indicators(spark, d), "C7", ["tmja"], 1995)


@query("SELECT id_comptag, dep AS zone, n_name AS nom FROM compteur LEFT JOIN nation ON n_nationkey = dep")
def join_zone_number(spark, d):
    c = S.compteur(spark, d).select("id_comptag", F.concat(F.lit("point de la zone "), F.col("dep").cast("string"), F.lit(" nord")).alias("obs"))
    zones = S.table(spark, d, "nation").select(F.col("n_nationkey").alias("zone"), F.col("n_name").alias("nom"))
    return jo.zone_number(c, zones).drop("obs")


@query("SELECT id, id_comptag, annee, tmja FROM comptage QUALIFY row_number() OVER (PARTITION BY id_comptag ORDER BY annee DESC, tmja DESC, id) = 1")
def win_top1(spark, d):
    return jo.ranked_first(S.comptage(spark, d).select("id", "id_comptag", "annee", "tmja"), ["id_comptag"], F.desc("annee"), F.desc("tmja"), F.col("id"))


@query("SELECT id, id_comptag, pc_pl FROM comptage QUALIFY rank() OVER (PARTITION BY id_comptag ORDER BY pc_pl DESC) = 1")
def win_group_max(spark, d):
    return wi.group_max(S.comptage(spark, d).select("id", "id_comptag", "pc_pl"), ["id_comptag"], "pc_pl")


@query("SELECT id, id_comptag, row_number() OVER (PARTITION BY id_comptag ORDER BY annee, id) + coalesce(m, 0) AS rang FROM comptage LEFT JOIN (SELECT id_comptag, max(pr) AS m FROM compteur GROUP BY 1) USING (id_comptag)")
def win_rank_in_ref(spark, d):
    stored = S.compteur(spark, d).select("id_comptag", F.col("pr").alias("rang"))
    return wi.rank_in_reference(S.comptage(spark, d), stored, "id_comptag", F.col("annee"), F.col("id")).select("id", "id_comptag", "rang")


@query("SELECT id, count(*) OVER (PARTITION BY id_comptag, annee) AS n FROM comptage")
def win_count_partition(spark, d):
    return wi.count_partition(S.comptage(spark, d), ["id_comptag", "annee"]).select("id", "n")


@query("""
SELECT id, last_value(CASE WHEN id % 5 = 0 THEN src END IGNORE NULLS) OVER (PARTITION BY id_comptag ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS src,
       first_value(CASE WHEN id % 5 = 0 THEN annee END IGNORE NULLS) OVER (PARTITION BY id_comptag ORDER BY id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS annee FROM comptage""")
def win_fill_forward(spark, d):
    some = lambda c: F.when(F.col("id") % 5 == 0, F.col(c))
    c = S.comptage(spark, d).select("id", "id_comptag", some("src").alias("src"), some("annee").alias("annee"))
    return wi.fill_back(wi.fill_forward(c, ["id_comptag"], "id", "src"), ["id_comptag"], "id", "annee").select("id", "src", "annee")


@query("""
SELECT event_id, CAST(coalesce(sum(f) OVER (PARTITION BY id_comptag ORDER BY event_id ROWS UNBOUNDED PRECEDING), 0) AS BIGINT) AS mois_ecoules FROM (
  SELECT event_id, id_comptag, CASE WHEN day(date_heure) < lag(day(date_heure)) OVER (PARTITION BY id_comptag ORDER BY event_id) THEN 1 ELSE 0 END AS f FROM passages)""")
def win_day_rollover(spark, d):
    p = S.passages(spark, d).withColumn("day", F.dayofmonth("date_heure"))
    return wi.day_rollover(p, ["id_comptag"], "event_id", "day").select("event_id", "mois_ecoules")


@query("SELECT id, count(*) OVER (PARTITION BY id_comptag, periode) > 1 AS doublon FROM comptage")
def win_duplicates(spark, d):
    return wi.duplicates(S.comptage(spark, d), ["id_comptag", "periode"]).select("id", "doublon")


@query("SELECT min(id) AS id, id_comptag, periode FROM comptage GROUP BY 2, 3")
def win_drop_duplicates(spark, d):
    return wi.drop_duplicates(S.comptage(spark, d).select("id", "id_comptag", "periode"), ["id_comptag", "periode"], F.col("id"))


@query("""
SELECT event_id, CASE WHEN n = 8 AND tb >= ta AND j = jb THEN date_heure - to_days(jb - ja) WHEN n <= 8 AND NOT (n = 8 AND tb >= ta) AND j = ja THEN date_heure + to_days(jb - ja) ELSE date_heure END AS date_heure
FROM (SELECT event_id, date_heure, CAST(date_heure AS DATE) AS j, CAST(date_heure AS TIME) AS t, CAST(a AS DATE) AS ja, CAST(b AS DATE) AS jb, CAST(a AS TIME) AS ta, CAST(b AS TIME) AS tb, n
      FROM campagnes JOIN (SELECT id_comptag, min(date_heure) AS a, max(date_heure) AS b, count(DISTINCT CAST(date_heure AS DATE)) AS n FROM campagnes GROUP BY 1) USING (id_comptag))
WHERE NOT ((n > 8 AND (j = ja OR j = jb)) OR (n = 8 AND tb >= ta AND j = ja AND t <= tb))""")
def win_time_merge(spark, d):
    from ..operators.vehicles import time_merge

    return time_merge(S.campagnes(spark, d)).select("event_id", "date_heure")


@query("SELECT id_comptag, jour, indicateur FROM hw ORDER BY id_comptag, jour, indicateur")
def sort_keys(spark, d):
    return S.hw(spark, d).select("id_comptag", "jour", "indicateur").orderBy("id_comptag", "jour", "indicateur")


@query("SELECT s_suppkey AS id, s_suppkey % 7 = 0 AS bretelle, round(s_acctbal, 2) AS longueur FROM supplier ORDER BY 2 DESC, 3 DESC, 1 LIMIT 20")
def topk_longest_edges(spark, d):
    e = S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 7 == 0).alias("bretelle"), F.round("s_acctbal", 2).alias("longueur"))
    return rs.longest_edges(e, 20)


@query("SELECT id_comptag, annee, tmja, NULL AS mois FROM annuel UNION ALL SELECT id_comptag, annee, tmja, mois FROM mensuel")
def set_union(spark, d):
    return rs.union_tables(S.annuel(spark, d).select("id_comptag", "annee", F.col("tmja").cast("double").alias("tmja")), S.mensuel(spark, d).select("id_comptag", "annee", "tmja", "mois"))


@query("SELECT DISTINCT id_comptag, annee FROM comptage")
def set_distinct(spark, d):
    return S.comptage(spark, d).select("id_comptag", "annee").distinct()


@query("SELECT id FROM comptage WHERE id_comptag NOT IN (SELECT id_comptag FROM compteur WHERE dep % 2 = 0)")
def set_except(spark, d):
    return jo.anti_pairs(S.comptage(spark, d), S.compteur(spark, d).where("dep % 2 = 0"), ["id_comptag"]).select("id")


@query("SELECT id_comptag FROM comptage INTERSECT SELECT id_comptag FROM compteur")
def set_intersect(spark, d):
    return S.comptage(spark, d).select("id_comptag").intersect(S.compteur(spark, d).select("id_comptag"))


@query(f"SELECT id_comptag_uniq, 'tmja' AS indicateur, CAST(tmja AS DOUBLE) AS valeur FROM annuel JOIN {_KEY} USING (id_comptag, annee) UNION ALL SELECT id_comptag_uniq, 'pc_pl', pc_pl FROM annuel JOIN {_KEY} USING (id_comptag, annee) WHERE annee % 2 = 0")
def rs_unpivot_annual(spark, d):
    a = S.annuel(spark, d).withColumn("pc_pl", F.when(F.col("annee") % 2 == 0, F.col("pc_pl")))
    return rs.unpivot_annual(a, S.comptage(spark, d), ["tmja", "pc_pl"])


_MONTH = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"


@query(f"SELECT id_comptag, annee, ({_MONTH})[mois] AS mois, tmja AS valeur FROM mensuel")
def rs_unpivot_monthly(spark, d):
    wide = rs.months_pivot(S.mensuel(spark, d), ["id_comptag", "annee"], "tmja")
    return rs.unpivot_monthly(wide, ["id_comptag", "annee"])


@query(f"SELECT id_comptag_uniq, jour, indicateur, {', '.join(HOURS)}, fichier FROM hw JOIN {_KEY} USING (id_comptag, annee)")
def rs_hourly_table(spark, d):
    return rs.hourly_table(S.hw(spark, d), S.comptage(spark, d))


@query("SELECT a.id AS id_assoc, 'tmja' AS indicateur, CAST(b.tmja AS DOUBLE) AS valeur FROM comptage a JOIN comptage b ON a.id_comptag = b.id_comptag AND a.periode = b.periode WHERE a.id % 2 = 0 UNION ALL SELECT a.id, 'pc_pl', b.pc_pl FROM comptage a JOIN comptage b ON a.id_comptag = b.id_comptag AND a.periode = b.periode WHERE a.id % 2 = 0")
def rs_unpivot_assoc(spark, d):
    c = S.comptage(spark, d).withColumnRenamed("id_comptag", "id_cptag_ref")
    return rs.unpivot_assoc(c.select("id_cptag_ref", "periode", "tmja", "pc_pl"), c.where("id % 2 = 0"), ["tmja", "pc_pl"])


_PIVOT = ", ".join(f"count(*) FILTER (WHERE hour(date_heure) = {h}) AS {c}" for h, c in enumerate(HOURS))


@query(f"SELECT id_comptag, CAST(date_heure AS DATE) AS jour, 'TV' AS indicateur, {_PIVOT} FROM passages GROUP BY 1, 2 UNION ALL SELECT id_comptag, CAST(date_heure AS DATE), 'PL', {_PIVOT} FROM passages WHERE type_veh = 'PL' GROUP BY 1, 2")
def rs_hour_pivot(spark, d):
    long = S.passages(spark, d).select("id_comptag", F.to_date("date_heure").alias("jour"), "type_veh", F.hour("date_heure").alias("heure"), F.lit(1).alias("valeur"))
    return rs.hour_pivot(long, ["id_comptag", "jour"])


@query("SELECT h.id_comptag, h.jour, h.indicateur, h.sens, CAST(r.heure AS INTEGER) AS heure, coalesce(v.valeur, 0) AS valeur FROM hw h CROSS JOIN range(24) AS r(heure) LEFT JOIN horaire v ON v.id_comptag = h.id_comptag AND v.jour = h.jour AND v.indicateur = h.indicateur AND v.sens = h.sens AND v.heure = r.heure")
def rs_hour_unpivot(spark, d):
    return ho.unpivot_hours(S.hw(spark, d), ["id_comptag", "jour", "indicateur", "sens"])


@query("SELECT id_comptag, annee, unnest(['janv', 'janv', 'fevr']) AS mois, unnest(['tmja', 'pc_pl', 'tmja']) AS indicateur, unnest([CAST(tmja AS DOUBLE), pc_pl, tmja + 1.0]) AS valeur FROM annuel")
def rs_month_prefix(spark, d):
    a = S.annuel(spark, d).select("id_comptag", "annee", F.col("tmja").cast("double").alias("janv_tmja"), F.col("pc_pl").alias("janv_pc_pl"), (F.col("tmja") + 1.0).alias("fevr_tmja"))
    return rs.month_prefix(a, ["id_comptag", "annee"], ["janv_tmja", "janv_pc_pl", "fevr_tmja"])


@query(f"SELECT id_comptag, annee, ({_MONTH})[3 * q + k] AS mois, tmja + q AS valeur FROM annuel, (VALUES (0), (1), (2), (3)) AS x(q), (VALUES (1), (2), (3)) AS y(k)")
def rs_quarter_to_months(spark, d):
    a = S.annuel(spark, d)
    return rs.quarter_to_months(a.select("id_comptag", "annee", *[(F.col("tmja") + q).alias(f"t{q + 1}") for q in range(4)]), ["id_comptag", "annee"])


@query(f"""
SELECT id, r AS rang, ({_MONTH})[month(CASE WHEN date_trunc('month', a) = date_trunc('month', a + 7) OR CAST(date_trunc('month', a + 7) AS DATE) - a >= (a + 7) - CAST(date_trunc('month', a + 7) AS DATE) + 1 THEN a ELSE a + 7 END)] AS mois, tmja, pc_pl
FROM (SELECT id, 0 AS r, debut AS a, tmja, pc_pl FROM comptage UNION ALL SELECT id, 1, debut + 100, tmja + 1, pc_pl FROM comptage WHERE id % 2 = 0)""")
def rs_periods_to_months(spark, d):
    text = lambda c: F.date_format(c, "yyyy/MM/dd")
    c = S.comptage(spark, d).withColumns({"p2": F.when(F.col("id") % 2 == 0, F.concat(text(F.date_add("debut", 100)), F.lit("-"), text(F.date_add("debut", 107)))), "t2": F.col("tmja") + 1})
    return rs.periods_to_months(c, ["id"], [("periode", "tmja", "pc_pl"), ("p2", "t2", "pc_pl")])


@query("SELECT src AS zone, CASE WHEN annee < 1995 THEN 'autr' ELSE CAST(annee AS VARCHAR) END AS periode, arg_max(tmja, annee * 100000000 + id) AS tmja FROM comptage GROUP BY ALL")
def rs_year_pivot(spark, d):
    return rs.year_long(S.comptage(spark, d).withColumnRenamed("src", "zone"), "zone", since=1995)


@query("""
SELECT 'f' || s_suppkey AS file, CAST(b AS INTEGER) AS bloc, CAST(h AS INTEGER) AS heure, CAST(s_suppkey + h AS DOUBLE) AS tv, CAST(s_nationkey * h AS DOUBLE) AS pl
FROM supplier, range(2) AS x(b), range(24) AS y(h) WHERE b < 1 + s_suppkey % 2""")
def rs_daily_blocks(spark, d):
    # a sheet of each supplier: two blocks of 34 lines from line 8 on; even ones end with a mean after the first
    s = S.table(spark, d, "supplier").select(F.concat(F.lit("f"), F.col("s_suppkey").cast("string")).alias("file"), "s_suppkey", "s_nationkey")
    cells = s.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(1)))).withColumn("h", F.explode(F.sequence(F.lit(-1), F.lit(32)))).withColumn("col", F.explode(F.array(F.lit(0), F.lit(1))))
    value = F.when((F.col("h") < 0) | (F.col("h") > 23), F.when((F.col("h") == 24) & (F.col("b") == 0) & (F.col("s_suppkey") % 2 == 0), "Moyenne").otherwise("texte")).otherwise(F.when(F.col("col") == 0, F.col("s_suppkey") + F.col("h")).otherwise(F.col("s_nationkey") * F.col("h")).cast("string"))
    return rs.daily_blocks(cells.select("file", (8 + 34 * F.col("b") + F.col("h")).alias("line"), "col", value.alias("value")), 8, 34)


@query("SELECT id_comptag, annee, mois, unnest(['tmja', 'pc_pl']) AS indicateur, unnest([tmja, CASE WHEN mois % 4 = 0 THEN -99 ELSE pc_pl END]) AS valeur FROM mensuel WHERE id_comptag <> 'C3'")
def rs_monthly_final(spark, d):
    m = S.mensuel(spark, d).withColumn("pc_pl", F.when(F.col("mois") % 4 != 0, F.col("pc_pl"))).unpivot(["id_comptag", "annee", "mois"], ["tmja", "pc_pl"], "indicateur", "valeur")
    return rs.monthly_final(m, S.compteur(spark, d).where("id_comptag = 'C3'").select("id_comptag"))
