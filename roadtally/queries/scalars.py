"""Projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import standins as S
from ..functions import scalars as fn
from ..operators import projections as prj
from ..schemas import HOLIDAYS, MONTHS, TABLES
from .registry import query

_HOLIDAYS = ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in HOLIDAYS)
IN_HOLIDAYS = f"EXISTS (SELECT 1 FROM (VALUES {_HOLIDAYS}) AS h(a, b) WHERE debut <= h.b AND fin >= h.a)"
_MONTHS = "[" + ", ".join(f"'{m}'" for m in MONTHS) + "]"


@query("SELECT s_suppkey, lower(replace(replace(replace(replace(replace(s_name, '#', 'é'), ' ', ''), '_', ''), '-', ''), 'é', 'e')) AS label FROM supplier")
def fn_normalise_label(spark, d):
    return S.table(spark, d, "supplier").select("s_suppkey", fn.normalise_label(F.replace("s_name", F.lit("#"), F.lit("É"))).alias("label"))


@query("SELECT s_suppkey AS cle_du_compteur, s_acctbal AS pc_pl_annee FROM supplier")
def fn_normalise_columns(spark, d):
    s = S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("Clé du Compteur"), F.col("s_acctbal").alias("%PL année"))
    return fn.normalise_columns(s)


@query("SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'N' ELSE 'D' END || (s_suppkey % 997) AS route FROM supplier")
def fn_route_name(spark, d):
    k = F.col("s_suppkey")
    raw = F.concat(F.when(k % 3 == 0, "rd ").when(k % 3 == 1, "RN-").otherwise("d_"), F.lpad((k % 997).cast("string"), 5, "0"))
    return S.table(spark, d, "supplier").select("s_suppkey", fn.route_name(raw).alias("route"))


@query("SELECT id_comptag, dep || '-' || route || '-' || pr || '+' || abs AS id FROM compteur")
def fn_id_comptag(spark, d):
    return S.compteur(spark, d).select("id_comptag", fn.id_comptag(F.col("dep"), F.col("route"), F.col("pr"), F.col("abs")).alias("id"))


@query("SELECT id_comptag, 'Ville_' || dep || '-rue_de_' || route || '-' || printf('%.4f;%.4f', x / 100, y / 10) AS id FROM compteur")
def fn_id_comptag_city(spark, d):
    c = S.compteur(spark, d)
    return c.select("id_comptag", fn.id_comptag_city(F.concat(F.lit("Ville - "), F.col("dep").cast("string")), F.concat(F.lit("rue de "), "route"), F.col("x") / 100, F.col("y") / 10).alias("id"))


@query("SELECT id_comptag, CASE WHEN dep % 2 = 0 THEN -1 ELSE 1 END * CAST(printf('%.4f', x / 100 + 1) AS DOUBLE) AS lon, CAST(printf('%.4f', y / 10) AS DOUBLE) AS lat FROM compteur")
def fn_coords_from_id(spark, d):
    sign = F.when(F.col("dep") % 2 == 0, -1).otherwise(1)
    c = S.compteur(spark, d).withColumn("id", fn.id_comptag_city(F.lit("Ville"), F.col("route"), sign * (F.col("x") / 100 + 1), F.col("y") / 10))
    return c.select("id_comptag", fn.coords_from_id(F.col("id")).alias("p")).select("id_comptag", "p.lon", "p.lat")


@query("""
SELECT id_comptag, pr AS pr1, abs AS abs1, pr AS pr2, CAST(rpad(CAST(dep AS VARCHAR), 4, '0') AS INTEGER) AS abs2, pr AS pr3, 0 AS abs3,
       CAST(tmja // 1000 AS INTEGER) AS pr4, tmja % 1000 AS abs4 FROM compteur""")
def fn_parse_pr_abs(spark, d):
    pr = F.col("pr").cast("string")
    c = S.compteur(spark, d).select(
        "id_comptag", fn.parse_pr_abs(F.concat(pr, F.lit("+"), F.col("abs").cast("string"))).alias("a"), fn.parse_pr_abs(F.concat(pr, F.lit(","), F.col("dep").cast("string"))).alias("b"),
        fn.parse_pr_abs(pr).alias("c"), fn.split_distance(F.col("tmja")).alias("e"),
    )
    pairs = [F.col(f"{n}.{f}").alias(f"{f}{k}") for k, n in enumerate("abce", 1) for f in ("pr", "abs")]
    return c.select("id_comptag", *pairs)


@query("SELECT id_comptag, CASE WHEN dep % 4 = 0 THEN NULL ELSE route END AS route, CASE WHEN dep % 4 = 0 THEN NULL ELSE pr END AS pr, CASE WHEN dep % 4 = 0 THEN NULL ELSE abs END AS abs FROM compteur")
def fn_pr_from_filename(spark, d):
    name = F.when(F.col("dep") % 4 == 0, "plan.txt").otherwise(F.concat(F.lit("R"), "route", F.lit("_PR"), F.col("pr").cast("string"), F.lit("+"), F.col("abs").cast("string"), F.lit("_sens1.txt")))
    return S.compteur(spark, d).select("id_comptag", fn.pr_from_filename(name).alias("p")).select("id_comptag", "p.*")


@query("""
SELECT id_comptag, CASE WHEN dep % 5 = 0 THEN NULL ELSE pc_pl END AS number, CAST(tmja AS DOUBLE) AS tmja, CASE WHEN dep % 2 = 0 THEN 0.0 ELSE pc_pl END AS pc_pl FROM compteur""")
def fn_number_fr(spark, d):
    c = S.compteur(spark, d)
    share = F.concat(F.translate(F.col("pc_pl").cast("string"), ".", ","), F.lit(" %"))
    cell = F.concat(F.col("tmja").cast("string"), F.lit("\n"), F.when(F.col("dep") % 2 == 0, "x").otherwise(share))
    return c.select("id_comptag", fn.number_fr(F.when(F.col("dep") % 5 == 0, "n.c.").otherwise(share)).alias("number"), fn.tmja_and_share(cell).alias("t")).select("id_comptag", "number", "t.*")


@query("SELECT id_comptag, CASE WHEN pc_pl / 25 < 1 THEN pc_pl / 25 * 100 ELSE pc_pl / 25 END AS percent, CASE WHEN pc_pl / 25 < 1 THEN 'pc_pl' ELSE 'tmja' END AS kind FROM compteur")
def fn_ratio_to_percent(spark, d):
    v = F.col("pc_pl") / 25
    return S.compteur(spark, d).select("id_comptag", fn.ratio_to_percent(v).alias("percent"), fn.row_kind(v).alias("kind"))


@query("""
SELECT id, strftime(debut, '%Y/%m/%d') || '-' || CASE WHEN id % 3 = 0 THEN '??' ELSE strftime(fin, '%Y/%m/%d') END || CASE WHEN id % 2 = 0 THEN ' ; ' || strftime(fin, '%Y/%m/%d') || '-' || strftime(fin + 7, '%Y/%m/%d') ELSE '' END AS periode FROM comptage""")
def fn_period_build(spark, d):
    first = fn.period_text(F.col("debut"), F.when(F.col("id") % 3 != 0, F.col("fin")))
    second = F.when(F.col("id") % 2 == 0, fn.period_text(F.col("fin"), F.date_add("fin", 7)))
    return S.comptage(spark, d).select("id", fn.period_join(first, second, fn.period_text(F.lit(None).cast("date"), F.lit(None).cast("date"))).alias("periode"))


@query("SELECT id, id % 3 <> 0 AS valid FROM comptage")
def fn_period_validate(spark, d):
    text = F.when(F.col("id") % 3 == 0, F.translate("periode", "/", "-")).when(F.col("id") % 3 == 1, F.col("periode")).otherwise(F.concat_ws(" ; ", "periode", "periode"))
    return S.comptage(spark, d).select("id", fn.period_valid(text).alias("valid"))


@query("SELECT id, debut, fin FROM comptage UNION ALL SELECT id, debut, fin FROM comptage WHERE id % 2 = 0")
def fn_period_explode(spark, d):
    text = F.when(F.col("id") % 2 == 0, F.concat_ws(" ; ", "periode", "periode")).otherwise(F.col("periode"))
    return S.comptage(spark, d).select("id", F.explode(fn.period_parts(text)).alias("p")).select("id", "p.*")


@query("SELECT id, CAST(date_trunc('week', debut) AS DATE) AS debut, CAST(date_trunc('week', debut) AS DATE) + 6 AS fin FROM comptage")
def fn_period_iso_week(spark, d):
    year = F.extract(F.lit("YEAROFWEEK"), F.col("debut"))
    return S.comptage(spark, d).select("id", fn.iso_week(year, F.weekofyear("debut")).alias("p")).select("id", "p.*")


@query("""
SELECT id, arg_max(m, n * 100000 - epoch(m) / 86400) AS month FROM (
  SELECT id, CAST(date_trunc('month', u.x) AS DATE) AS m, count(*) AS n FROM comptage, unnest(generate_series(debut, fin, INTERVAL 1 DAY)) AS u(x) GROUP BY ALL) GROUP BY id""")
def fn_period_major_month(spark, d):
    return fn.major_month(S.comptage(spark, d), "id", "debut", "fin")


@query(f"SELECT id, {IN_HOLIDAYS} AS vacances FROM comptage")
def fn_holiday_overlap(spark, d):
    return S.comptage(spark, d).select("id", fn.overlaps_holidays(F.col("debut"), F.col("fin")).alias("vacances"))


@query("SELECT id FROM comptage WHERE id % 10 = 0 OR NOT (month(debut) IN (7, 8) OR month(fin) IN (7, 8))")
def flt_summer(spark, d):
    known = lambda c: F.when(F.col("id") % 10 != 0, F.col(c))
    return S.comptage(spark, d).where(fn.outside_summer(known("debut"), known("fin"))).select("id")


@query("SELECT event_id, CASE WHEN user_id % 20 IN (1, 12) THEN 'VL' WHEN user_id % 20 = 13 THEN '2R' ELSE 'PL' END AS type_veh FROM events")
def fn_vehicle_class(spark, d):
    return S.table(spark, d, "events").select("event_id", fn.vehicle_class(F.col("user_id") % 20).alias("type_veh"))


@query("SELECT event_id, CASE WHEN user_id % 7 = 0 OR value < 7.2 THEN 'VL' ELSE 'PL' END AS type_veh FROM events")
def fn_vehicle_class_length(spark, d):
    return S.table(spark, d, "events").select("event_id", fn.vehicle_class_length(F.when(F.col("user_id") % 7 != 0, F.col("value"))).alias("type_veh"))


@query("""
SELECT event_id, CASE WHEN n % 3 = 0 THEN type_veh WHEN n % 3 = 2 AND vitesse <= 10 + n THEN '2R' WHEN vitesse >= 50 + n THEN 'PL' ELSE 'VL' END AS type_veh
FROM (SELECT *, CAST(substr(id_comptag, 2) AS INTEGER) AS n FROM passages)""")
def fn_vehicle_class_ser(spark, d):
    p = S.passages(spark, d)
    # thresholds of each station: a table as long as the list of stations
    n = F.col("station").substr(F.lit(2), F.lit(9)).cast("int")
    stations = p.select(F.col("id_comptag").alias("station")).distinct().withColumns({"heavy": F.when(n % 3 != 0, 50 + n), "two": F.when(n % 3 == 2, 10 + n)})
    joined = p.join(stations, p["id_comptag"] == stations["station"], "left")
    return joined.select("event_id", fn.vehicle_class_ser(F.col("type_veh"), F.col("vitesse"), F.col("heavy"), F.col("two")).alias("type_veh"))


@query("""
SELECT id_comptag, CASE WHEN v IN (30, 50, 60, 70, 80, 90, 100, 110, 130) THEN v END AS vma_vl,
       CASE v WHEN 130 THEN 90 WHEN 110 THEN 90 WHEN 100 THEN 80 WHEN 90 THEN 80 WHEN 80 THEN 80 WHEN 70 THEN 70 WHEN 60 THEN 60 WHEN 50 THEN 50 WHEN 30 THEN 30 END AS vma_pl
FROM (SELECT id_comptag, 20 + dep % 12 * 10 AS v FROM compteur)""")
def fn_speed_limit(spark, d):
    text = F.concat((20 + F.col("dep") % 12 * 10).cast("string"), F.lit("/80"))
    return S.compteur(spark, d).select("id_comptag", fn.speed_limit(text).alias("v")).select("id_comptag", "v.*")


@query("""
SELECT event_id, CASE WHEN vitesse <= 0 THEN NULL WHEN vitesse <= 20 THEN '(0,20]' WHEN vitesse <= 110 THEN '(' || CAST(ceil(vitesse / 10) * 10 - 10 AS INTEGER) || ',' || CAST(ceil(vitesse / 10) * 10 AS INTEGER) || ']'
       WHEN vitesse <= 9999 THEN '(110,9999]' END AS classe FROM passages""")
def fn_speed_bins(spark, d):
    return S.passages(spark, d).select("event_id", fn.speed_bin(F.col("vitesse")).alias("classe"))


@query("SELECT event_id, CASE event_type WHEN 'click' THEN 'TV' WHEN 'purchase' THEN 'PL' ELSE event_type END AS mesure, 1 + user_id % 2 AS sens FROM events")
def fn_code_map(spark, d):
    direction = fn.code_map((F.col("user_id") % 2).cast("string"), {"0": "1", "1": "2"}).cast("int")
    return S.table(spark, d, "events").select("event_id", fn.code_map(F.col("event_type"), {"click": "TV", "purchase": "PL"}).alias("mesure"), direction.alias("sens"))


@query(f"SELECT o_orderkey, ({_MONTHS})[month(o_orderdate)] AS by_number, ({_MONTHS})[month(o_orderdate)] AS by_name FROM orders")
def fn_month_key(spark, d):
    names = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Sept.", "Octobre", "NOVEMBRE", "Décembre"]
    name = F.get(F.array(*[F.lit(n) for n in names]), F.month("o_orderdate") - 1)
    return S.table(spark, d, "orders").select("o_orderkey", fn.month_key(F.month("o_orderdate").cast("string")).alias("by_number"), fn.month_key(name).alias("by_name"))


@query("SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, coalesce(nullif(l_discount, 0), -99) AS marked FROM lineitem")
def fn_zero_to_null(spark, d):
    v = fn.zero_to_null(F.col("l_discount"))
    return S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", fn.sentinel_to_null(fn.null_to_sentinel(v)).alias("discount"), fn.null_to_sentinel(v).alias("marked"))


@query("SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN 'new' END, CASE WHEN id % 2 = 0 THEN id_comptag END, 'none') AS id_ref FROM comptage")
def fn_priority_coalesce(spark, d):
    return S.comptage(spark, d).select("id", prj.priority_coalesce(F.when(F.col("id") % 3 == 0, "new"), F.when(F.col("id") % 2 == 0, F.col("id_comptag")), F.lit("none")).alias("id_ref"))


@query(f"SELECT id, CASE WHEN {IN_HOLIDAYS} THEN src || ' ; compte pendant les vacances' ELSE src END AS obs FROM comptage")
def fn_holiday_note(spark, d):
    return S.comptage(spark, d).select("id", fn.holiday_note(F.col("src"), fn.overlaps_holidays(F.col("debut"), F.col("fin"))).alias("obs"))


@query("""
SELECT id_comptag, 'Pont ' || dep AS site, 'V' || k AS voie, 'L' || (tmja + k) AS id_voie, 'pont' || dep || 'v' || k AS cle FROM compteur, (VALUES (1), (2)) AS v(k)""")
def fn_explode_lanes(spark, d):
    obs = F.concat(F.lit("voie : V1, V2 ; nom_site : Pont "), F.col("dep").cast("string"))
    lanes = F.concat_ws(",", *[F.concat(F.lit("L"), (F.col("tmja") + k).cast("string")) for k in (1, 2)])
    return fn.explode_lanes(S.compteur(spark, d).withColumns({"obs": obs, "lanes": lanes}), "id_comptag", "obs", "lanes")


@query("SELECT DISTINCT heure, 'h' || heure || '_' || (heure + 1) AS label, heure AS back FROM horaire")
def fn_hour_label(spark, d):
    h = S.horaire(spark, d).select("heure").distinct().withColumn("label", fn.hour_label(F.col("heure")))
    return h.withColumn("back", fn.hour_of_label(F.regexp_replace("label", "^h", "")))


@query("SELECT event_id, isodow(date_heure) - 1 AS jour, dayofyear(date_heure) AS jour_annee, hour(date_heure) AS heure, CAST(date_heure AS DATE) AS date FROM passages")
def fn_time_fields(spark, d):
    return S.passages(spark, d).select("event_id", *fn.time_fields(F.col("date_heure")))


@query("SELECT id_comptag, pr AS numero, 'rue ' || lower(route) AS rue FROM compteur")
def fn_address_number(spark, d):
    text = F.concat(F.when(F.col("dep") % 2 == 0, "Poste numéro ").otherwise("Au n°"), F.col("pr").cast("string"), F.lit(" rue "), F.lower("route"))
    return S.compteur(spark, d).select("id_comptag", fn.address_number(text).alias("a")).select("id_comptag", "a.*")


@query("SELECT id_comptag, 'site' || pr AS dossier FROM compteur")
def fn_reference_folder(spark, d):
    site = F.concat(F.lit("site"), F.col("pr").cast("string"))
    before = F.when(F.col("dep") % 4 < 2, "/data/en_cours/").when(F.col("dep") % 4 == 2, "D:\\en_cours\\lot\\").otherwise("/data/en_cours/lot/")
    after = F.when(F.col("dep") % 4 == 0, "/vers nord/a.mdb").when(F.col("dep") % 4 == 2, "\\poste\\a.mdb").otherwise("/a.mdb")
    path = F.concat(before, site, after)
    return S.compteur(spark, d).select("id_comptag", fn.reference_folder(path).alias("dossier"))


@query("SELECT id_comptag, dep, route, pr, abs, gestionnai, type_poste FROM compteur")
def prj_table_columns(spark, d):
    return prj.table_columns(S.compteur(spark, d), TABLES["compteur"])


@query("SELECT id_comptag, annee, tmja FROM (SELECT id_comptag, annee, id % 4 AS sens, CASE WHEN id % 7 = 0 THEN NULL ELSE tmja END AS tmja FROM comptage) WHERE annee = 1995 AND sens = 3 AND tmja IS NOT NULL")
def flt_current_year_dir3(spark, d):
    c = S.comptage(spark, d).select("id_comptag", "annee", (F.col("id") % 4).alias("sens"), F.when(F.col("id") % 7 != 0, F.col("tmja")).alias("tmja"))
    return prj.year_total_direction(c, 1995).select("id_comptag", "annee", "tmja")


@query("SELECT id_comptag, jour, indicateur, sens, h7_8, h8_9 FROM hw WHERE coalesce(h7_8, 0) <> 0 OR coalesce(h8_9, 0) <> 0")
def flt_valid_hourly_row(spark, d):
    return prj.valid_hourly_rows(S.hw(spark, d).select("id_comptag", "jour", "indicateur", "sens", "h7_8", "h8_9"), ["h7_8", "h8_9"])


@query("SELECT id_comptag, count(*) AS n, CASE WHEN count(*) > 4 THEN 'permanent' WHEN count(*) >= 2 THEN 'tournant' ELSE 'ponctuel' END AS type_poste FROM (SELECT 'C' || (o_custkey % 5000) AS id_comptag FROM orders) GROUP BY 1")
def fn_type_poste_by_files(spark, d):
    files = S.table(spark, d, "orders").select(S.counter(F.col("o_custkey") % 5000).alias("id_comptag"))
    return files.groupBy("id_comptag").agg(F.count("*").alias("n")).withColumn("type_poste", fn.post_type_by_files(F.col("n")))


@query("SELECT id_comptag, CASE WHEN n >= 6 THEN 'permanent' WHEN n >= 3 THEN 'tournant' ELSE 'ponctuel' END AS type_poste FROM (SELECT 'C' || o_custkey AS id_comptag, count(DISTINCT year(o_orderdate)) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1993 AND 1998 GROUP BY 1)")
def fn_type_poste_by_years(spark, d):
    o = S.table(spark, d, "orders").where(F.year("o_orderdate").between(1993, 1998))
    return o.groupBy(S.counter(F.col("o_custkey")).alias("id_comptag")).agg(fn.post_type_by_years(F.countDistinct(F.year("o_orderdate")), 6).alias("type_poste"))


@query("SELECT id_comptag, CASE WHEN count(DISTINCT id % 5) >= 3 THEN 'double sens' ELSE 'sens unique' END AS sens_cpt FROM comptage GROUP BY 1")
def fn_sens_cpt(spark, d):
    return prj.direction_kind(S.comptage(spark, d).withColumn("code", F.col("id") % 5), "id_comptag", "code")


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders")
def fn_french_date(spark, d):
    names = ["janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"]
    text = F.concat(F.lit("Lundi "), F.dayofmonth("o_orderdate").cast("string"), F.lit(" "), F.get(F.array(*[F.lit(n) for n in names]), F.month("o_orderdate") - 1), F.lit(" "), F.year("o_orderdate").cast("string"))
    return S.table(spark, d, "orders").select("o_orderkey", fn.french_date(text).alias("date"))


@query("SELECT id_comptag, CASE WHEN dep % 3 = 0 THEN 'centre ville' ELSE dep || '-' || route || '-' || pr || '+' || abs END AS id FROM compteur")
def fn_id_from_location(spark, d):
    text = F.when(F.col("dep") % 3 == 0, "centre ville").otherwise(F.concat(F.lit("R"), "route", F.lit(" au PR "), F.col("pr").cast("string"), F.lit(" + "), F.col("abs").cast("string")))
    return S.compteur(spark, d).select("id_comptag", fn.id_from_location(text, F.col("dep")).alias("id"))


@query("SELECT id_comptag, tmja AS total, CASE WHEN dep % 2 = 0 THEN pc_pl ELSE round(100 * pr / tmja, 2) END AS part FROM compteur")
def fn_totals_from_text(spark, d):
    text = F.concat(F.col("tmja").cast("string"), F.when(F.col("dep") % 2 == 0, F.concat(F.lit(" ("), F.translate(F.col("pc_pl").cast("string"), ".", ","), F.lit(" %)"))).otherwise(""))
    return S.compteur(spark, d).select("id_comptag", fn.totals_from_text(text, F.col("pr")).alias("t")).select("id_comptag", "t.*")
