"""Domain views over the given tables: in Spark, and the same in SQL for the oracle.

passages   individual vehicles          from events
campagnes  the same, by campaign        from events
horaire    hourly counts, long          from lineitem
hw         the same, 24 columns         from horaire
compteur   counters with a position     from supplier
sections   homogeneous road sections    from nation
corresp    provider id -> our id        from customer
comptage   yearly counts, with period   from orders
annuel     yearly indicators            from orders
mensuel    monthly indicators           from lineitem
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import HOURS


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def counter(number) -> F.Column:
    return F.concat(F.lit("C"), number.cast("string"))


def passages(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    kind = F.when(F.col("event_type").isin("click", "view"), "VL").when(F.col("event_type").isin("purchase", "error"), "PL").otherwise("2R")
    return e.select(
        "event_id", counter(F.col("user_id") % 10).alias("id_comptag"),
        F.concat(F.lit("sens"), (1 + F.floor(F.col("user_id") / 10) % 2).cast("string")).alias("sens"),
        F.col("ts").alias("date_heure"), kind.alias("type_veh"), F.col("value").alias("vitesse"), F.lit(1).alias("nb_veh"),
    )


def campagnes(spark: SparkSession, d: str) -> DataFrame:
    """All passages, as campaigns of each counter of 7, 8 and 15 days; those of odd counters start and end at noon, a day more."""
    p, n = passages(spark, d), F.substring("id_comptag", 2, 9).cast("int")
    which = F.when(F.dayofmonth("date_heure") <= 7, 1).when(F.dayofmonth("date_heure") <= 15, 2).otherwise(3)
    later = (F.col("date_heure") + F.make_dt_interval(F.lit(0), 12 * (n % 2))).cast("timestamp_ntz")
    return p.withColumns({"id_comptag": F.concat("id_comptag", F.lit("-"), which.cast("string")), "date_heure": later})


def _hours(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the hourly deliveries, not added up yet."""
    return table(spark, d, "lineitem").select(
        counter(F.col("l_suppkey") % 20).alias("id_comptag"), F.year("l_shipdate").alias("annee"), F.to_date("l_shipdate").alias("jour"),
        (F.col("l_orderkey") % 24).cast("int").alias("heure"), F.when(F.col("l_returnflag") == "R", "PL").otherwise("VL").alias("indicateur"),
        (1 + F.col("l_linenumber") % 2).cast("int").alias("sens"), F.col("l_quantity").alias("valeur"),
    )


def horaire(spark: SparkSession, d: str) -> DataFrame:
    return _hours(spark, d).groupBy("id_comptag", "annee", "jour", "heure", "indicateur", "sens").agg(F.sum("valeur").alias("valeur"))


def hw(spark: SparkSession, d: str) -> DataFrame:
    """One row a counter, day, indicator and direction; a missing hour is 0.  Hours are added up and turned in one aggregation."""
    wide = [F.sum(F.when(F.col("heure") == h, F.col("valeur")).otherwise(0.0)).alias(c) for h, c in enumerate(HOURS)]
    return _hours(spark, d).groupBy("id_comptag", "annee", "jour", "indicateur", "sens").agg(*wide).withColumn("fichier", F.concat(F.lit("f"), F.col("sens").cast("string")))


def compteur(spark: SparkSession, d: str) -> DataFrame:
    s, k = table(spark, d, "supplier"), F.col("s_suppkey")
    post = F.when(k % 3 == 0, "permanent").when(k % 3 == 1, "tournant").otherwise("ponctuel")
    return s.select(
        counter(k).alias("id_comptag"), F.col("s_nationkey").alias("dep"), F.concat(F.lit("D"), (k % 40).cast("string")).alias("route"),
        (k % 60).cast("int").alias("pr"), (k * 13 % 1000).cast("int").alias("abs"), post.alias("type_poste"),
        (F.floor(F.abs("s_acctbal")) + 1).cast("int").alias("tmja"), ((k % 40) / 2).alias("pc_pl"),
        (k * 37 % 1000).cast("double").alias("x"), (k * 91 % 1000).cast("double").alias("y"), F.concat(F.lit("G"), (k % 5).cast("string")).alias("gestionnai"),
    )


def sections(spark: SparkSession, d: str) -> DataFrame:
    n, k = table(spark, d, "nation"), F.col("n_nationkey")
    x, y = (k * 40 % 1000).cast("double"), (k * 77 % 1000).cast("double")
    return n.select(k.alias("gid"), F.col("n_regionkey").alias("region"), x.alias("x0"), y.alias("y0"), (x + 300).alias("x1"), (y + 120).alias("y1"))


def corresp(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer")
    return c.select(counter(F.col("c_custkey")).alias("id_gest"), counter(F.col("c_nationkey")).alias("id_gti"))


def comptage(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    day = F.to_date("o_orderdate")
    text = lambda c: F.date_format(c, "yyyy/MM/dd")
    return o.select(
        F.col("o_orderkey").alias("id"), counter(F.col("o_custkey") % 50).alias("id_comptag"), F.year("o_orderdate").alias("annee"), day.alias("debut"), F.date_add(day, 7).alias("fin"),
        F.concat(text(day), F.lit("-"), text(F.date_add(day, 7))).alias("periode"), F.col("o_orderpriority").alias("src"), F.floor("o_totalprice").cast("int").alias("tmja"), (F.col("o_orderkey") % 40 / 2).alias("pc_pl"),
    )


def annuel(spark: SparkSession, d: str) -> DataFrame:
    return comptage(spark, d).groupBy("id_comptag", "annee").agg(F.min("id").alias("id_uniq"), F.floor(F.avg("tmja")).cast("int").alias("tmja"), (F.count("*") % 40 / 2).alias("pc_pl"))


def mensuel(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    return li.groupBy(counter(F.col("l_suppkey") % 20).alias("id_comptag"), F.year("l_shipdate").alias("annee"), F.month("l_shipdate").alias("mois")).agg(F.sum("l_quantity").alias("tmja"), (F.count("*") % 30).cast("double").alias("pc_pl"))


_WIDE = ", ".join(f"sum(CASE WHEN heure = {h} THEN valeur ELSE 0.0 END) AS {c}" for h, c in enumerate(HOURS))
VIEWS_SQL = f"""
passages AS (
  SELECT event_id, 'C' || (user_id % 10) AS id_comptag, 'sens' || (1 + (user_id // 10) % 2) AS sens, ts AS date_heure,
         CASE WHEN event_type IN ('click', 'view') THEN 'VL' WHEN event_type IN ('purchase', 'error') THEN 'PL' ELSE '2R' END AS type_veh,
         value AS vitesse, 1 AS nb_veh
  FROM events),
campagnes AS (
  SELECT event_id, id_comptag || '-' || CASE WHEN day(date_heure) <= 7 THEN 1 WHEN day(date_heure) <= 15 THEN 2 ELSE 3 END AS id_comptag, sens,
         date_heure + to_hours(12 * (CAST(substr(id_comptag, 2) AS INTEGER) % 2)) AS date_heure, type_veh, vitesse, nb_veh
  FROM passages),
horaire AS (
  SELECT 'C' || (l_suppkey % 20) AS id_comptag, year(l_shipdate) AS annee, CAST(l_shipdate AS DATE) AS jour, l_orderkey % 24 AS heure,
         CASE WHEN l_returnflag = 'R' THEN 'PL' ELSE 'VL' END AS indicateur, 1 + l_linenumber % 2 AS sens, sum(l_quantity) AS valeur
  FROM lineitem GROUP BY ALL),
hw AS (SELECT id_comptag, annee, jour, indicateur, sens, {_WIDE}, 'f' || sens AS fichier FROM horaire GROUP BY id_comptag, annee, jour, indicateur, sens),
compteur AS (
  SELECT 'C' || s_suppkey AS id_comptag, s_nationkey AS dep, 'D' || (s_suppkey % 40) AS route, s_suppkey % 60 AS pr, s_suppkey * 13 % 1000 AS abs,
         CASE s_suppkey % 3 WHEN 0 THEN 'permanent' WHEN 1 THEN 'tournant' ELSE 'ponctuel' END AS type_poste, CAST(floor(abs(s_acctbal)) + 1 AS INTEGER) AS tmja,
         (s_suppkey % 40) / 2 AS pc_pl, CAST(s_suppkey * 37 % 1000 AS DOUBLE) AS x, CAST(s_suppkey * 91 % 1000 AS DOUBLE) AS y, 'G' || (s_suppkey % 5) AS gestionnai
  FROM supplier),
sections AS (
  SELECT n_nationkey AS gid, n_regionkey AS region, CAST(n_nationkey * 40 % 1000 AS DOUBLE) AS x0, CAST(n_nationkey * 77 % 1000 AS DOUBLE) AS y0,
         n_nationkey * 40 % 1000 + 300.0::DOUBLE AS x1, n_nationkey * 77 % 1000 + 120.0::DOUBLE AS y1 FROM nation),
corresp AS (SELECT 'C' || c_custkey AS id_gest, 'C' || c_nationkey AS id_gti FROM customer),
comptage AS (
  SELECT o_orderkey AS id, 'C' || (o_custkey % 50) AS id_comptag, year(o_orderdate) AS annee, CAST(o_orderdate AS DATE) AS debut, CAST(o_orderdate AS DATE) + 7 AS fin,
         strftime(o_orderdate, '%Y/%m/%d') || '-' || strftime(CAST(o_orderdate AS DATE) + 7, '%Y/%m/%d') AS periode, o_orderpriority AS src,
         CAST(floor(o_totalprice) AS INTEGER) AS tmja, (o_orderkey % 40) / 2 AS pc_pl FROM orders),
annuel AS (SELECT id_comptag, annee, min(id) AS id_uniq, CAST(floor(avg(tmja)) AS INTEGER) AS tmja, (count(*) % 40) / 2 AS pc_pl FROM comptage GROUP BY ALL),
mensuel AS (
  SELECT 'C' || (l_suppkey % 20) AS id_comptag, year(l_shipdate) AS annee, month(l_shipdate) AS mois, sum(l_quantity) AS tmja, CAST(count(*) % 30 AS DOUBLE) AS pc_pl
  FROM lineitem GROUP BY ALL)
"""
