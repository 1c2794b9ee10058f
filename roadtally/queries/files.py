"""Sources and sinks.  Files are written from the given tables, by Spark, into the shared folder, and read back."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import standins as S
from ..schemas import HOURS
from ..scratch import fresh_path
from ..sources import readers as rd
from ..sources import writers as wr
from ..sources.tables import Table
from .registry import query


def csv_of(df: DataFrame, name: str, **options) -> str:
    path = fresh_path(df.sparkSession, name)
    df.write.options(**options).csv(path)
    return path


def files_of(lines: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Writes ``lines`` (point, part, rang, line) as one file for each point and part, in the order of ``rang``."""
    kept = lines.repartition("point", "part").sortWithinPartitions("point", "part", "rang").select("point", "part", "line")
    kept.write.partitionBy("point", "part").options(encoding=encoding, sep="\u0001", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def small_files(rows: DataFrame, path: str) -> None:
    """Writes ``rows`` (name, value) as one file each, below ``path``.

    Spark's own writer takes a folder, a file, a checksum and a change of rights for each, some hundred times as long.
    A task that is run again writes the same files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = pafs.FileSystem.from_uri(path)
        made = set()
        for batch in batches:
            for name, value in zip(batch["name"].to_pylist(), batch["value"].to_pylist()):
                folder = f"{root}/{name}".rpartition("/")[0]
                if folder not in made:
                    disk.create_dir(folder, recursive=True)
                    made.add(folder)
                with disk.open_output_stream(f"{root}/{name}") as file:
                    file.write(value.encode())
            yield pa.record_batch({"files": [len(batch)]})

    rows.mapInArrow(write, "files long").agg(F.sum("files")).collect()


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'ete a ' || s_nationkey END AS nom FROM supplier")
def src_delimited(spark, d):
    s = S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 != 0, F.concat(F.lit("été à "), F.col("s_nationkey").cast("string"))).alias("nom"))
    df = rd.delimited(spark, csv_of(s, "delimited", sep=";", header=True, nullValue=""), schema="id bigint, nom string")
    return df.withColumn("nom", F.translate("nom", "à", "a"))


@query("SELECT s_suppkey AS id, 'zone e' || s_nationkey AS nom, CASE WHEN s_suppkey % 4 > 0 THEN s_acctbal END AS valeur FROM supplier")
def src_delimited_skipped(spark, d):
    """Files of a nation's thousand suppliers, with two lines above the header."""
    s = S.table(spark, d, "supplier")
    point, part = F.col("s_nationkey").alias("point"), F.floor(F.col("s_suppkey") / 1000).alias("part")
    body = s.select(point, part, (F.col("s_suppkey") + 3).alias("rang"), F.concat_ws(";", F.col("s_suppkey").cast("string"), F.concat(F.lit("zone é"), F.col("s_nationkey").cast("string")), F.when(F.col("s_suppkey") % 4 > 0, F.col("s_acctbal").cast("string")).otherwise("")).alias("line"))
    head = s.select(point, part).distinct().select("point", "part", F.posexplode(F.array(*[F.lit(x) for x in ("livraison;;", "unites;;veh/j", "id;nom;valeur")])).alias("rang", "line"))
    path = fresh_path(spark, "skipped")
    files_of(head.unionByName(body), path)
    return rd.delimited(spark, path, schema="id bigint, nom string, valeur double", skip_rows=2)


@query("""
SELECT date_trunc('minute', date_heure) + to_milliseconds(event_id % 60 * 1000 + event_id % 100 * 10) AS date_heure, 1 AS nb_veh,
       CASE WHEN event_id % 14 IN (1, 12) THEN 'VL' WHEN event_id % 14 = 13 THEN '2R' ELSE 'PL' END AS type_veh, 'sens' || (event_id % 2 + 1) AS sens, vitesse FROM passages WHERE event_id % 5 <> 0""")
def src_vehicle_tube(spark, d):
    """A Latin-1 file for each counter and day: tabs on even days, NULs on odd ones; the header lacks the rows' empty first field."""
    i, p = F.col("event_id"), S.passages(spark, d).withColumns({"point": F.col("id_comptag"), "part": F.dayofyear("date_heure")})
    cells = [F.when(i % 5 != 0, 1).otherwise(0), F.date_format("date_heure", "dd/MM/yyyy HH:mm"), i % 60, i % 100, i % 14, i % 2, F.col("vitesse")]
    line = lambda *c: F.when(F.col("part") % 2 == 0, F.concat_ws("\t", *c)).otherwise(F.concat_ws("\0", *c))
    body = p.select("point", "part", (i + 1).alias("rang"), line(F.lit(""), *[c.cast("string") for c in cells]).alias("line"))
    head = p.select("point", "part").distinct().withColumn("rang", F.lit(-1).cast("long")).withColumn("line", line(*[F.lit(x) for x in (*rd.TUBE.values(), "")]))
    path = fresh_path(spark, "tube")
    files_of(head.unionByName(body), path, "ISO-8859-1")
    return rd.vehicle_tube(spark, path)


@query("""
SELECT id_comptag AS point, CAST(j AS TIMESTAMP) + to_milliseconds((CAST(h AS BIGINT) * 3600 + m * 60 + event_id % 60) * 1000) AS date_heure, 1 AS nb_veh, CAST(floor(vitesse) AS INTEGER) AS vitesse, CAST(event_id % 30 AS INTEGER) AS ser, type_veh, sens
FROM (SELECT event_id, id_comptag, vitesse, type_veh, sens, hour(date_heure) AS h, minute(date_heure) AS m, CAST(date_heure AS DATE) + 20 AS j FROM passages)""")
def src_vehicle_radar(spark, d):
    """A file for each counter and week: dates are moved by 20 days, so that they pass the end of a month."""
    p = S.passages(spark, d).withColumn("j", F.date_add(F.to_date("date_heure"), 20))
    line = F.concat_ws(" ", F.substring("sens", 5, 1), F.date_format("j", "dd"), F.date_format("date_heure", "HHmm"), F.format_string("%02d00", F.col("event_id") % 60), F.concat(F.lit("V="), F.floor("vitesse").cast("string")), (F.col("event_id") % 30).cast("string"), F.lower("type_veh"))
    p = p.withColumns({"point": F.col("id_comptag"), "part": F.to_date(F.date_trunc("week", "j"))})
    body = p.select("point", "part", F.struct(F.col("date_heure").alias("t"), "event_id").alias("rang"), line.alias("line"))
    head = p.groupBy("point", "part").agg(F.min("j").alias("a")).select("point", "part", F.struct(F.lit(None).cast("timestamp_ntz").alias("t"), F.lit(None).cast("long").alias("event_id")).alias("rang"), F.concat(F.lit("RADAR.1.2.3.4. "), F.date_format("a", "yy. MM. dd"), F.lit(".0")).alias("line"))
    path = fresh_path(spark, "radar")
    files_of(head.unionByName(body), path)
    return _with_point(rd.vehicle_radar(spark, path))


def _with_point(df: DataFrame) -> DataFrame:
    """The counter that a file belongs to, by the name of its folder."""
    return df.withColumn("point", F.regexp_extract("file", "point=([^/]+)/", 1)).drop("file")


@query("""
WITH b AS (SELECT DISTINCT id_comptag, CAST(date_trunc('month', jour) AS DATE) AS mois, sens, indicateur FROM horaire),
t AS (SELECT b.*, unnest(generate_series(CAST(mois AS TIMESTAMP), CAST(last_day(mois) AS TIMESTAMP), INTERVAL 1 DAY)) AS date_heure FROM b),
v AS (SELECT id_comptag, sens, indicateur, CAST(jour AS TIMESTAMP) AS date_heure, CAST(sum(valeur) AS INTEGER) AS n FROM horaire GROUP BY ALL)
SELECT t.id_comptag AS point, CASE WHEN month(t.mois) % 3 = 0 THEN 'mode3' ELSE 'mode4' END AS mode, CASE WHEN month(t.mois) % 3 = 0 AND t.indicateur = 'VL' THEN 'TV' ELSE t.indicateur END AS type_veh, 'sens' || t.sens AS sens,
       t.date_heure, coalesce(n, 0) AS nb_veh, CASE WHEN month(t.mois) % 2 = 0 THEN -0.61234567 END AS lon, CASE WHEN month(t.mois) % 2 = 0 THEN 46.12345678 END AS lat
FROM t LEFT JOIN v ON v.id_comptag = t.id_comptag AND v.sens = t.sens AND v.indicateur = t.indicateur AND v.date_heure = t.date_heure""")
def src_fim_blocks(spark, d):
    """A file for each counter and month: a block of all its days for each direction and kind of vehicle, twelve values a line."""
    path = fresh_path(spark, "fim")
    fim_files(spark, d, path)
    return _with_point(rd.fim_blocks(spark, path))


def fim_files(spark, d, path):
    h = S.horaire(spark, d).withColumn("part", F.trunc("jour", "month"))
    key = ["id_comptag", "part", "indicateur", "sens"]
    day = F.dayofmonth("jour") - 1
    days = h.groupBy(*key).agg(*[F.sum(F.when(day == k, F.col("valeur"))).cast("int").cast("string").alias(f"v{k}") for k in range(31)])
    # a day without a count is left empty
    cells = F.slice(F.array(*[F.concat(F.coalesce(F.lpad(F.col(f"v{k}"), 5, " "), F.lit(" " * 5)), F.lit(".")) for k in range(31)]), F.lit(1), F.dayofmonth(F.last_day("part")))
    month = F.month("part")
    code = F.when(month % 3 == 0, F.when(F.col("indicateur") == "PL", "3.P").otherwise("1.T")).otherwise(F.concat(F.when(month % 3 == 1, "4.").otherwise("2."), F.when(F.col("indicateur") == "PL", "P").otherwise("V")))
    place = F.when(month % 2 == 0, "+46.1234.5678.-0.6123.4567.").otherwise("SANS")
    title = F.concat(F.lit("17. 0016. 0103. 00. "), F.col("sens").cast("string"), F.date_format("part", "'.' yy'.' MM'.' dd'.'"), F.lit(" 00. 00. 1440.   "), code, F.lit("   "), place)
    lines = days.select(*key, F.posexplode(F.array(title, *[F.array_join(F.slice(cells, k, 12), "") for k in (1, 13, 25)])).alias("n", "line"))
    files_of(lines.select(F.col("id_comptag").alias("point"), "part", F.struct("indicateur", "sens", "n").alias("rang"), "line"), path)


@query(f"SELECT '16-D' || substr(id_comptag, 2) || '-' || (annee % 100) AS id_comptag, 'sens ' || sens AS sens, CASE WHEN indicateur = 'VL' THEN 'TV' ELSE 'PL' END AS indicateur, jour, {', '.join(HOURS)} FROM hw")
def src_iris_hourly(spark, d):
    """Latin-1 files of a counter, direction and year in the folders TV and PL: ten lines of head, the header, days, eleven lines of foot."""
    w = S.hw(spark, d).withColumn("point", F.concat_ws("_", "id_comptag", F.col("sens").cast("string"))).withColumn("part", F.col("annee"))
    key = ["indicateur", "point", "part", "id_comptag", "sens", "annee"]
    body = w.select(*key, F.datediff("jour", F.lit("1900-01-01")).alias("rang"), F.concat_ws(";", F.lit("jour mesuré"), F.date_format("jour", "dd/MM/yyyy"), *[F.col(h).cast("string") for h in HOURS]).alias("line"))
    pad = lambda n, *last: F.concat(F.lit(";" * n), *last)
    special = {2: pad(22, F.lit("Sens n°"), F.col("sens").cast("string")), 4: pad(16, F.expr("substring(id_comptag, 2)")), 5: pad(16, (F.col("annee") % 100).cast("string"))}
    head = [special.get(k, F.lit(f"ligne {k}" + ";" * 24)) for k in range(rd.IRIS_HEAD)] + [F.lit(";".join(["Etat", "Jours", *(f"H{k}" for k in range(1, 25))]))]
    foot = [F.lit(f"Moyenne {k}" + ";" * 24) for k in range(rd.IRIS_FOOT)]
    ends = w.select(*key).distinct().select(*key, F.posexplode(F.array(*head, *foot)).alias("k", "line"))
    ends = ends.select(*key, F.when(F.col("k") < len(head), F.col("k") - 100).otherwise(F.col("k") + 1_000_000).alias("rang"), "line")
    path = fresh_path(spark, "iris")
    both = body.unionByName(ends)
    for kind, code in (("TV", "VL"), ("PL", "PL")):  # the two folders of a delivery
        files_of(both.where(F.col("indicateur") == code), f"{path}/{kind}", "ISO-8859-1")
    return rd.iris_hourly(spark, path)


@query("SELECT date_heure, CASE WHEN vitesse < 7.2 THEN 'VL' WHEN vitesse < 22 THEN 'PL' END AS type_veh, vitesse AS longueur FROM passages WHERE event_id % 6 <> 0")
def src_vehicle_csv(spark, d):
    raw = S.passages(spark, d).select(F.date_format("date_heure", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("DateTime"), F.col("vitesse").alias("Length"), F.when(F.col("event_id") % 6 == 0, 128).otherwise(0).alias("AdviceCode"))
    return rd.vehicle_csv(spark, csv_of(raw, "vehicles", header=True))


@query("SELECT DISTINCT id_comptag AS station, date_trunc('minute', date_heure) AS minute, CAST(vitesse AS INTEGER) % 3 AS nb_veh FROM (SELECT id_comptag, date_heure, floor(vitesse) AS vitesse FROM passages)")
def src_minute_counts(spark, d):
    raw = S.passages(spark, d).select(F.col("id_comptag").alias("station"), F.date_format("date_heure", "yyyy-MM-dd'T'HH:mm:00").alias("minute"), (F.floor("vitesse") % 3).cast("int").alias("nb_veh"))
    return rd.minute_counts(spark, csv_of(raw.union(raw), "minutes", header=True))


@query("""
SELECT s_suppkey AS id, s_name AS nom, CASE WHEN s_suppkey % 5 > 0 THEN s_nationkey / 2 END AS solde, CASE WHEN k > 0 THEN CASE WHEN k = 1 THEN 'LineString' WHEN k = 2 THEN 'Polygon' ELSE 'Point' END END AS type,
       CASE WHEN k > 0 THEN s_suppkey / 8 END AS lon, CASE WHEN k > 0 THEN CAST(s_nationkey AS DOUBLE) END AS lat, CASE WHEN k = 1 THEN 2 WHEN k = 2 THEN 4 WHEN k = 3 THEN 1 END AS positions
FROM (SELECT *, s_suppkey % 4 AS k FROM supplier)""")
def src_geojson(spark, d):
    """Points, lines, polygons and features without geometry; a property that some features lack."""
    s = S.table(spark, d, "supplier")
    at = lambda step: F.array(F.col("s_suppkey") / 8 + step, F.col("s_nationkey").cast("double"))
    text = lambda kind, c: F.concat(F.lit(f'{{"type":"{kind}","coordinates":'), F.to_json(c), F.lit("}"))
    k = F.col("s_suppkey") % 4
    geometry = F.when(k == 1, text("LineString", F.array(at(0), at(1)))).when(k == 2, text("Polygon", F.array(F.array(at(0), at(1), at(2), at(0))))).when(k == 3, text("Point", at(0))).otherwise("null")
    # to_json leaves nulls out
    properties = F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("nom"), F.when(F.col("s_suppkey") % 5 > 0, F.col("s_nationkey") / 2).alias("solde")))
    feature = F.concat(F.lit('{"type":"Feature","properties":'), properties, F.lit(',"geometry":'), geometry, F.lit("}"))
    path = fresh_path(spark, "geojson")
    # a collection for each nation and range of 1000 ids
    docs = s.groupBy("s_nationkey", F.floor(F.col("s_suppkey") / 1000)).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value"))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
    r = rd.geojson(spark, path, {"id": "bigint", "nom": "string", "solde": "double"})
    return r.select("id", "nom", "solde", "type", "lon", "lat", F.when(F.col("points").isNotNull(), F.size("points")).alias("positions"))


@query("SELECT id_comptag, type_poste FROM compteur WHERE dep = 7 AND type_poste IN ('permanent', 'tournant') AND gestionnai = 'G2'")
def src_catalog(spark, d):
    return rd.catalog(S.compteur(spark, d), 7, ["permanent", "tournant"], "G2").select("id_comptag", "type_poste")


@query("SELECT 'C' || (s_suppkey % 10) AS point, string_agg('C' || (s_suppkey % 10) || '_' || s_suppkey, ',' ORDER BY 'C' || (s_suppkey % 10) || '_' || s_suppkey) AS fichiers, count(*) AS n FROM supplier GROUP BY 1")
def src_files_by_name(spark, d):
    """A file for each supplier, in folders of a thousand."""
    k = F.col("s_suppkey")
    path = fresh_path(spark, "names")
    name = F.concat(F.floor(k / 1000).cast("string"), F.lit("/C"), (k % 10).cast("string"), F.lit("_"), k.cast("string"), F.lit(".txt"))
    small_files(S.table(spark, d, "supplier").select(name.alias("name"), k.cast("string").alias("value")), path)
    own = rd.files_by_name(spark, path, r"/(C\d+)_\d+\.txt$")
    return own.withColumn("fichiers", F.array_join(F.array_sort(F.transform("fichiers", lambda x: F.regexp_extract(x, r"/([^/]+)\.txt$", 1))), ","))


@query("SELECT o_custkey % 50 AS point, sha256(o_orderstatus || o_orderpriority) AS empreinte, min('f' || o_orderkey) AS nom FROM orders GROUP BY 1, 2")
def src_file_dedup(spark, d):
    o = S.table(spark, d, "orders").select((F.col("o_custkey") % 50).alias("point"), F.concat(F.lit("f"), F.col("o_orderkey").cast("string")).alias("nom"), F.concat("o_orderstatus", "o_orderpriority").cast("binary").alias("contenu"))
    return rd.file_dedup(o, "point", "nom", "contenu")


@query("SELECT 'f' || s_suppkey AS file, l AS line, CASE WHEN l = 0 THEN 'B152' ELSE 'v' || (s_suppkey + l) END AS value FROM supplier, (VALUES (0), (1), (2)) AS v(l) WHERE s_suppkey % 3 = 0")
def flt_file_kind(spark, d):
    s = S.table(spark, d, "supplier").withColumn("line", F.explode(F.array(*[F.lit(k) for k in range(3)])))
    value = F.when(F.col("line") == 0, F.when(F.col("s_suppkey") % 3 == 0, "B152").otherwise("B153")).otherwise(F.concat(F.lit("v"), (F.col("s_suppkey") + F.col("line")).cast("string")))
    return rd.file_kind(s.select(F.concat(F.lit("f"), F.col("s_suppkey").cast("string")).alias("file"), "line", value.alias("value")), "B152")


@query("SELECT id, id_comptag, annee, tmja FROM comptage UNION ALL SELECT id, id_comptag, annee, tmja FROM comptage WHERE id % 4 = 0")
def snk_append(spark, d):
    """Two deliveries, the second of them handed in twice."""
    c, t = S.comptage(spark, d).select("id", "id_comptag", "annee", "tmja"), Table(spark, fresh_path(spark, "append"))
    t.append(c, batch="all")
    for _ in range(2):
        t.append(c.where("id % 4 = 0"), batch="fourth")
    return t.read()


@query("""
SELECT id, annee, CASE WHEN annee >= 1996 AND id % 3 = 0 AND id % 2 = 0 THEN tmja + 1 WHEN id % 2 = 0 THEN NULL ELSE tmja END AS tmja FROM comptage WHERE id % 7 > 0
UNION ALL SELECT id, annee, tmja + 1 FROM comptage WHERE annee >= 1996 AND id % 3 = 0 AND id % 7 = 0""")
def snk_update(spark, d):
    """Unknown traffic of the later years is filled in, rows that the table lacks are added; read back from the table."""
    c, t = S.comptage(spark, d).select("id", "annee", "tmja"), Table(spark, fresh_path(spark, "update"))
    t.append(c.where("id % 7 > 0").withColumn("tmja", F.when(F.col("id") % 2 != 0, F.col("tmja"))))
    new = c.where("annee >= 1996 and id % 3 = 0").withColumn("tmja", F.col("tmja") + 1)
    t.merge(new, ["id"], ["tmja"], only_when=F.col("tmja").isNull(), insert=True)
    t.clean()
    return t.read()


@query("SELECT s_suppkey AS id, 'rue ' || s_nationkey AS adresse FROM supplier WHERE s_suppkey % 3 <> 0")
def snk_export_addresses(spark, d):
    s = S.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "1.25;-45").otherwise(F.concat(F.lit("rue "), F.col("s_nationkey").cast("string"))).alias("adresse"))
    path = fresh_path(spark, "addresses")
    wr.export_addresses(s, path, "adresse")
    return spark.read.option("header", True).schema("id bigint, adresse string").csv(path)


@query("SELECT id, id_comptag, periode, tmja FROM comptage")
def snk_export_json(spark, d):
    c, path = S.comptage(spark, d).select("id", "id_comptag", "periode", "tmja"), fresh_path(spark, "json")
    wr.export_json(c, path + "/json")
    wr.export_csv(c, path + "/csv")
    j = spark.read.schema("id bigint, id_comptag string, periode string, tmja int").json(path + "/json")
    k = spark.read.option("header", True).schema(j.schema).csv(path + "/csv")
    return j.intersect(k)
