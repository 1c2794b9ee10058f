"""Geospatial and network operators.  The network is a grid of roads made from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import standins as S
from ..operators import geo, linear
from ..operators import network as net
from .registry import query

DIST, CELL = 30.0, 100.0
_D = """sqrt(pow(x - (x0 + t * (x1 - x0)), 2) + pow(y - (y0 + t * (y1 - y0)), 2))"""
#: Brute force: every pair of a counter and a section, with its distance.
_PAIRS = f"(SELECT *, {_D} AS distance FROM (SELECT c.*, s.*, greatest(0, least(1, ((x - x0) * (x1 - x0) + (y - y0) * (y1 - y0)) / (pow(x1 - x0, 2) + pow(y1 - y0, 2)))) AS t FROM compteur c, sections s))"
_NEAREST = f"(SELECT id_comptag, gid, distance FROM {_PAIRS} WHERE distance <= 30 QUALIFY row_number() OVER (PARTITION BY id_comptag ORDER BY distance, gid) = 1)"


@query("""
SELECT id_comptag, lon, lat FROM (SELECT id_comptag, round(x / 200 - 1, 7) AS lon, round(44 + y / 200, 7) AS lat FROM compteur)""")
def geo_to_lambert93(spark, d):
    """There and back: the projection's inverse gives the degrees it started from."""
    c = S.compteur(spark, d).withColumn("p", geo.to_lambert93(F.col("x") / 200 - 1, 44 + F.col("y") / 200))
    back = geo.from_lambert93(F.col("p.x"), F.col("p.y"))
    return c.select("id_comptag", back.alias("b")).select("id_comptag", F.round("b.lon", 7).alias("lon"), F.round("b.lat", 7).alias("lat"))


@query("SELECT id_comptag, CASE WHEN dep % 3 > 0 THEN round(x / 7, 3) END AS x_l93, CASE WHEN dep % 3 > 0 THEN round(y / 7, 3) END AS y_l93 FROM compteur")
def geo_xy(spark, d):
    c = S.compteur(spark, d).withColumns({"x": F.when(F.col("dep") % 3 > 0, F.col("x") / 7), "y": F.col("y") / 7})
    return geo.xy(c, "x", "y").select("id_comptag", "x_l93", "y_l93")


@query("SELECT id_comptag, CAST('45.' || lpad(CAST(pr AS VARCHAR), 4, '0') || lpad(CAST(abs AS VARCHAR), 4, '0') AS DOUBLE) AS lat FROM compteur")
def geo_degrees_text(spark, d):
    part = lambda c: F.lpad(F.col(c).cast("string"), 4, "0")
    return S.compteur(spark, d).select("id_comptag", geo.degrees_text(F.concat(F.lit("+45."), part("pr"), F.lit("."), part("abs"), F.lit("."))).alias("lat"))


@query("SELECT dep, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM compteur GROUP BY 1")
def geo_midpoint(spark, d):
    return geo.midpoint(S.compteur(spark, d), "dep").withColumns({c: F.round(c, 6) for c in "xy"})


@query(f"SELECT id_comptag, round(distance, 6) AS distance FROM {_PAIRS} WHERE gid = dep")
def geo_point_segment_distance(spark, d):
    line = F.array(F.struct(F.col("x0").alias("x"), F.col("y0").alias("y")), F.struct(((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("y0") + F.col("y1")) / 2).alias("y")), F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")))
    j = S.compteur(spark, d).join(S.sections(spark, d), F.col("dep") == F.col("gid"))
    return j.select("id_comptag", F.round(geo.line_distance(F.col("x"), F.col("y"), line), 6).alias("distance"))


@query(f"SELECT id_comptag, gid, round(distance, 6) AS distance FROM {_NEAREST}")
def join_nearest(spark, d):
    return geo.nearest(S.compteur(spark, d), S.sections(spark, d), DIST, cell=CELL).withColumn("distance", F.round("distance", 6))


@query(f"""
SELECT gid, arg_min(id_comptag, (-r, v, -tmja, id_comptag)) AS id_comptag, count(*) AS n FROM (
  SELECT n.gid, c.id_comptag, c.tmja, CASE c.type_poste WHEN 'permanent' THEN 3 WHEN 'tournant' THEN 2 ELSE 1 END AS r, c.dep % 2 = 0 AS v FROM {_NEAREST} n JOIN compteur c USING (id_comptag)) GROUP BY 1""")
def join_best_counter_per_section(spark, d):
    c = S.compteur(spark, d).withColumn("vacances", F.col("dep") % 2 == 0)
    return geo.best_counter_per_section(c, S.sections(spark, d), DIST, cell=CELL)


@query(f"""
SELECT s.gid AS id, s.gid % 5 AS gid, b.id_comptag FROM sections s LEFT JOIN (
  SELECT gid % 5 AS g, arg_min(id_comptag, (distance, id_comptag)) AS id_comptag FROM {_NEAREST} GROUP BY 1) b ON b.g = s.gid % 5""")
def join_section_tree(spark, d):
    s = S.sections(spark, d)
    sections = s.groupBy((F.col("gid") % 5).alias("s")).agg(F.collect_list("gid").alias("list_id")).withColumnRenamed("s", "gid")
    return geo.section_tree(S.compteur(spark, d), s.withColumnRenamed("gid", "id"), sections, DIST, cell=CELL)


@query("""
SELECT id_comptag, gid FROM compteur, sections WHERE x >= x0 AND x < x1 AND y >= y0 AND y < y1 AND NOT (x >= x0 + 100 AND x < x1 - 100 AND y >= y0 + 40 AND y < y1 - 40)
UNION ALL SELECT id_comptag, gid FROM compteur, sections WHERE x >= x0 + 120 AND x < x1 - 120 AND y >= y0 + 50 AND y < y1 - 50""")
def join_within_zone(spark, d):
    """Zones with a hole, and an island in the hole."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

    def box(dx, dy):
        x0, y0, x1, y1 = F.col("x0") + dx, F.col("y0") + dy, F.col("x1") - dx, F.col("y1") - dy
        return F.array(corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1))

    zones = S.sections(spark, d).select("gid", F.array(box(0, 0), box(100, 40), box(120, 50)).alias("rings"))
    return geo.within_zone(S.compteur(spark, d).select("id_comptag", "x", "y"), zones).select("id_comptag", "gid")


def roads(spark, d):
    """A road of 1,000 m in ten edges for each département and route, in one of several shapes, with markers every 250 m.

    Every third one lacks its fifth edge; every third one's edges are drawn against each other; every fourth turns north
    at 500 m; the last three edges belong to the next département; roads whose number 5 divides have the first marker only.
    """
    r = S.compteur(spark, d).select("dep", "route").distinct().withColumn("n", F.substring("route", 2, 9).cast("int"))
    base = F.col("dep") * 10_000.0 + F.col("n") * 100.0
    at = lambda m: (F.when(F.col("n") % 4 == 1, F.least(m, F.lit(500.0))).otherwise(m), base + F.when(F.col("n") % 4 == 1, F.greatest(m - 500, F.lit(0.0))).otherwise(0.0))
    e = r.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(9)))).where("not (n % 3 = 1 and k = 4)")
    turned = (F.col("n") % 3 == 2) & (F.col("k") % 2 == 1)
    (ax, ay), (bx, by) = at(F.col("k") * 100.0), at(F.col("k") * 100.0 + 100)
    pick = lambda a, b: F.when(turned, b).otherwise(a)
    node = lambda k: F.col("dep") * 1_000_000 + F.col("n") * 1000 + k
    edges = e.select(
        (node(900) - F.col("k")).alias("id"), "route", F.when(F.col("k") >= 7, F.col("dep") + 100).otherwise(F.col("dep")).alias("dep"), pick(node(F.col("k")), node(F.col("k") + 1)).alias("source"), pick(node(F.col("k") + 1), node(F.col("k"))).alias("target"),
        pick(ax, bx).alias("x0"), pick(ay, by).alias("y0"), pick(bx, ax).alias("x1"), pick(by, ay).alias("y1"),
    )
    m = r.where("n <> 7").withColumn("pr", F.explode(F.sequence(F.lit(0), F.lit(3)))).where("n % 5 > 0 or pr = 0")
    mx, my = at(F.col("pr") * 250.0)
    return edges, m.select("dep", "route", "pr", (mx + 1).alias("x"), (my - 1).alias("y")), r.where("dep % 2 = 0").select("dep", (F.col("dep") + 100).alias("voisin")).distinct()


@query("""
SELECT id_comptag, CASE WHEN c = 'OK' THEN CAST(CASE WHEN n % 4 = 1 THEN least(t, 500) ELSE t END AS DOUBLE) END AS x,
       CASE WHEN c = 'OK' THEN CAST(dep * 10000 + n * 100 + CASE WHEN n % 4 = 1 THEN greatest(t - 500, 0) ELSE 0 END AS DOUBLE) END AS y, c AS commentaire FROM (
  SELECT *, CASE WHEN n = 7 THEN 'KO route non présente dans le référentiel PR / KO Pas de PR / KO pas de fichier de géolocalisation'
    WHEN p > 3 OR n % 5 = 0 AND p > 0 THEN 'KO Pas de PR / KO pas de fichier de géolocalisation' WHEN t > 1000 THEN 'KO hors de la route'
    WHEN t > 700 AND dep % 2 = 1 THEN 'KO hors du département' ELSE 'OK' END AS c
  FROM (SELECT *, pr % 5 AS p, CAST(substr(route, 2) AS INTEGER) AS n, m + abs AS t FROM (
    SELECT *, pr % 5 * 250 + CASE WHEN CAST(substr(route, 2) AS INTEGER) % 4 = 1 AND pr % 5 >= 2 THEN 2 - pr % 5 ELSE 1 END AS m FROM compteur)))""")
def geo_locate_pr_abs(spark, d):
    edges, markers, neighbours = roads(spark, d)
    points = S.compteur(spark, d).withColumn("pr", F.col("pr") % 5).select("id_comptag", "dep", "route", "pr", "abs")
    out = linear.locate(points, markers, edges, neighbours, gap=150.0)
    return out.withColumns({c: F.round(c, 6) for c in "xy"})


@query(f"""
SELECT c.id_comptag, CASE WHEN dep % 6 = 0 THEN NULL ELSE gid END AS gid, CASE WHEN dep % 6 = 0 THEN 'sans geometrie' WHEN gid IS NULL THEN 'loin' WHEN n = 1 THEN 'seul' ELSE 'plusieurs' END AS classe
FROM compteur c LEFT JOIN (SELECT n.id_comptag, n.gid, count(*) OVER (PARTITION BY n.gid) AS n FROM {_NEAREST} n JOIN compteur k USING (id_comptag) WHERE k.dep % 6 <> 0) m USING (id_comptag)""")
def geo_split_by_section(spark, d):
    c = S.compteur(spark, d).withColumn("x", F.when(F.col("dep") % 6 != 0, F.col("x")))
    return geo.split_by_section(c, S.sections(spark, d), DIST, cell=CELL).select("id_comptag", "gid", "classe")


@query(f"""
SELECT a.id_comptag AS id_gest, b.id_gti, a.gid FROM (SELECT n.* FROM {_NEAREST} n JOIN compteur c USING (id_comptag) WHERE c.dep % 2 = 0) a
JOIN (SELECT gid, arg_min(id_comptag, (distance, id_comptag)) AS id_gti FROM {_NEAREST} n JOIN compteur c USING (id_comptag) WHERE c.dep % 2 = 1 GROUP BY 1) b USING (gid)""")
def geo_same_segment(spark, d):
    c = S.compteur(spark, d)
    return geo.same_segment(c.where("dep % 2 = 0"), c.where("dep % 2 = 1"), S.sections(spark, d), DIST, cell=CELL)


def edges(spark, d):
    """Each part is an edge; eight in a row form a segment of a road, chained by their nodes; every 11th edge is missing."""
    p = S.table(spark, d, "part").where("p_partkey % 11 <> 0").select(F.col("p_partkey").alias("id"))
    i = F.col("id")
    return p.select("id", i.alias("source"), (i + 1).alias("target"), F.floor(i / 8).alias("segment"), F.concat(F.lit("D"), F.floor(i / 40).cast("string")).alias("route"), (i % 60 + 1).cast("double").alias("longueur"))


_EDGES = "(SELECT p_partkey AS id, p_partkey AS source, p_partkey + 1 AS target, p_partkey // 8 AS segment, 'D' || (p_partkey // 40) AS route, CAST(p_partkey % 60 + 1 AS DOUBLE) AS longueur FROM part WHERE p_partkey % 11 <> 0)"
_NODES = f"(SELECT segment, unnest([source, target]) AS noeud FROM {_EDGES})"
_ENDS = f"(SELECT segment, noeud FROM {_NODES} GROUP BY 1, 2 HAVING count(*) = 1)"


@query(f"SELECT * FROM {_ENDS}")
def net_end_nodes(spark, d):
    return net.end_nodes(edges(spark, d))


@query(f"""
SELECT e.segment, e.noeud, string_agg(DISTINCT CAST(o.segment AS VARCHAR), ',' ORDER BY CAST(o.segment AS VARCHAR)) AS voisins FROM {_ENDS} e
JOIN (SELECT noeud, segment, count(*) OVER (PARTITION BY noeud) AS n, l FROM {_ENDS} JOIN (SELECT segment, sum(longueur) AS l FROM {_EDGES} GROUP BY 1) USING (segment)) o ON o.noeud = e.noeud AND o.segment <> e.segment AND (o.n <= 2 OR o.l > 50) GROUP BY 1, 2""")
def net_touching_segments(spark, d):
    return net.touching_segments(edges(spark, d)).select("segment", "noeud", F.array_join(F.array_sort(F.col("voisins").cast("array<string>")), ",").alias("voisins"))


@query(f"SELECT s.segment, min(noeud) AS debut, max(noeud) AS fin FROM (SELECT DISTINCT segment FROM {_EDGES}) s LEFT JOIN {_ENDS} USING (segment) GROUP BY 1")
def net_segment_graph(spark, d):
    return net.segment_graph(edges(spark, d))


@query(f"""
SELECT DISTINCT id, r AS rond_point, r * 20 AS noeud_commun, n > 2 AS ferme FROM (SELECT id, route, noeud // 20 AS r FROM (SELECT id, route, unnest([source, target]) AS noeud FROM {_EDGES}) WHERE noeud % 20 < 3)
JOIN (SELECT noeud // 20 AS r, count(DISTINCT route) AS n FROM (SELECT id, route, unnest([source, target]) AS noeud FROM {_EDGES}) WHERE noeud % 20 < 3 GROUP BY 1) USING (r)""")
def net_roundabout_segments(spark, d):
    e = edges(spark, d)
    # nodes 20k, 20k+1 and 20k+2 form a roundabout
    nodes = S.table(spark, d, "part").select(F.floor((F.col("p_partkey") + 1) / 20).alias("rond_point")).distinct().withColumn("noeud", F.explode(F.array(*[F.col("rond_point") * 20 + k for k in range(3)])))
    return net.roundabout_segments(e, nodes)


@query(f"SELECT a.id, b.id AS voisin, a.noeud FROM (SELECT id, unnest([source, target]) AS noeud FROM {_EDGES}) a JOIN (SELECT id, unnest([source, target]) AS noeud FROM {_EDGES}) b USING (noeud) WHERE a.id <> b.id")
def net_adjacent_edges(spark, d):
    return net.adjacent_edges(edges(spark, d))


@query(f"SELECT segment, count(*) FILTER (WHERE n = 1) = 2 AS continu FROM (SELECT segment, noeud, count(*) AS n FROM {_NODES} GROUP BY 1, 2) GROUP BY 1")
def net_continuity_check(spark, d):
    return net.continuity(edges(spark, d))


@query(f"""
WITH chains AS (
  SELECT id, segment, row_number() OVER w - 1 AS rang, CASE WHEN id % 3 = 0 AND count(*) OVER (PARTITION BY segment) > 1 THEN -1 ELSE 1 END AS sens FROM (
    SELECT id, min(id) OVER (PARTITION BY g) AS segment FROM (SELECT id, sum(new) OVER (ORDER BY id) AS g FROM (
      SELECT id, CASE WHEN lag(id) OVER (ORDER BY id) = id - 1 AND lag(route) OVER (ORDER BY id) = route THEN 0 ELSE 1 END AS new FROM {_EDGES})))
  WINDOW w AS (PARTITION BY segment ORDER BY id)
), squares AS (SELECT -s_suppkey AS id, s_suppkey % 5 AS j, count(*) OVER g AS n, max(s_suppkey % 5) OVER g AS last, -max(s_suppkey) OVER g AS segment FROM supplier WINDOW g AS (PARTITION BY s_suppkey // 5))
SELECT id, segment, rang, sens, false AS boucle FROM chains
UNION ALL SELECT id, segment, CASE WHEN n = 5 THEN (j + 1) % 5 ELSE last - j END, CASE WHEN n = 5 OR n = 1 THEN 1 ELSE -1 END, n = 5 FROM squares""")
def net_base_segments(spark, d):
    """Chains of edges of which every third is drawn against the others, and rings of five."""
    e = edges(spark, d).select("id", "route", *[F.when(F.col("id") % 3 == 0, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("source", "target"), ("target", "source"))])
    k = F.col("s_suppkey")
    corner = lambda j: -(F.floor(k / 5) * 5 + j % 5) - 1
    rings = S.table(spark, d, "supplier").select((-k).alias("id"), F.concat(F.lit("R"), F.floor(k / 5).cast("string")).alias("route"), corner(k).alias("source"), corner(k + 1).alias("target"))
    return net.base_segments(e.unionByName(rings))
