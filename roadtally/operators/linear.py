"""Linear referencing: places of marker + distance along roads whose geometry is broken.

Edges of a road are chained to pieces by list ranking (``network.rank_lines``).
A road is broken where its edges don't meet: at roundabouts that bear another
road's name, at missing edges, at forks.  ``road_lines`` bridges such places:
free ends of one road that are each other's nearest within the longest gap are
joined by a straight leg, round by round until no pair is left, and the pieces
are ranked once more.  Every edge then has a stretch of one measure along its
line, so that markers and places on it are numbers, and the edge at a place is
found by an equi-join on stretches of fixed length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import forget, materialise
from . import geo
from .network import rank_lines

NO_ROAD, NO_MARKER, NO_PLACE = "KO route non présente dans le référentiel PR", "KO Pas de PR", "KO pas de fichier de géolocalisation"
OFF_LINE, BEYOND, ABROAD = "KO PR hors du linéaire", "KO hors de la route", "KO hors du département"
MOST_ROUNDS = 64


def _pieces(edges: DataFrame) -> DataFrame:
    """Edges with their place in their piece, ends in its direction (ax, ay to bx, by)."""
    long = F.hypot(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    e = edges.withColumn("longueur", F.coalesce("longueur", long) if "longueur" in edges.columns else long)
    ranked = rank_lines(e).select("id", F.col("segment").alias("piece"), "rang", "sens", "debut", "boucle")
    along = F.col("sens") == 1
    turned = {c: F.when(along, F.col(a)).otherwise(F.col(b)) for c, a, b in (("ax", "x0", "x1"), ("ay", "y0", "y1"), ("bx", "x1", "x0"), ("by", "y1", "y0"))}
    return materialise(e.join(ranked, "id").withColumns(turned).drop("x0", "y0", "x1", "y1", "source", "target"), "line-pieces")


def _bridges(ends: DataFrame, gap: float) -> DataFrame:
    """Pairs of free ends of one road that are nearest to each other: a, b (bout) and their distance.

    ``ends``: route, bout (piece, end), chaine, x, y; ends of one chain are never joined.  Ties go to the smaller end.
    """
    step = F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))
    cell = lambda c: F.floor(F.col(c) / gap)
    o = ends.select("route", F.col("bout").alias("o"), F.col("chaine").alias("oc"), F.col("x").alias("ox"), F.col("y").alias("oy"), cell("x").alias("cx"), cell("y").alias("cy"))
    o = o.withColumn("sx", step).withColumn("sy", step).withColumns({"cx": F.col("cx") + F.col("sx"), "cy": F.col("cy") + F.col("sy")})
    d = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
    near = ends.withColumns({"cx": cell("x"), "cy": cell("y")}).join(o, ["route", "cx", "cy"]).where("chaine <> oc").withColumn("d", d).where(F.col("d") <= gap)
    # the pair itself decides among equal distances, so that some pair of ends always agrees
    first, second = F.least("bout", "o"), F.greatest("bout", "o")
    best = near.groupBy("bout").agg(F.min(F.struct(F.col("d").alias("d"), first.alias("a"), second.alias("b"))).alias("m"))
    return best.groupBy("m").agg(F.count("*").alias("n")).where("n = 2").select("m.a", "m.b", "m.d")


def road_lines(edges: DataFrame, gap: float) -> DataFrame:
    """Stretches of all roads: route, ligne, id, debut, fin, x0, y0, x1, y1 (in the line's direction), boucle and the other columns.

    ``edges``: id, route, source, target, x0, y0, x1, y1 and longueur where it is
    not the straight length.  A bridge has a null id and the straight distance
    as its length; no bridge is longer than ``gap``.
    """
    e = _pieces(edges)
    long = F.sum("longueur").alias("longueur")
    sides = e.groupBy("route", "piece", "boucle").agg(long, F.min_by(F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), "rang").alias("first"), F.max_by(F.struct(F.col("bx").alias("x"), F.col("by").alias("y")), "rang").alias("last"))
    sides = materialise(sides, "line-sides")
    bout = lambda end: F.struct(F.col("piece").alias("piece"), F.lit(end).alias("end"))
    both = F.explode(F.array(F.struct(bout(0).alias("bout"), F.col("first").alias("p")), F.struct(bout(1).alias("bout"), F.col("last").alias("p"))))
    ends = materialise(sides.where("not boucle").select("route", F.col("piece").alias("chaine"), both.alias("s")).select("route", "chaine", "s.bout", "s.p.x", "s.p.y"), "line-ends")
    bridges, ranked = None, rank_lines(_graph(sides, None), road=None)
    for _ in range(MOST_ROUNDS):
        found = materialise(_bridges(ends, gap), "line-bridges")
        if found.isEmpty():
            break
        bridges = found if bridges is None else bridges.unionByName(found)
        taken = found.select(F.explode(F.array("a", "b")).alias("bout"))
        # pieces that a bridge has joined are one chain from now on
        ranked = materialise(rank_lines(_graph(sides, bridges), road=None), "line-ranks")
        chain = ranked.where("id.kind = 0").select(F.col("id.a.piece").alias("piece"), F.col("segment.a.piece").alias("c"))
        used = ends
        ends = ends.join(taken, "bout", "left_anti").join(chain, F.col("bout.piece") == F.col("piece")).select("route", F.col("c").alias("chaine"), "bout", "x", "y")
        ends = materialise(ends, "line-ends")
        forget(used)
    else:
        raise RuntimeError("gaps did not settle")
    ranked = ranked.select("id", F.col("segment.a.piece").alias("ligne"), F.col("sens").alias("way"), F.col("debut").alias("at"), F.col("boucle").alias("ring"))
    own = ranked.where("id.kind = 0").select(F.col("id.a.piece").alias("piece"), "ligne", "way", "at", "ring")
    j = e.join(own, "piece").join(sides.select("piece", F.col("longueur").alias("whole")), "piece")
    ahead = F.col("way") == 1
    debut = F.col("at") + F.when(ahead, F.col("debut")).otherwise(F.col("whole") - F.col("debut") - F.col("longueur"))
    kept = [c for c in e.columns if c not in ("piece", "rang", "sens", "debut", "boucle", "ax", "ay", "bx", "by", "longueur")]
    pick = lambda a, b: F.when(ahead, F.col(a)).otherwise(F.col(b))
    out = j.select(*kept, "ligne", debut.alias("debut"), (debut + F.col("longueur")).alias("fin"), pick("ax", "bx").alias("x0"), pick("ay", "by").alias("y0"), pick("bx", "ax").alias("x1"), pick("by", "ay").alias("y1"), (F.col("boucle") | F.col("ring")).alias("boucle"))
    if bridges is not None:
        place = lambda end: sides.select(F.explode(F.array(F.struct(bout(0).alias(end), F.col("first").alias("p" + end)), F.struct(bout(1).alias(end), F.col("last").alias("p" + end)))).alias("s"), "route").select("s.*", "route")
        b = bridges.join(place("a"), "a").join(place("b").drop("route"), "b").withColumn("id", _bridge_id())
        b = b.join(ranked, "id").select("route", "ligne", F.col("at").alias("debut"), (F.col("at") + F.col("d")).alias("fin"), *[F.when(ahead, F.col(f"p{s}.{c}")).otherwise(F.col(f"p{t}.{c}")).alias(f"{c}{k}") for k, s, t in ((0, "a", "b"), (1, "b", "a")) for c in "xy"], F.lit(False).alias("boucle"))
        out = out.unionByName(b, allowMissingColumns=True)
    return out


def _bridge_id() -> Column:
    return F.struct(F.lit(1).alias("kind"), F.col("a").alias("a"), F.col("b").alias("b"))


def _graph(sides: DataFrame, bridges: DataFrame | None) -> DataFrame:
    """Pieces and bridges as edges between the ends of pieces."""
    start, end = (F.struct(F.col("piece").alias("piece"), F.lit(k).alias("end")) for k in (0, 1))
    pieces = sides.select(F.struct(F.lit(0).alias("kind"), start.alias("a"), end.alias("b")).alias("id"), start.alias("source"), end.alias("target"), "longueur")
    if bridges is None:
        return pieces
    return pieces.unionByName(bridges.select(_bridge_id().alias("id"), F.col("a").alias("source"), F.col("b").alias("target"), F.col("d").alias("longueur")))


def calibrate(markers: DataFrame, lines: DataFrame, snap: float, cell: float | None = None) -> DataFrame:
    """Markers (dep, route, pr, x, y) with ligne and m, their measure on the nearest stretch of their road within ``snap`` metres.

    Other rows of a marker are taken where the smallest by place; markers off every line are left out.
    """
    m = markers.groupBy("dep", "route", "pr").agg(F.min(F.struct("x", "y")).alias("p")).select(F.struct("dep", "route", "pr").alias("borne"), "route", "p.x", "p.y")
    rows = lines.where("id is not null").withColumn("gid", F.struct("ligne", "debut", "id"))
    near = geo.nearest(m, rows.select("route", "gid", "x0", "y0", "x1", "y1"), snap, key="borne", seg="gid", cell=cell, on=("route",))
    dx, dy = F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((F.col("x") - F.col("x0")) * dx + (F.col("y") - F.col("y0")) * dy, dx * dx + dy * dy), F.lit(0.0))))
    j = near.join(m.drop("route"), "borne").join(rows.select("gid", "ligne", "debut", "fin", "x0", "y0", "x1", "y1"), "gid")
    return j.select("borne.dep", "borne.route", "borne.pr", "ligne", (F.col("debut") + t * (F.col("fin") - F.col("debut"))).alias("m"))


def locate(points: DataFrame, markers: DataFrame, edges: DataFrame, neighbours: DataFrame | None = None, snap: float = 5.0, gap: float = 200.0, step: float = 250.0) -> DataFrame:
    """id_comptag, x, y, commentaire for points (id_comptag, dep, route, pr, abs).

    ``markers``: dep, route, pr, x, y; ``edges``: those of ``road_lines`` with
    dep; ``neighbours``: dep, voisin, whose edges may be used too (all when it is
    not given).  From the marker's measure the place is ``abs`` metres towards the
    next marker on its line; without one away from the marker before it; without
    any to the side on which more of the line is left.  Bridges count by their
    length and places on them are located.  Lines are followed into another
    département.  The remark is OK or all reasons that apply.
    """
    lines = materialise(road_lines(edges, gap), "lines")
    marks = calibrate(markers, lines, snap)
    w = Window.partitionBy("dep", "route", "ligne").orderBy("pr")
    whole = lines.groupBy("ligne").agg(F.max("fin").alias("whole"), F.bool_or("boucle").alias("boucle"))
    marks = marks.join(whole, "ligne")
    # on a ring the shorter way round tells the direction
    way = lambda d: F.nullif(F.signum(F.when(F.col("boucle"), F.pmod(d + F.col("whole") / 2, F.col("whole")) - F.col("whole") / 2).otherwise(d)), F.lit(0.0))
    ahead = F.coalesce(way(F.lead("m").over(w) - F.col("m")), way(F.col("m") - F.lag("m").over(w)), F.when(F.col("m") <= F.col("whole") / 2, 1.0).otherwise(-1.0))
    marks = marks.withColumn("ahead", ahead)
    known = markers.select("dep", "route").distinct().withColumn("__road", F.lit(True))
    there = markers.select("dep", "route", "pr").distinct().withColumn("__marker", F.lit(True))
    p = points.select("id_comptag", "dep", "route", "pr", "abs").withColumn("__row", F.monotonically_increasing_id())
    p = p.join(known, ["dep", "route"], "left").join(there, ["dep", "route", "pr"], "left").join(marks, ["dep", "route", "pr"], "left")
    at = F.col("m") + F.col("ahead") * F.col("abs")
    p = p.withColumn("at", F.when(F.col("boucle"), F.pmod(at, F.col("whole"))).otherwise(at)).drop("boucle")
    p = materialise(p, "line-points")
    stretch = F.floor(F.col("at") / step)
    rows = lines.where("fin > debut").select("ligne", "debut", "fin", "x0", "y0", "x1", "y1", F.col("dep").alias("e_dep"), F.explode(F.sequence(F.floor(F.col("debut") / step), F.floor(F.col("fin") / step))).alias("stretch"))
    # neighbouring stretches meet up to the rounding of sums: the last one that has begun holds the place
    hits = p.where("at is not null and at >= 0").withColumn("stretch", stretch).join(rows, ["ligne", "stretch"]).where("debut <= at and at <= fin + 1e-6")
    found = hits.groupBy("__row").agg(F.max_by(F.struct("debut", "fin", "x0", "y0", "x1", "y1", "e_dep"), "debut").alias("e"))
    j = p.join(found, "__row", "left")
    allowed = F.lit(True)
    if neighbours is not None:
        near = neighbours.select(F.col("dep"), F.col("voisin").alias("v")).distinct().withColumn("__near", F.lit(True))
        j = j.withColumn("v", F.col("e.e_dep")).join(near, ["dep", "v"], "left")
        allowed = F.col("e.e_dep").isNull() | (F.col("e.e_dep") == F.col("dep")) | F.coalesce("__near", F.lit(False))
    t = F.least(F.lit(1.0), (F.col("at") - F.col("e.debut")) / (F.col("e.fin") - F.col("e.debut")))
    spot = lambda c: F.when(allowed, F.col(f"e.{c}0") + t * (F.col(f"e.{c}1") - F.col(f"e.{c}0")))
    marker, road = F.col("__marker").isNotNull(), F.col("__road").isNotNull()
    why = [
        F.when(~road, NO_ROAD), F.when(~marker, NO_MARKER), F.when(~marker, NO_PLACE),
        F.when(marker & F.col("ligne").isNull(), OFF_LINE), F.when(F.col("ligne").isNotNull() & F.col("e").isNull(), BEYOND), F.when(F.col("e").isNotNull() & ~allowed, ABROAD),
    ]
    note = F.concat_ws(" / ", *why)
    return j.select("id_comptag", spot("x").alias("x"), spot("y").alias("y"), F.when(note == "", "OK").otherwise(note).alias("commentaire"))
