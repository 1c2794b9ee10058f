"""Points, lines and distance joins, as column arithmetic and grid-cell equi-joins.

A distance join of points and segments puts every segment into the grid cells
that its surroundings touch, and every point into its own cell; only pairs of
one cell are measured.  The cell size is the search distance, or larger where
segments are long, so that a segment lies in few cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise

#: Fixed values of the Lambert-93 projection (EPSG 2154, method 9802 on GRS80).
A, E2 = 6378137.0, 0.006694380022900787
LON0, LAT0, LAT1, LAT2, X0, Y0 = 3.0, 46.5, 44.0, 49.0, 700000.0, 6600000.0


def _cone() -> tuple[float, float, float]:
    """Exponent, scale and radius of the origin of the projection's cone."""
    e = math.sqrt(E2)
    m = lambda p: math.cos(p) / math.sqrt(1 - E2 * math.sin(p) ** 2)
    t = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p0, p1, p2 = map(math.radians, (LAT0, LAT1, LAT2))
    n = math.log(m(p1) / m(p2)) / math.log(t(p1) / t(p2))
    f = m(p1) / (n * t(p1) ** n)
    return n, A * f, A * f * t(p0) ** n


N, SCALE, R0 = _cone()


def to_lambert93(lon: Column, lat: Column) -> Column:
    """WGS84 degrees to Lambert-93 metres: struct of x, y."""
    e, p = math.sqrt(E2), F.radians(lat)
    s = e * F.sin(p)
    t = F.tan(math.pi / 4 - p / 2) / F.pow((1 - s) / (1 + s), F.lit(e / 2))
    r, angle = SCALE * F.pow(t, F.lit(N)), N * F.radians(lon - LON0)
    return F.struct((X0 + r * F.sin(angle)).alias("x"), (Y0 + R0 - r * F.cos(angle)).alias("y"))


def from_lambert93(x: Column, y: Column, rounds: int = 6) -> Column:
    """Lambert-93 metres to WGS84 degrees: struct of lon, lat; the latitude by fixed-point rounds."""
    e = math.sqrt(E2)
    dx, dy = x - X0, R0 - (y - Y0)
    t = F.pow(F.sqrt(dx * dx + dy * dy) / SCALE, F.lit(1 / N))
    p = math.pi / 2 - 2 * F.atan(t)
    for _ in range(rounds):
        s = e * F.sin(p)
        p = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(e / 2)))
    return F.struct((F.degrees(F.atan(dx / dy)) / N + LON0).alias("lon"), F.degrees(p).alias("lat"))


def xy(df: DataFrame, x: str, y: str) -> DataFrame:
    """Coordinates with three decimals; null where either is unknown."""
    known = F.col(x).isNotNull() & F.col(y).isNotNull()
    return df.withColumns({"x_l93": F.when(known, F.round(x, 3)), "y_l93": F.when(known, F.round(y, 3))})


def degrees_text(c: Column) -> Column:
    """``+45.6021.6666.`` as 45.60216666."""
    return F.regexp_replace(F.regexp_replace(c, r"\.$", ""), r"^(\+?-?\d+\.\d+)\.(\d+)$", "$1$2").try_cast("double")


def midpoint(df: DataFrame, key: str, x: str = "x", y: str = "y") -> DataFrame:
    return df.groupBy(key).agg(F.avg(x).alias("x"), F.avg(y).alias("y"))


def segment_distance(x: Column, y: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    dx, dy = x1 - x0, y1 - y0
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((x - x0) * dx + (y - y0) * dy, dx * dx + dy * dy), F.lit(0.0))))
    px, py = x - (x0 + t * dx), y - (y0 + t * dy)
    return F.sqrt(px * px + py * py)


def line_distance(x: Column, y: Column, points: Column) -> Column:
    """From a point to a polyline: an array of structs x, y."""
    legs = F.zip_with(F.slice(points, 1, F.size(points) - 1), F.slice(points, 2, F.size(points) - 1), lambda a, b: segment_distance(x, y, a["x"], a["y"], b["x"], b["y"]))
    return F.array_min(legs)


def nearest(points: DataFrame, segments: DataFrame, distance: float, key: str = "id_comptag", seg: str = "gid", cell: float | None = None, on: tuple[str, ...] = ()) -> DataFrame:
    """For each point (x, y) the nearest segment (x0, y0, x1, y1) within the distance, of those equal in ``on``; ties go to the smaller key.

    A segment is put in those cells of its bounding box, widened by the
    distance, that it really comes near: long segments stay in few cells.
    """
    c = cell or distance
    lo = lambda a, b: F.floor((F.least(a, b) - distance) / c)
    hi = lambda a, b: F.floor((F.greatest(a, b) + distance) / c)
    cells = segments.select("*", F.explode(F.sequence(lo("x0", "x1"), hi("x0", "x1"))).alias("cx")).select("*", F.explode(F.sequence(lo("y0", "y1"), hi("y0", "y1"))).alias("cy"))
    middle = segment_distance((F.col("cx") + 0.5) * c, (F.col("cy") + 0.5) * c, *map(F.col, ("x0", "y0", "x1", "y1")))
    cells = cells.where(middle <= distance + c * math.sqrt(2) / 2)
    p = points.withColumns({"cx": F.floor(F.col("x") / c), "cy": F.floor(F.col("y") / c)})
    d = segment_distance(*map(F.col, ("x", "y", "x0", "y0", "x1", "y1")))
    pairs = p.join(cells, [*on, "cx", "cy"]).withColumn("distance", d).where(F.col("distance") <= distance)
    best = pairs.groupBy(key).agg(F.min(F.struct("distance", seg)).alias("b"))
    return best.select(key, F.col(f"b.{seg}").alias(seg), F.col("b.distance").alias("distance"))


def pairs_within(points: DataFrame, others: DataFrame, distance: float) -> DataFrame:
    """All pairs of points (x, y) and (ox, oy) within the distance."""
    step = F.explode(F.array(*[F.lit(k) for k in (-1, 0, 1)]))
    o = others.withColumn("cx", F.floor(F.col("ox") / distance)).withColumn("cy", F.floor(F.col("oy") / distance))
    o = o.withColumn("sx", step).withColumn("sy", step).withColumns({"cx": F.col("cx") + F.col("sx"), "cy": F.col("cy") + F.col("sy")}).drop("sx", "sy")
    p = points.withColumns({"cx": F.floor(F.col("x") / distance), "cy": F.floor(F.col("y") / distance)})
    d = F.hypot(F.col("x") - F.col("ox"), F.col("y") - F.col("oy"))
    return p.join(o, ["cx", "cy"]).withColumn("distance", d).where(F.col("distance") <= distance).drop("cx", "cy")


def post_rank(c: Column) -> Column:
    return F.when(c == "permanent", 3).when(c == "tournant", 2).otherwise(1)


def best_counter_per_section(points: DataFrame, segments: DataFrame, distance: float, cell: float | None = None) -> DataFrame:
    """Of the counters nearest to each section: kind, then outside holidays, then traffic; ties by id."""
    n = nearest(points, segments, distance, cell=cell).join(points, "id_comptag")
    order = F.struct((-post_rank(F.col("type_poste"))).alias("a"), F.col("vacances").alias("b"), (-F.col("tmja")).alias("c"), F.col("id_comptag").alias("d"))
    return n.groupBy("gid").agg(F.min_by("id_comptag", order).alias("id_comptag"), F.count("*").alias("n"))


def section_tree(points: DataFrame, edges: DataFrame, sections: DataFrame, distance: float, cell: float | None = None) -> DataFrame:
    """Counter -> nearest edge -> section -> every edge of the section; edges without counter stay."""
    member = sections.select("gid", F.explode("list_id").alias("id"))
    n = nearest(points, edges, distance, seg="id", cell=cell).join(member, "id")
    best = n.groupBy("gid").agg(F.min_by("id_comptag", F.struct("distance", "id_comptag")).alias("id_comptag"))
    return member.join(best, "gid", "left").select("id", "gid", "id_comptag")


def zone_cover(zones: DataFrame, depth: int = 6) -> DataFrame:
    """Cells that cover each zone: k (cells are 2^k wide), cx, cy, plein (wholly inside), aretes (edges to test otherwise).

    ``zones``: ``rings``, an array of rings (arrays of structs x, y); a point is
    inside when a ray to the right meets an odd number of edges, so that inner
    rings are holes and further outer ones are parts.  A zone begins as one to
    four cells of its own size.  Cells that an edge touches are quartered
    ``depth`` times, others stay as they are or go, so that the cells grow with
    the outline and not with the area: some 4 * 2^depth of a zone, however large.
    A cell keeps the edges of its own height that reach to its right side or
    beyond its left one, which decide every point in it.
    """
    turned = lambda r: F.concat(F.slice(r, 2, F.size(r) - 1), F.slice(r, 1, 1))
    edge = lambda a, b: F.struct(a["x"].alias("x0"), a["y"].alias("y0"), b["x"].alias("x1"), b["y"].alias("y1"))
    rings = F.filter("rings", lambda r: F.size(r) > 0)
    z = zones.withColumn("aretes", F.flatten(F.transform(rings, lambda r: F.zip_with(r, turned(r), edge)))).where(F.size("aretes") > 0).drop("rings")
    ends = lambda axis: F.flatten(F.transform("aretes", lambda e: F.array(e[f"{axis}0"], e[f"{axis}1"])))
    z = z.withColumns({f"{f}_{axis}": g(ends(axis)) for axis in "xy" for f, g in (("lo", F.array_min), ("hi", F.array_max))})
    side = F.greatest(F.col("hi_x") - F.col("lo_x"), F.col("hi_y") - F.col("lo_y"), F.lit(1e-3))
    z = z.withColumn("k", F.ceil(F.log2(side)).cast("int"))
    across = lambda axis: F.explode(F.sequence(F.floor(F.col(f"lo_{axis}") / F.pow(F.lit(2.0), "k")), F.floor(F.col(f"hi_{axis}") / F.pow(F.lit(2.0), "k"))))
    z = z.withColumn("cx", across("x")).withColumn("cy", across("y")).drop("lo_x", "hi_x", "lo_y", "hi_y").withColumn("plein", F.lit(None).cast("boolean"))
    z = _classified(z)
    for _ in range(depth):
        half = lambda c, d: (F.col(c) * 2 + d).alias(c)
        open_ = F.col("plein").isNull()
        four = F.array(*[F.struct((F.col("k") - 1).alias("k"), half("cx", dx), half("cy", dy)) for dx in (0, 1) for dy in (0, 1)])
        parts = F.explode(F.when(open_, four).otherwise(F.array(F.struct("k", "cx", "cy"))))
        z = _classified(z.select(*[c for c in z.columns if c not in ("k", "cx", "cy")], parts.alias("c")).select("*", "c.*").drop("c"))
    return z.withColumn("plein", F.coalesce("plein", F.lit(False)))


def _crossings(edges: Column, x: Column, y: Column) -> Column:
    """Edges that a ray from a point to the right meets."""
    at = lambda e: e["x0"] + (y - e["y0"]) * (e["x1"] - e["x0"]) / F.nullif(e["y1"] - e["y0"], F.lit(0.0))
    return F.size(F.filter(edges, lambda e: ((e["y0"] > y) != (e["y1"] > y)) & (x < at(e))))


def _classified(cells: DataFrame) -> DataFrame:
    """Cells that no edge touches are inside or dropped; the others keep the edges that matter for them."""
    w = F.pow(F.lit(2.0), "k")
    x0, y0 = F.col("cx") * w, F.col("cy") * w
    x1, y1 = x0 + w, y0 + w
    band = F.filter("aretes", lambda e: (F.greatest(e["y0"], e["y1"]) >= y0) & (F.least(e["y0"], e["y1"]) <= y1) & (F.greatest(e["x0"], e["x1"]) >= x0))
    c = cells.withColumn("aretes", F.when(F.col("plein").isNull(), band))

    def touches(e: Column) -> Column:
        """Not to the right of the cell, and with a corner on each side, or on the line."""
        side = lambda x, y: (e["x1"] - e["x0"]) * (y - e["y0"]) - (e["y1"] - e["y0"]) * (x - e["x0"])
        corners = [side(x, y) for x in (x0, x1) for y in (y0, y1)]
        return (F.least(e["x0"], e["x1"]) <= x1) & (F.least(*corners) <= 0) & (F.greatest(*corners) >= 0)

    inside = _crossings(F.col("aretes"), (x0 + x1) / 2, (y0 + y1) / 2) % 2 == 1
    c = c.withColumn("plein", F.when(F.col("plein").isNotNull(), F.col("plein")).when(~F.exists("aretes", touches), inside))
    return c.where(F.coalesce("plein", F.lit(True))).withColumn("aretes", F.when(F.col("plein").isNull(), F.col("aretes")))


def within_zone(points: DataFrame, zones: DataFrame, depth: int = 6) -> DataFrame:
    """Points inside zones (``rings``: arrays of rings, arrays of structs x, y, holes among them), with the zone's other columns.

    Points meet the cells of ``zone_cover`` by an equi-join on each size that
    cells have; in a cell that lies wholly inside nothing more is asked, in one
    on the outline the ray is cast at the edges that it keeps.
    """
    cover = materialise(zone_cover(zones, depth), "zone-cover")
    sizes = sorted(r[0] for r in cover.select("k").distinct().collect())  # at most one for each power of two
    if not sizes:
        return points.join(cover.drop("k", "cx", "cy", "plein", "aretes"), F.lit(False))
    p = points.where(~F.isnan("x") & ~F.isnan("y")).withColumn("k", F.explode(F.array(*[F.lit(k) for k in sizes])))
    cell = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), "k"))
    j = p.withColumns({"cx": cell("x"), "cy": cell("y")}).join(cover, ["k", "cx", "cy"])
    return j.where(F.col("plein") | (_crossings(F.col("aretes"), F.col("x"), F.col("y")) % 2 == 1)).drop("k", "cx", "cy", "plein", "aretes")


def split_by_section(points: DataFrame, segments: DataFrame, distance: float, cell: float | None = None) -> DataFrame:
    """One ``classe`` for each new point: without geometry, far from the network, alone on its section, or one of several."""
    n = nearest(points.where("x is not null and y is not null"), segments, distance, cell=cell)
    several = n.groupBy("gid").agg(F.count("*").alias("n"))
    j = points.join(n.join(several, "gid"), "id_comptag", "left")
    kind = F.when(F.col("x").isNull() | F.col("y").isNull(), "sans geometrie").when(F.col("gid").isNull(), "loin").when(F.col("n") == 1, "seul").otherwise("plusieurs")
    return j.withColumn("classe", kind).drop("n")


def same_segment(new: DataFrame, stored: DataFrame, segments: DataFrame, distance: float, cell: float | None = None) -> DataFrame:
    """Mapping rows: new points that lie on the same segment as a stored point."""
    a = nearest(new, segments, distance, cell=cell).select(F.col("id_comptag").alias("id_gest"), "gid")
    b = nearest(stored, segments, distance, cell=cell).groupBy("gid").agg(F.min_by("id_comptag", F.struct("distance", "id_comptag")).alias("id_gti"))
    return a.join(b, "gid").select("id_gest", "id_gti", "gid")
