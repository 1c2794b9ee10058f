"""The road network as a graph: edges with a source and a target node."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..scratch import forget, materialise


def _ends(edges: DataFrame, *cols: str) -> DataFrame:
    return edges.select(*cols, F.explode(F.array("source", "target")).alias("noeud"))


def end_nodes(edges: DataFrame, segment: str = "segment") -> DataFrame:
    """Nodes that only one end of the segment's edges touches."""
    return _ends(edges, segment).groupBy(segment, "noeud").agg(F.count("*").alias("n")).where("n = 1").drop("n")


def touching_segments(edges: DataFrame, segment: str = "segment", short: float = 50) -> DataFrame:
    """For each end node, the other segments there; where more than two ends meet, segments up to ``short`` metres don't count."""
    length = edges.groupBy(segment).agg(F.sum("longueur").alias("l"))
    ends = end_nodes(edges, segment).join(length, segment)
    crowd = ends.groupBy("noeud").agg(F.count("*").alias("n"))
    e = ends.join(crowd, "noeud")
    o = e.where((F.col("n") <= 2) | (F.col("l") > short)).select("noeud", F.col(segment).alias("autre"))
    j = ends.select(segment, "noeud").join(o, "noeud").where(F.col(segment) != F.col("autre"))
    return j.groupBy(segment, "noeud").agg(F.array_sort(F.collect_set("autre")).alias("voisins"))


def segment_graph(edges: DataFrame, segment: str = "segment") -> DataFrame:
    """Start and end node of each segment; a ring has neither."""
    nodes = end_nodes(edges, segment).groupBy(segment).agg(F.min("noeud").alias("debut"), F.max("noeud").alias("fin"))
    return edges.select(segment).distinct().join(nodes, segment, "left")


def roundabout_segments(edges: DataFrame, roundabouts: DataFrame) -> DataFrame:
    """Edges that enter a roundabout share its smallest node; it closes the segment when more than two roads meet."""
    r = roundabouts.groupBy("rond_point").agg(F.min("noeud").alias("noeud_commun"))
    member = roundabouts.select("rond_point", "noeud")
    e = _ends(edges, "id", "route").join(member, "noeud")
    roads = e.groupBy("rond_point").agg(F.countDistinct("route").alias("routes"))
    return e.select("id", "rond_point").distinct().join(r, "rond_point").join(roads, "rond_point").select("id", "rond_point", "noeud_commun", (F.col("routes") > 2).alias("ferme"))


def adjacent_edges(edges: DataFrame) -> DataFrame:
    """Pairs of an edge and another one at a common node."""
    a, b = _ends(edges, "id"), _ends(edges.withColumnRenamed("id", "voisin"), "voisin")
    return a.join(b, "noeud").where("id <> voisin").select("id", "voisin", "noeud")


def continuity(edges: DataFrame, segment: str = "segment") -> DataFrame:
    """Whether the edges of a segment can form one line: exactly two nodes are touched once."""
    n = _ends(edges, segment).groupBy(segment, "noeud").agg(F.count("*").alias("n"))
    return n.groupBy(segment).agg((F.count_if(F.col("n") == 1) == 2).alias("continu"))


def _lean(place) -> F.Column:
    """The smallest edge of a stretch, how far it is (edges, metres), the direction in which it is passed, its length."""
    return F.struct(F.col("id").alias("id"), F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("l"), F.col("sens").alias("sens"), place.alias("own"))


def _counted(darts: DataFrame) -> tuple[DataFrame, int]:
    """The table of a round, and how many pointers still lead on, counted while it is written."""
    seen = Observation()
    out = materialise(darts.observe(seen, F.count_if(F.col("next").isNotNull()).alias("left")), "net-darts")
    return out, seen.get.get("left", 0)


def rank_lines(edges: DataFrame, road: str | None = "route", every_road: bool = False, most_rounds: int = 64) -> DataFrame:
    """Edges chained through the nodes where just two of them meet, numbered along their line.

    ``edges``: id (any type with an order), source, target, ``road``, and
    ``longueur`` if lengths are wanted.  Returns id, segment (smallest id of the
    line), rang (from 0), sens (1 along source -> target, -1 against it), debut
    (length before the edge), boucle (a ring).  A node joins two edges of one
    road if no third one touches it; with ``every_road``, of any road.  A line
    starts at the end whose edge has the smaller id, a ring with its smallest
    edge, along it; a single edge runs along itself.  An edge whose ends are one
    node is a ring of its own; null nodes join nothing.

    This is list ranking by pointer doubling: an edge is passed in two
    directions, each of which points to what comes next; in every round a
    pointer jumps to where its goal points to, and adds up edges, metres and the
    smallest id.  A chain of n edges is done after log2(n) rounds.  Once a round
    completes nothing, only rings are left, and their pointers have gone round
    when the steps reach their number.  Rounds are tables in the shared folder;
    one that has been used is removed.
    """
    way = F.col(road) if road else F.lit(0)
    length = F.col("longueur").cast("double") if "longueur" in edges.columns else F.lit(0.0)
    e = materialise(edges.select("id", "source", "target", way.alias("way"), F.coalesce(length, F.lit(0.0)).alias("long")), "net-edges")
    # an end of an edge: passed outwards in direction ``out``, inwards in the other
    ends = e.select("id", "way", F.explode(F.array(F.struct(F.col("source").alias("noeud"), F.lit(-1).alias("out")), F.struct(F.col("target").alias("noeud"), F.lit(1).alias("out")))).alias("x")).select("id", "way", "x.*").where("noeud is not null")
    at = ["noeud"] if every_road else ["noeud", "way"]
    two = ends.groupBy(*at).agg(F.count("*").alias("n"), F.min(F.struct("id", "out", "way")).alias("a"), F.max(F.struct("id", "out", "way")).alias("b")).where("n = 2 and a.id <> b.id and a.way <=> b.way")
    turn = lambda a, b: F.struct(F.col(f"{a}.id").alias("id"), F.col(f"{a}.out").alias("sens"), F.struct(F.col(f"{b}.id").alias("id"), (-F.col(f"{b}.out")).alias("sens")).alias("next"))
    after = two.select(F.explode(F.array(turn("a", "b"), turn("b", "a"))).alias("x")).select("x.*")
    state = e.select("id", "long", F.explode(F.array(F.lit(1), F.lit(-1))).alias("sens")).join(after, ["id", "sens"], "left")
    state = state.select(F.struct("id", "sens").alias("dart"), "next", F.lit(1).cast("long").alias("n"), F.col("long").alias("l"), F.col("id").alias("last"), _lean(F.col("long")).alias("least"))
    state, left = _counted(state)
    before = None
    for k in range(most_rounds):
        if left == 0 or left == before and 2**k >= left:
            break
        goal = state.select(F.col("dart").alias("next"), F.struct(F.col("next").alias("next"), "n", "l", "last", "least").alias("g"))
        far = F.struct(F.col("g.least.id").alias("id"), (F.col("g.least.n") + F.col("n")).alias("n"), (F.col("g.least.l") + F.col("l")).alias("l"), F.col("g.least.sens").alias("sens"), F.col("g.least.own").alias("own"))
        moved = state.where("next is not null").join(goal, "next").select("dart", F.col("g.next").alias("next"), (F.col("n") + F.col("g.n")).alias("n"), (F.col("l") + F.col("g.l")).alias("l"), F.col("g.last").alias("last"), F.least("least", far).alias("least"))
        used, before = state, left
        state, left = _counted(state.where("next is null").unionByName(moved))
        forget(used)
    else:
        raise RuntimeError("lines did not settle")
    half = lambda sens, name: state.where(F.col("dart.sens") == sens).select(F.col("dart.id").alias("id"), F.struct("next", "n", "l", "last", "least").alias(name))
    j = half(1, "p").join(half(-1, "q"), "id").join(e.select("id", "long", F.coalesce(F.col("source") == F.col("target"), F.lit(False)).alias("own_ring")), "id")
    ring = F.col("p.next").isNotNull()
    along = F.when(ring, F.col("p.least.sens") == 1).otherwise(F.col("q.last") <= F.col("p.last"))
    back = lambda f: F.when(along, F.col(f"q.{f}")).otherwise(F.col(f"p.{f}"))  # noqa: E731  the direction that leads to the start
    rank = F.when(ring, back("least.n")).otherwise(back("n") - 1)
    start = F.when(~ring, back("l") - F.col("long")).when(back("least.n") > 0, back("least.l") - F.col("long") + back("least.own")).otherwise(0.0)
    out = j.select("id", F.least("p.least.id", "q.least.id").alias("segment"), rank.alias("rang"), F.when(along, 1).otherwise(-1).alias("sens"), start.alias("debut"), (ring | F.col("own_ring")).alias("boucle"))
    return out


def base_segments(edges: DataFrame) -> DataFrame:
    """Edges of one road joined through nodes that only two edges touch: id, segment (its smallest edge), rang, sens, boucle."""
    return rank_lines(edges, every_road=True).drop("debut")
