"""Lines of edges and places along broken roads, by hand and by walking."""

import random

import pytest
from pyspark.sql import functions as F

from roadtally.operators import linear, network

EDGE = "id long, dep int, route string, source long, target long, x0 double, y0 double, x1 double, y1 double"


def walked(edges):
    """id -> segment, rang, sens, debut, boucle by following the ends."""
    whole, ends, out = {e[0]: e for e in edges}, {}, {}
    for i, s, t, road, _ in edges:
        ends.setdefault((s, road), []).append((i, -1))
        ends.setdefault((t, road), []).append((i, 1))
    after = {}
    for two in ends.values():
        if len(two) == 2 and two[0][0] != two[1][0]:
            (a, x), (b, y) = two
            after[a, x], after[b, y] = (b, -y), (a, -x)

    def follow(dart):
        line = [dart]
        while line[-1] in after and after[line[-1]] != dart:
            line.append(after[line[-1]])
        return line

    for i in whole:
        if i in out:
            continue
        line = follow((i, 1))
        ring = line[-1] in after
        if ring:
            line = follow((min(k for k, _ in line), 1))
        else:
            line = follow((line[-1][0], -line[-1][1]))
            line = [(i, 1)] if len(line) == 1 else line if line[0][0] < line[-1][0] else [(k, -s) for k, s in line[::-1]]
        debut = 0.0
        for rang, (k, sens) in enumerate(line):
            out[k] = (min(k for k, _ in line), rang, sens, debut, ring or whole[k][1] == whole[k][2])
            debut += whole[k][4]
    return out


def ranked(spark, edges):
    df = spark.createDataFrame([tuple(e) for e in edges], "id long, source long, target long, route string, longueur double")
    return {r.id: (r.segment, r.rang, r.sens, r.debut, r.boucle) for r in network.rank_lines(df).collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_of_a_random_network(spark, seed):
    random.seed(seed)
    edges, node = [], 0
    for k in range(40):
        n, ring = random.randint(2, 20), random.random() < 0.4
        nodes = list(range(node, node + n))
        for a, b in [*zip(nodes, nodes[1:]), *([(nodes[-1], nodes[0])] if ring and n > 2 else [])]:
            edges.append([0, *random.sample([a, b], 2), f"r{k % 3}", float(random.randint(0, 50))])
        node += n + random.choice([0, 1, 1])
    edges += [[0, 9000, 9000, "r0", 5.0], [0, 9001, 9002, "r0", 1.0], [0, 9001, 9002, "r0", 2.0]]  # a loop, and a ring of two
    for e, i in zip(edges, random.sample(range(1, 10 * len(edges)), len(edges))):
        e[0] = i
    assert ranked(spark, edges) == walked(edges)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, counted = [], network._counted
    monkeypatch.setattr(network, "_counted", lambda df: rounds.append(0) or counted(df))
    n = 100_000
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, F.col("id") + 1).otherwise(F.col("id")).alias("source"), F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.col("id") + 1).alias("target"), F.lit("a").alias("route"))
    wrong = network.rank_lines(df).where("segment <> 0 or rang <> id or sens <> if(id % 3 = 0, -1, 1) or boucle").count()
    assert wrong == 0 and len(rounds) <= 20


def test_no_edges_and_null_nodes(spark):
    assert ranked(spark, []) == {}
    assert ranked(spark, [(1, None, 5, "a", 1.0), (2, 5, None, "a", 1.0), (3, None, None, "a", 1.0)]) == {1: (1, 0, 1, 0.0, False), 2: (1, 1, 1, 1.0, False), 3: (3, 0, 1, 0.0, False)}


def road(route, *points, first=1, dep=17, node=None, back=()):
    """Edges between neighbouring points; those in ``back`` are drawn the other way."""
    node = node or first * 1000
    out = []
    for k, (a, b) in enumerate(zip(points, points[1:])):
        ends = ((node + k, a), (node + k + 1, b))
        (s, p), (t, q) = ends[::-1] if k in back else ends
        out.append((first + k, dep, route, s, t, *map(float, p), *map(float, q)))
    return out


#: The nine situations: edges, markers, point (pr, abs), place and remark.
CASES = {
    "continuous between two markers": (road("A", (0, 0), (600, 0), (600, 600), back=(1,)), [(17, "A", 14, 0, 0), (17, "A", 15, 600, 400)], (14, 680), (600, 80), "OK"),
    "roundabout of another road between the markers": (road("A", (0, 0), (480, 0)) + road("A", (520, 0), (1100, 0), first=20) + road("B", (480, 0), (500, 20), (520, 0), (500, -20), (480, 0), first=40), [(17, "A", 3, 0, 0), (17, "A", 4, 1000, 0)], (3, 940), (940, 0), "OK"),
    "many gaps of several lengths": (road("A", (0, 0), (100, 0)) + road("A", (300, 0), (130, 0), first=20) + road("A", (420, 0), (600, 0), first=30) + road("A", (980, 0), (605, 0), first=40) + road("A", (1040, 0), (1500, 0), first=50), [(17, "A", 41, 20, 0), (17, "A", 42, 1020 + 60, 0)], (41, 940), (960, 0), "OK"),
    "no next marker": (road("A", (900, 0), (500, 0), (0, 0)), [(17, "A", 74, 100, 0), (17, "A", 75, 400, 3)], (75, 400), (800, 0), "OK"),
    "edges of the neighbouring département": (road("A", (0, 0), (50, 0)) + road("A", (50, 0), (400, 0), first=20, dep=16, node=1001), [(17, "A", 32, 10, 0)], (32, 100), (110, 0), "OK"),
    "interrupted, place before the gap": (road("A", (0, 0), (500, 0)) + road("A", (600, 0), (1200, 0), first=20), [(17, "A", 52, 0, 0), (17, "A", 53, 1000, 0)], (52, 440), (440, 0), "OK"),
    "interrupted, place behind the gap": (road("A", (0, 0), (300, 0)) + road("A", (400, 0), (1200, 0), first=20), [(17, "A", 6, 0, 0), (17, "A", 7, 1000, 0)], (6, 460), (460, 0), "OK"),
    "road without markers": (road("A", (0, 0), (300, 0)), [(17, "B", 0, 0, 0)], (0, 80), None, "KO route non présente dans le référentiel PR / KO Pas de PR / KO pas de fichier de géolocalisation"),
    "marker 0 alone": (road("A", (0, 0), (300, 0), (300, 500)), [(17, "A", 0, 1, 1)], (0, 380), (300, 81), "OK"),
    "marker unknown": (road("A", (0, 0), (300, 0)), [(17, "A", 0, 0, 0)], (9, 80), None, "KO Pas de PR / KO pas de fichier de géolocalisation"),
    "marker far from the road": (road("A", (0, 0), (300, 0)), [(17, "A", 0, 0, 50)], (0, 80), None, "KO PR hors du linéaire"),
    "beyond the end": (road("A", (0, 0), (300, 0)), [(17, "A", 0, 0, 0)], (0, 380), None, "KO hors de la route"),
    "in a gap": (road("A", (0, 0), (100, 0)) + road("A", (200, 0), (300, 0), first=20), [(17, "A", 0, 0, 0), (17, "A", 1, 300, 0)], (0, 150), (150, 0), "OK"),
    "a gap too long": (road("A", (0, 0), (100, 0)) + road("A", (400, 0), (900, 0), first=20), [(17, "A", 0, 0, 0)], (0, 450), None, "KO hors de la route"),
    "a ring": (road("A", (0, 0), (100, 0), (100, 100), (0, 100)) + [(4, 17, "A", 1003, 1000, 0.0, 100.0, 0.0, 0.0)], [(17, "A", 0, 0, 50), (17, "A", 1, 0, 0)], (0, 75), (25, 0), "OK"),
    "a département that is no neighbour": (road("A", (0, 0), (50, 0)) + road("A", (50, 0), (400, 0), first=20, dep=33, node=1001), [(17, "A", 32, 10, 0)], (32, 100), None, "KO hors du département"),
}


def test_places_on_broken_roads(spark):
    """All situations in one network: every case has a road name of its own and stands apart."""
    edges, markers, points = [], [], []
    for n, (e, m, (pr, away), _, _) in enumerate(CASES.values()):
        at = n * 100_000
        edges += [(i + at, dep, f"{r}{n}", s + at * 10, t + at * 10, x0, y0 + at, x1, y1 + at) for i, dep, r, s, t, x0, y0, x1, y1 in e]
        markers += [(dep, f"{r}{n}", k, float(x), float(y + at)) for dep, r, k, x, y in m]
        points.append((f"P{n}", 17, f"A{n}", pr, away))
    found = linear.locate(
        spark.createDataFrame(points, "id_comptag string, dep int, route string, pr int, abs int"), spark.createDataFrame(markers, "dep int, route string, pr int, x double, y double"),
        spark.createDataFrame(edges, EDGE), spark.createDataFrame([(17, 16), (17, 24)], "dep int, voisin int"),
    )
    found = {r.id_comptag: r for r in found.collect()}
    for n, (name, (_, _, _, place, note)) in enumerate(CASES.items()):
        r = found[f"P{n}"]
        assert (name, r.commentaire) == (name, note)
        assert (name, None if r.x is None else (round(r.x, 6), round(r.y - n * 100_000, 6))) == (name, place)


def test_one_road_of_many_edges(spark):
    """Every edge is met by the places of its own stretch only."""
    n = 20_000
    edges = spark.range(n).select("id", F.lit(1).alias("dep"), F.lit("N1").alias("route"), F.col("id").alias("source"), (F.col("id") + 1).alias("target"), (F.col("id") * 5.0).alias("x0"), F.lit(0.0).alias("y0"), (F.col("id") * 5.0 + 5).alias("x1"), F.lit(0.0).alias("y1"))
    markers = spark.range(n // 200).select(F.lit(1).alias("dep"), F.lit("N1").alias("route"), F.col("id").cast("int").alias("pr"), (F.col("id") * 1000.0).alias("x"), F.lit(0.0).alias("y"))
    points = spark.range(5000).select(F.col("id").cast("string").alias("id_comptag"), F.lit(1).alias("dep"), F.lit("N1").alias("route"), (F.col("id") % 100).cast("int").alias("pr"), (F.col("id") % 997).cast("int").alias("abs"))
    wrong = linear.locate(points, markers, edges).join(points, "id_comptag").where("commentaire <> 'OK' or abs(x - pr * 1000 - abs) > 1e-6 or y <> 0")
    assert wrong.count() == 0


def test_nothing_to_locate(spark):
    none = lambda schema: spark.createDataFrame([], schema)
    points, markers = "id_comptag string, dep int, route string, pr int, abs int", "dep int, route string, pr int, x double, y double"
    assert linear.locate(none(points), none(markers), none(EDGE)).collect() == []
    (r,) = linear.locate(spark.createDataFrame([("P", 1, None, None, None)], points), none(markers), none(EDGE)).collect()
    assert (r.x, r.commentaire) == (None, f"{linear.NO_ROAD} / {linear.NO_MARKER} / {linear.NO_PLACE}")
