"""Layouts of sheets and zones, chains of several steps, on small deliveries made by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadtally.functions import scalars as fn
from roadtally.plans import chains, layouts
from roadtally.schemas import MONTHS


@pytest.mark.parametrize(
    "path, folder",
    [
        ("/data/en_cours/rue A/a.mdb", "rue A"),
        ("/data/en_cours/rue A/vers nord/a.mdb", "rue A"),
        ("/data/en_cours/lot/rue A/a.mdb", "rue A"),
        ("/data/en_cours/lot/rue A/poste/a.mdb", "rue A"),
        ("D:\\en_cours\\lot\\rue A\\vers nord\\a.mdb", "rue A"),
        ("/data/en_cours/vers nord/a.mdb", None),
        ("/data/en_cours/a.mdb", None),
        ("/data/en_cours/1/2/3/4/a.mdb", None),
        ("rue A/vers sud/a.mdb", "rue A"),
        ("", None),
        (None, None),
    ],
)
def test_reference_folder(spark, path, folder):
    df = spark.createDataFrame([(path,)], "path string")
    assert df.select(fn.reference_folder(F.col("path"))).first()[0] == folder


def test_cells_of_two_lines(spark):
    rows = [("D 12", "0003+0045", "1250\n6,5%"), ("13", "4+0", "800\nx"), ("14", "4+0", "x"), ("15", None, "900\n1%"), ("16", "1+2", None), ("17", "1+2", "0\n3%")]
    from dataclasses import replace

    out = layouts.shape_table(spark.createDataFrame(rows, "rd string, p_r string, cellule string"), replace(layouts.ANNUAL_CELLS, dep=19))
    assert [tuple(r) for r in out.orderBy("id_comptag").collect()] == [("19-13-4+0", "13", 4, 0, 800, 0.0, "tournant"), ("19-D12-3+45", "D12", 3, 45, 1250, 6.5, "tournant")]


def month_lines(spark, rows):
    """rows: line, heading, route, annual value, January, February."""
    df = spark.createDataFrame(rows, "ligne int, intitule string, route string, annuel double, janv double, fevr double").withColumn("feuille", F.lit("f"))
    return df.withColumns({m: F.lit(None).cast("double") for m in MONTHS[2:]})


def test_monthly_sheet_of_both_directions_and_of_one(spark):
    lines = [
        (1, "87", "RN 21", 500.0, 100.9, None), (2, None, "12 + 300", 0.1, 0.10, None), (3, "87", "RN 21", 600.0, 200.0, 50.0), (4, None, "12+300", 0.2, 0.20, 0.3),
        (5, "16", "A20", 900.0, 10.0, 0.0), (6, None, "7+0", 0.1, 0.05, 0.0),
    ]
    got = {(r.id_comptag, r.mois, r.indicateur): (r.valeur, r.obs) for r in layouts.monthly_sheets(month_lines(spark, lines)).collect()}
    assert got == {
        ("87-N21-12+300", "janv", "tmja"): (300.0, None), ("87-N21-12+300", "janv", "pc_pl"): (15.0, None), ("87-N21-12+300", "fevr", "tmja"): (50.0, None),
        ("16-A20-7+0", "janv", "tmja"): (20.0, "1 seul sens *2"), ("16-A20-7+0", "janv", "pc_pl"): (5.0, None), ("16-A20-7+0", "fevr", "tmja"): (0.0, "1 seul sens *2"),
    }


def loop_sheet(name, lane, loop, days, value="1.0"):
    hours = [f"{h}-{h + 1}h" for h in range(24)]
    lines = [(name, 0, [lane, loop]), (name, 4, ["jour", "type", *hours])]
    at = 5
    for day in days:
        for k, kind in enumerate(("TV", "PL")):
            lines.append((name, at, [None if k else day, kind, *([value] * 24)]))
            at += 1
    return [*lines, (name, at, [None]), (name, at + 1, ["Moyenne Jours", "TV", *(["9.0"] * 24)]), (name, at + 2, ["2021-01-01", "TV", *(["9.0"] * 24)])]


def test_hourly_sheets(spark):
    days = ["2021-03-01", "2021-03-02"]
    lines = loop_sheet("a", "Voie 1", "L1", days) + loop_sheet("b", "Voie_2", "?", days) + loop_sheet("c", "Voie 9", "?", days) + loop_sheet("d", "Voie 1", "L1", days, "0.0") + loop_sheet("e", "Voie 1", "L1", days, "")
    known = spark.createDataFrame([("L1", None, "C1"), (None, "Voie 2", "C2")], "cle1 string, cle2 string, id_comptag string")
    out = layouts.hourly_sheets(spark.createDataFrame(lines, "feuille string, ligne int, cells array<string>"), known)
    rows = sorted((r.feuille, r.id_comptag, r.jour.isoformat(), r.indicateur, r.h0_1, r.h23_24) for r in out["horaire"].collect())
    assert rows == sorted((f, c, j, i, 1.0, 1.0) for f, c in (("a", "C1"), ("b", "C2")) for j in days for i in ("TV", "PL"))
    bad = "trop de nuls ou de zeros"
    assert sorted(map(tuple, out["rejets"].collect())) == [("c", "boucle inconnue"), ("d", bad), ("e", bad)]


POINT = "id int, zone string, type string, x double, y double, annee int, debut date, tmja int, pc_pl double, voie string"


def test_zones(spark):
    day = dt.date(2020, 1, 1)
    point = lambda k, zone, kind, x, year, tmja, share=2.0, street="Rue": (k, zone, kind, x, 0.0, year, day, tmja, share, street)
    rows = [
        point(1, "double", "Double", 1.0, 2016, 90), point(2, "double", "Double", 1.0, 2016, 100, 3.0), point(3, "double", "Simple", 5.0, 2016, 999),
        *[point(10 + y, "paire", "Simple", 2.0, 2015 + y, 10, 1.0) for y in range(6)], *[point(20 + y, "paire", "Simple", 4.0, 2015 + y, 20, 2.0) for y in range(6)],
        point(30, "paire", "Detecteur", 9.0, 2015, 500), point(40, "trois", "Simple", 1.0, 2015, 1), point(41, "trois", "Simple", 2.0, 2015, 1), point(42, "trois", "Simple", 3.0, 2015, 1),
        point(50, "vieux", "Detecteur", 7.0, 2003, 5, street=None), point(51, "vieux", "Detecteur", 7.0, 2008, 8, street=None),
        point(60, "deux", "Detecteur", 1.0, 2015, 1), point(61, "deux", "Detecteur", 2.0, 2015, 1),
    ]
    out = layouts.zones_by_year(spark.createDataFrame(rows, POINT)).collect()
    got = sorted((r.zone, r.cas, r.fictif, r.x, r.type_poste, r.periode, r.annee, r.tmja, r.pc_pl) for r in out)
    assert got == sorted([
        ("double", "double", False, 1.0, "ponctuel", "2016", 2016, 100, 3.0), ("vieux", "detecteur", False, 7.0, "ponctuel", "autr", 2008, 8, 2.0),
        *[("paire", "mixte 2", True, 3.0, "permanent", str(2015 + y), 2015 + y, 30, 1.5) for y in range(6)],
    ])
    assert {r.id_comptag for r in out} == {"LimMet-rue-1.000;0.000", "LimMet-rue-3.000;0.000", "LimMet-??-7.000;0.000"}
    assert layouts.zones_by_year(spark.createDataFrame([], POINT)).collect() == []


def test_points_are_classified_twice(spark):
    new = spark.createDataFrame([("A", 1.0, 1.0), ("B", 50.0, 2.0), ("M", 90.0, 900.0), ("F", 500.0, 500.0)], "id_comptag string, x double, y double")
    stored = spark.createDataFrame([("A", 5.0, 0.0), ("S", 9.0, 99.0), ("T", 60.0, 100.0)], "id_comptag string, x double, y double")
    mapping = spark.createDataFrame([("M", "S")], "id_gest string, id_gti string")
    segments = spark.createDataFrame([(1, 0.0, 0.0, 100.0, 0.0), (2, 0.0, 100.0, 100.0, 100.0)], "gid int, x0 double, y0 double, x1 double, y1 double")
    out = chains.classify(new, stored, mapping, segments, 10.0)
    assert [tuple(r) for r in out["correspondances"].collect()] == [("B", "A")]
    # A is known, M by the stored mapping, B by that of its segment; F is far from every road
    assert sorted((r.id_comptag, r.connu) for r in out["comptages"].collect()) == [("A", True), ("A", True), ("F", False), ("S", True)]


def test_map_table(spark):
    gone = "Donnees Non Disponibles"
    rows = [
        ("C1", "t", "t", "s", 100, 2.0, None), ("C1", "t", "t", "s", 50, 4.0, "x"), ("C2", "t", None, "s", 1, 1.0, None), ("C3", "t", "t", "s", None, 1.0, "x"),
        ("C4", "t", "t", "s", None, 1.0, gone), ("C4", "t", "t", "s", 5, 1.0, None), ("C5", "f", None, None, 5, 1.0, None), ("C6", "t", "t", "s", 5, 1.0, gone),
    ]
    sheet = spark.createDataFrame(rows, "id_comptag string, carto string, diffusable string, src string, tmja int, pc_pl double, obs string")
    counts = spark.createDataFrame([("C1", 2020), ("C4", 2019)], "id_comptag string, annee int")
    out = chains.map_table(sheet, counts, 2020, "carte.ods")
    assert sorted(map(tuple, out["ecarts"].collect())) == [("C2", "carto, diffusable et src", 1), ("C3", "mention", 1), ("C6", "mention", 1)]
    got = sorted((r.id_comptag, r.tmja, r.pc_pl, r.action) for r in out["comptages"].collect())
    assert got == [("C1", 150, 3.0, "update"), ("C4", None, None, "insert")]


def test_files_of_a_city(spark):
    at = lambda day, h: dt.datetime(2021, 3, day, h)
    rows = [("n.csv", at(1, 8), "VL"), ("n.csv", at(2, 8), "PL"), ("s.csv", at(1, 8), "VL"), ("s.csv", at(1, 9), "PL"), ("other.csv", at(1, 9), "PL")]
    files = spark.createDataFrame([("n.csv", "V", "1"), ("s.csv", "V", "2")], "fichier string, id_comptag string, sens string")
    out = chains.city_files(spark.createDataFrame(rows, "fichier string, date_heure timestamp_ntz, type_veh string"), files)
    got = sorted((r.jour.day, r.indicateur, r.h8_9, r.h9_10) for r in out["horaire"].collect())
    assert got == [(1, "PL", 0, 1), (1, "TV", 2, 1), (2, "PL", 1, 0), (2, "TV", 1, 0)]
    (r,) = out["agrege"].collect()
    assert (r.nb_sens, r.annee, r.periode, r.fichier) == (2, 2021, "2021/03/01-2021/03/02", "n.csv")
