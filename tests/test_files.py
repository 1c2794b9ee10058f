"""Written deliveries: all rows are in them, and a file is bounded by time or by a range of ids."""

import datetime as dt
import glob
import json

import pytest
from pyspark.sql import functions as F

from roadtally import standins as S
from roadtally.queries import QUERIES, SQL, files
from roadtally.sources import readers as rd

from .oracle import DATA, spark_rows, sql_rows

SF = f"{DATA}/sf0.001"


def paths(monkeypatch, tmp_path, spark, name):
    monkeypatch.setattr(files, "fresh_path", lambda spark, kind: f"{tmp_path}/{kind}")
    QUERIES[name](spark, SF)
    return {f.rsplit("/", 1)[0] for f in glob.glob(f"{tmp_path}/**/part-*", recursive=True)}


def test_fim_files_have_every_day(spark, tmp_path):
    files.fim_files(spark, SF, f"{tmp_path}/fim")
    h = S.horaire(spark, SF)
    blocks = h.select("id_comptag", "sens", "indicateur", F.trunc("jour", "month").alias("m")).distinct()
    got = rd.fim_blocks(spark, f"{tmp_path}/fim").agg(F.count("*"), F.sum("nb_veh")).first()
    assert tuple(got) == (blocks.agg(F.sum(F.dayofmonth(F.last_day("m")))).first()[0], h.agg(F.sum("valeur")).first()[0])
    assert len(glob.glob(f"{tmp_path}/fim/*/*/part-*")) == blocks.select("id_comptag", "m").distinct().count()
    assert rd.fim_uneven(spark, f"{tmp_path}/fim").isEmpty()


FIM = """17. 0016. 0103. 00.  1. 21. 03. 15. 00. 00. 60.   {a}   +46.1234.5678.-000.6123.4567.
   12.     .    3.    4.    5.    6.    7.    8.    9.   10.   11.    2.
    1.    2.

17. 0016. 0103. 00.  2. 21. 03. 15. 00. 00. 60.   {b}   SUITE
   22.   23.   24.   25.   26.   27.   28.   29.   30.   31.   32.   33.
   34.   35.
"""
CASES = [("1.T", "3.P", "TV PL", "mode3"), ("2.V", "2.P", "VL PL", "mode4"), ("4.T", "4.T", "TV TV", "mode4"), ("2.", "2.", "TV TV", "mode2"), ("1.", "1.", "TV TV", "mode1"), ("5.", "5.", "VELO VELO", "mode5"), ("4.", "4.", "VL PL", "mode4"), ("QT.S0", "QL.S0", "TV PL", "mode3"), ("QT.S0", "LC.S0", "TV PL", "mode3")]


@pytest.mark.parametrize("a, b, kinds, mode", CASES)
def test_fim_modes(spark, tmp_path, a, b, kinds, mode):
    """Each code, the repairs of those that don't tell the vehicles, empty values, and the position of the first title."""
    (tmp_path / "x.fim").write_text(FIM.format(a=a, b=b))
    rows = sorted(rd.fim_blocks(spark, str(tmp_path)).collect(), key=lambda r: (r["sens"], r["date_heure"]))
    assert len(rows) == 28 and {r["mode"] for r in rows} == {mode}
    assert [r["nb_veh"] for r in rows[:14]] == [12, 0, 3, 4, 5, 6, 7, 8, 9, 10, 11, 2, 1, 2]
    assert [rows[0]["type_veh"], rows[14]["type_veh"]] == kinds.split() and [rows[0]["sens"], rows[14]["sens"]] == ["sens1", "sens2"]
    assert rows[13]["date_heure"] == dt.datetime(2021, 3, 15, 13) and rows[14]["date_heure"] == dt.datetime(2021, 3, 15)
    assert (rows[0]["lat"], rows[0]["lon"]) == (46.12345678, -0.61234567)


def test_fim_uneven_blocks(spark, tmp_path):
    (tmp_path / "x.fim").write_text(FIM.format(a="1.T", b="3.P") + "   1.    2.\n")
    assert [tuple(r)[1:] for r in rd.fim_uneven(spark, str(tmp_path)).collect()] == [(2, 3)]


def test_tube_file(spark, tmp_path):
    """Latin-1, NUL between fields, rows one field to the right of the header; broken rows go."""
    names = [*rd.TUBE.values(), ""]
    lines = [names, ["", "1", "27/05/2019 08:15", "7", "50", "12", "0", "48.5"], ["", "0", "27/05/2019 08:16", "1", "0", "1", "1", "50"], ["", "1", "27/05/2019 23:59", "59", "5", "13", "1", "30"]]
    (tmp_path / "t.txt").write_bytes("\r\n".join("\0".join(x) for x in lines).encode("latin-1"))
    got = [tuple(r) for r in rd.vehicle_tube(spark, str(tmp_path)).orderBy("date_heure").collect()]
    assert got == [(dt.datetime(2019, 5, 27, 8, 15, 7, 500000), 1, "VL", "sens1", 48.5), (dt.datetime(2019, 5, 27, 23, 59, 59, 50000), 1, "2R", "sens2", 30.0)]


def test_radar_file(spark, tmp_path):
    """The start stands in the sixth to eighth field of the head; a day that falls back is of the next month."""
    (tmp_path / "r.txt").write_text("A.B.C.D.E. 19. 12. 30.F\n1 30 0815 0750 V=48 3 vl\n2 31 2359 5999 V=130 4 pl\n1 01 0000 0000 V=7 5 2r\n")
    got = [tuple(r)[1:] for r in rd.vehicle_radar(spark, str(tmp_path)).orderBy("date_heure").collect()]
    assert got == [
        (dt.datetime(2019, 12, 30, 8, 15, 7, 500000), 1, 48, 3, "VL", "sens1"), (dt.datetime(2019, 12, 31, 23, 59, 59, 990000), 1, 130, 4, "PL", "sens2"), (dt.datetime(2020, 1, 1), 1, 7, 5, "2R", "sens1"),
    ]


def test_skipped_rows(spark, tmp_path):
    (tmp_path / "d.csv").write_text("titre;\n;\nid;nom\n1;été\n2;\n")
    got = rd.delimited(spark, str(tmp_path), schema="id int, nom string", skip_rows=2).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, "ete"), (2, None)]


def test_radar_files_are_of_a_week(spark, monkeypatch, tmp_path):
    weeks = S.passages(spark, SF).select("id_comptag", F.date_trunc("week", F.date_add(F.to_date("date_heure"), 20))).distinct().count()
    assert len(paths(monkeypatch, tmp_path, spark, "src_vehicle_radar")) == weeks > 10


def test_iris_files_are_of_a_year(spark, monkeypatch, tmp_path):
    assert len(paths(monkeypatch, tmp_path, spark, "src_iris_hourly")) == S.hw(spark, SF).select("indicateur", "id_comptag", "sens", "annee").distinct().count()


def test_geojson_collections_are_bounded(spark, monkeypatch, tmp_path):
    """2,500 suppliers of one nation are three collections."""
    spark.range(2500).select(F.col("id").alias("s_suppkey"), F.lit("n").alias("s_name"), F.lit(1).alias("s_nationkey")).write.parquet(f"{tmp_path}/d/supplier.parquet")
    monkeypatch.setattr(files, "fresh_path", lambda spark, kind: f"{tmp_path}/{kind}")
    assert QUERIES["src_geojson"](spark, f"{tmp_path}/d").count() == 2500
    assert len(spark.read.text(f"{tmp_path}/geojson").collect()) == 3


@pytest.fixture
def pieces(spark):
    """Files are cut every so many bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum") if spark.conf.get(k, None)}

    def cut(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", str(size))

    yield cut
    for k, v in old.items():
        spark.conf.set(k, v)


def written(tmp_path, name, lines, encoding="utf-8"):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes("".join(x + ("\r\n" if k % 2 else "\n") for k, x in enumerate(lines)).encode(encoding))
    return f"file://{tmp_path}"


def device(kind, days=200):
    """Lines of a device's file that spans many pieces."""
    if kind == "tube":
        head = "\t".join([*rd.TUBE.values(), ""])
        return [head, *("\t".join(["", "1", f"{1 + k % 28:02d}/03/2021 {k % 24:02d}:{k % 60:02d}", str(k % 60), str(k % 100), str(k % 14), str(k % 2), str(k % 90)]) for k in range(20 * days))]
    if kind == "radar":
        when = [dt.date(2021, 1, 20) + dt.timedelta(days=k) for k in range(days)]
        return ["RADAR.1.2.3.4. 21. 01. 20.0", *(f"1 {d:%d} {h:02d}15 3000 V={h + 30} {h} vl" for d in when for h in range(0, 24, 2))]
    if kind == "fim":
        out = []
        for block in range(6):
            out.append(f"17. 0016. 0103. 00. {block % 2 + 1}. 21. 03. 01. 00. 00. 60.   4.{'VP'[block // 2 % 2]}   +46.1234.5678.-0.6123.4567.")
            out += ["".join(f"{(k * 12 + c + block) % 500:5d}." for c in range(12)) for k in range(days)]
        return out
    pad = lambda n, last: ";" * n + last
    head = [{2: pad(22, "Sens n°1"), 4: pad(16, "7"), 5: pad(16, "3+10")}.get(k, f"ligne {k}" + ";" * 24) for k in range(rd.IRIS_HEAD)]
    rows = [f"mesuré;{dt.date(2021, 1, 1) + dt.timedelta(days=k):%d/%m/%Y};" + ";".join(str(k % 100 + h) for h in range(24)) for k in range(days)]
    return [*head, ";".join(["Etat", "Jours", *(f"H{k}" for k in range(1, 25))]), *rows, *(f"Moyenne {k}" + ";" * 24 for k in range(rd.IRIS_FOOT)), ""]


READERS = {"tube": rd.vehicle_tube, "radar": rd.vehicle_radar, "fim": rd.fim_blocks, "iris": rd.iris_hourly}


@pytest.mark.parametrize("kind", READERS)
def test_a_file_in_many_pieces_gives_the_same_rows(spark, tmp_path, pieces, kind):
    lines = device(kind)
    path = written(tmp_path / "data", "TV/a+b c.csv", lines, "latin-1" if kind in ("tube", "iris") else "utf-8")
    rows = lambda: sorted((tuple(r) for r in READERS[kind](spark, path).collect()), key=repr)
    pieces(1 << 30)
    whole = rows()
    assert rd.lines_of(spark, path, "ISO-8859-1").select("piece").distinct().count() == 1
    pieces(997)
    assert rd.lines_of(spark, path, "ISO-8859-1").select("piece").distinct().count() > 8
    assert rows() == whole and len(whole) >= 200
    if kind == "radar":
        assert {r[1].date() for r in whole} == {dt.date(2021, 1, 20) + dt.timedelta(days=k) for k in range(200)}
    if kind == "fim":
        assert len(whole) == 6 * 200 * 12 and max(r[4] for r in whole) == dt.datetime(2021, 3, 1) + dt.timedelta(hours=200 * 12 - 1)
    if kind == "iris":
        assert [r[3] for r in sorted(whole, key=lambda r: r[3])] == [dt.date(2021, 1, 1) + dt.timedelta(days=k) for k in range(200)]


def test_lines_are_numbered_across_pieces(spark, tmp_path, pieces):
    lines = [f"{k}" if k % 7 else "" for k in range(5000)]
    path = written(tmp_path / "data", "x.txt", lines)
    pieces(500)
    assert sorted((r.pos, r.line) for r in rd.lines_of(spark, path).collect()) == [(k, x) for k, x in enumerate(lines) if x]


def test_geojson_of_any_properties_and_geometry(spark, tmp_path):
    """A collection of counts without geometry, as deliveries have it, and lines, polygons, odd values."""
    written(tmp_path / "a", "counts.json", ['{"type": "FeatureCollection", "name": "comptage.compteur", "features": [', '{"type": "Feature", "geometry": null, "properties": {"id_comptag": "17-D1-2+3", "id_uniq": 0, "tmja": 2002, "pc_pl": 5}},', '{"type": "Feature", "geometry": null, "properties": {"id_comptag": "17-D1-2+4", "id_uniq": 1, "tmja": "many", "pc_pl": 5.5}}]}'])
    got = rd.geojson(spark, f"file://{tmp_path}/a", {"id_comptag": "string", "id_uniq": "bigint", "tmja": "int", "pc_pl": "double", "none": "string"}).drop("proprietes")
    assert [tuple(r) for r in got.orderBy("id_uniq").collect()] == [("17-D1-2+3", 0, 2002, 5.0, None, None, None, None, None), ("17-D1-2+4", 1, None, 5.5, None, None, None, None, None)]
    shapes = {"Point": [1.5, 2], "LineString": [[1, 2], [3, 4.5]], "Polygon": [[[0, 0], [4, 0], [4, 4], [0, 0]], [[1, 1], [2, 1], [2, 2], [1, 1]]]}
    written(tmp_path / "b", "shapes.json", [json.dumps({"features": [{"properties": {"k": k, "deep": {"x": [1, {"y": 2}]}}, "geometry": {"type": k, "coordinates": c}} for k, c in shapes.items()]})])
    written(tmp_path / "b", "broken.json", ["{"])
    got = {r.k: r for r in rd.geojson(spark, f"file://{tmp_path}/b", {"k": "string"}).selectExpr("*", "variant_get(proprietes, '$.deep.x[1].y', 'int') AS y").collect()}
    assert {k: (r.type, r.lon, r.lat, len(r.points), r.y) for k, r in got.items()} == {"Point": ("Point", 1.5, 2.0, 1, 2), "LineString": ("LineString", 1.0, 2.0, 2, 2), "Polygon": ("Polygon", 0.0, 0.0, 8, 2)}


def test_names_are_files_in_few_folders(spark, tmp_path, monkeypatch):
    """A file for each supplier; folders hold a thousand, none stands for a single file."""
    monkeypatch.setattr(files, "fresh_path", lambda spark, kind: f"{tmp_path}/{kind}")
    sf = f"{DATA}/sf0.1"
    found = spark_rows(QUERIES["src_files_by_name"](spark, sf))
    written = [f for f in glob.glob(f"{tmp_path}/**", recursive=True) if f.endswith(".txt")]
    assert len(written) == S.table(spark, sf, "supplier").count() and len({f.rpartition("/")[0] for f in written}) == 1
    assert found == sql_rows(SQL["src_files_by_name"], sf)
