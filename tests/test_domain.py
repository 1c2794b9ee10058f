"""Golden values and properties of the domain operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadtally.functions import scalars as fn
from roadtally.operators import checks as ck
from roadtally.operators import geo, network
from roadtally.operators import hourly as ho
from roadtally.operators import matching as ma
from roadtally.operators import models as mo
from roadtally.operators import reshape as rs
from roadtally.operators import vehicles as ve
from roadtally.operators import windows as wi
from roadtally.schemas import HOURS, MONTHS


def test_annual_against_monthly(spark):
    """Ten counters: 5 % and one point are still good, a little more is not."""
    annual = [(k, t, p) for k, (t, p) in enumerate(zip([2002, 5000, 2002, 5000, 2000, 2000, 2000, 2000, 2000, 2000], [5, 5, 1, 1, 5, 5, 5, 5, 5, 5]))]
    means = [2005.5] * 4 + [2105.0, 1905.0, None, 2000.0, 2106.0, 1904.0]
    shares = [5.0] * 4 + [6.0, 4.0, None, 5.0, 6.0, 4.0]
    monthly = [(k, m, means[k] if k != 6 else 1000.0 * (m + 1), shares[k] if k != 6 else m + 1.0) for k in range(10) for m in range(12)]
    a, m = spark.createDataFrame(annual, "id long, tmja long, pc_pl long"), spark.createDataFrame(monthly, "id long, mois long, tmja double, pc_pl double")
    r = {x["id"]: x for x in ck.annual_vs_monthly(a, m, ["id"]).collect()}
    assert [r[k]["etat_tmja"] for k in (0, 1, 4, 5, 8, 9)] == ["OK", "KO", "OK", "OK", "KO", "KO"]
    assert [r[k]["etat_pc_pl"] for k in (0, 2, 4, 5)] == ["OK", "KO", "OK", "OK"]
    assert round(r[6]["ecart_tmja"], 2) == 69.23 and round(r[6]["pc_pl_mensuel"], 2) == 8.33 and round(r[6]["ecart_pc_pl"], 2) == 3.33


def test_flags_and_remark(spark):
    good = spark.createDataFrame([("t", "carto_2020", "t"), ("f", None, "f")], "carto string, src string, diff string")
    bad = spark.createDataFrame([("t", None, "t")], good.schema)
    flags = lambda df: ck.flags_concordant(df, F.col("carto") == "t", F.col("src").isNotNull(), F.col("diff") == "t")
    assert flags(good).isEmpty() and not flags(bad).isEmpty()


@pytest.mark.parametrize("text, good", [("2019/01/02-2019/01/09", True), ("2019/01/02-2019/01/09 ; 2019/02/02-2019/02/09", True), ("2019/1/2-2019/01/09", False), ("2019-01-02/2019-01-09", False), ("2019/13/02-2019/01/09", False), ("2019/01/32-2019/01/09", False), ("", False), (None, False)])
def test_period(spark, text, good):
    df = spark.createDataFrame([(text,)], "p string")
    assert df.select(fn.period_valid(F.col("p"))).first()[0] is good


def test_months(spark):
    names = ["Janvier", "Février", "Mars", "Avril", "Mai", "Juin", "Juillet", "Août", "Septembre", "Octobre", "Novembre", "Décembre"]
    df = spark.createDataFrame([(n,) for n in names], "m string")
    assert [r[0] for r in df.select(fn.month_key(F.col("m"))).collect()] == MONTHS


def test_required_columns(spark):
    with pytest.raises(ck.CheckFailed):
        ck.require_columns(spark.range(1), ["id", "absent"])


@pytest.fixture
def passages(spark):
    start = dt.datetime(2019, 5, 27)
    data = [(k, "C1", f"sens{1 + k % 2}", start + dt.timedelta(minutes=58 * k), ["VL", "PL", "2R"][k % 3], 30.0 + k % 60, 1) for k in range(200)]
    return spark.createDataFrame(data, "event_id long, id_comptag string, sens string, date_heure timestamp_ntz, type_veh string, vitesse double, nb_veh int")


def test_zero_filled_counts(passages):
    n = ve.hourly_counts(passages)
    steps = int(199 * 58 / 60) + 1
    assert n.count() == steps * 2 * 4
    assert n.where("type_veh <> 'TV'").agg(F.sum("nb_veh")).first()[0] == 200 == n.where("type_veh = 'TV'").agg(F.sum("nb_veh")).first()[0]


def test_sum_of_directions_is_the_total(passages):
    week = ve.average_week(passages)
    c = ve.direction_compare(week).agg(F.sum(F.col("sens1") + F.col("sens2"))).first()[0]
    assert abs(c - week.agg(F.sum("nb_veh")).first()[0]) < 1e-9


def test_end_days(spark):
    def merged(days, first_hour, last_hour):
        at = [dt.datetime(2019, 5, 1 + k, 12) for k in range(1, days - 1)] + [dt.datetime(2019, 5, 1, first_hour), dt.datetime(2019, 5, days, last_hour)]
        df = spark.createDataFrame([("C", a) for a in at], "id_comptag string, date_heure timestamp_ntz")
        return sorted(r[0] for r in ve.time_merge(df).select("date_heure").collect())

    assert len(merged(10, 8, 18)) == 8  # both ends go
    assert merged(8, 18, 8)[-1] == dt.datetime(2019, 5, 8, 18)  # the first day moves to the last
    assert min(merged(8, 8, 18)).day == 1 and len({x.date() for x in merged(8, 8, 18)}) == 7  # the last day moves to the first


def test_unpivot_undoes_pivot(spark):
    long = spark.createDataFrame([("C", d, h, float(h * d)) for d in range(3) for h in range(24)], "id_comptag string, jour int, heure int, valeur double")
    wide = long.groupBy("id_comptag", "jour").agg(*[F.sum(F.when(F.col("heure") == h, F.col("valeur"))).alias(c) for h, c in enumerate(HOURS)])
    back = ho.unpivot_hours(wide, ["id_comptag", "jour"])
    assert back.exceptAll(long).isEmpty() and long.exceptAll(back.select(*long.columns)).isEmpty()


def test_decision_covers_every_case(spark):
    kinds = ["permanent", "tournant", "ponctuel"]
    data = [(t, s, a, b, h, y) for t in (True, False) for s in ("X", None) for a in kinds for b in kinds for h in (True, False) for y in (True, False)]
    df = spark.createDataFrame(data, "t boolean, s string, a string, b string, h boolean, y boolean")
    out = df.withColumn("c", ma.decision(*map(F.col, "tsabhy"))).collect()
    assert {r["c"] for r in out} == {ma.MAPPING, ma.ASSOCIATE, ma.DEMOTE, ma.NEW}
    assert all(r["c"] == ma.NEW for r in out if r["s"] is None)
    assert all(r["c"] == ma.MAPPING for r in out if r["s"] and r["t"] and r["a"] == r["b"])
    assert all(r["c"] == ma.ASSOCIATE for r in out if r["s"] and not r["t"] and r["a"] == r["b"] == "ponctuel" and r["h"])


def test_lambert93(spark):
    p = spark.createDataFrame([(3.0, 46.5), (2.3241667, 48.8033333)], "lon double, lat double").select(geo.to_lambert93(F.col("lon"), F.col("lat")).alias("p")).collect()
    assert abs(p[0][0]["x"] - 700000) < 1e-6 and abs(p[0][0]["y"] - 6600000) < 1e-6
    assert abs(p[1][0]["x"] - 650400) < 300 and abs(p[1][0]["y"] - 6856000) < 1500


def test_lambert93_constants():
    """The published exponent, constant and pole of the projection."""
    assert abs(geo.N - 0.7256077650) < 1e-10 and abs(geo.SCALE - 11754255.426) < 1e-3 and abs(geo.Y0 + geo.R0 - 12655612.050) < 1e-3


def test_nearest_is_brute_force(spark):
    import random

    random.seed(3)
    pts = [(f"P{k}", random.uniform(0, 500), random.uniform(0, 500)) for k in range(200)]
    seg = [(k, random.uniform(0, 500), random.uniform(0, 500), random.uniform(0, 500), random.uniform(0, 500)) for k in range(40)]
    got = {r["id_comptag"]: (r["gid"], r["distance"]) for r in geo.nearest(spark.createDataFrame(pts, "id_comptag string, x double, y double"), spark.createDataFrame(seg, "gid int, x0 double, y0 double, x1 double, y1 double"), 15.0, cell=40.0).collect()}

    def dist(x, y, a, b, c, d):
        t = max(0, min(1, ((x - a) * (c - a) + (y - b) * (d - b)) / ((c - a) ** 2 + (d - b) ** 2)))
        return ((x - a - t * (c - a)) ** 2 + (y - b - t * (d - b)) ** 2) ** 0.5

    want = {}
    for i, x, y in pts:
        best = min((dist(x, y, *s[1:]), s[0]) for s in seg)
        if best[0] <= 15:
            want[i] = best[1]
    assert {k: v[0] for k, v in got.items()} == want


def test_pairs_within(spark):
    pts = spark.createDataFrame([("a", 0.0, 0.0), ("b", 9.0, 0.0)], "id string, x double, y double")
    others = spark.createDataFrame([("c", 0.0, 9.5), ("d", -3.0, 0.0)], "o string, ox double, oy double")
    assert {(r["id"], r["o"]) for r in geo.pairs_within(pts, others, 10.0).collect()} == {("a", "c"), ("a", "d")}


def test_chain_of_edges(spark):
    n = 300
    e = spark.createDataFrame([(k, k, k + 1, "D1", 1.0) for k in range(n)], "id long, source long, target long, route string, longueur double")
    assert {r["segment"] for r in network.base_segments(e).collect()} == {0}


def test_rank_goes_on(spark):
    new = spark.createDataFrame([("A", 1), ("A", 2), ("B", 3)], "ref string, id int")
    stored = spark.createDataFrame([("A", 4)], "ref string, rang int")
    assert {(r["ref"], r["id"], r["rang"]) for r in wi.rank_in_reference(new, stored, "ref", F.col("id")).collect()} == {("A", 1, 5), ("A", 2, 6), ("B", 3, 1)}


def test_union_fills_missing_columns(spark):
    u = rs.union_tables(spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2, "x")], "a int, b string"))
    assert {tuple(r) for r in u.collect()} == {(1, None), (2, "x")}


def test_calibration_finds_the_curve(spark):
    df = spark.range(4000).select((F.col("id") * 5.0).alias("raw")).withColumn("z", F.col("raw") / mo.LIMIT)
    df = df.withColumn("true", F.when(F.col("raw") < mo.LIMIT, 1 + 2 * F.col("z") + F.pow("z", F.lit(4.0))).otherwise(3 * F.col("z")))
    m = mo.fit(df, "raw", "true")
    assert [round(c, 6) for c in m["bas"]] == [1, 2, 0, 0, 1] and [round(c, 6) for c in m["haut"]] == [0, 3]


@pytest.mark.parametrize(
    "broken, directions, named, note",
    [(0, 1, True, 3), (1, 2, True, 3), (2, 2, True, 2), (3, 2, True, 1), (0, 2, False, 2), (2, 1, False, 2), (3, 1, False, 1), (0, 3, True, 1), (0, 0, True, 1)],
)
def test_quality_note(spark, broken, directions, named, note):
    """Ten rows: 10 % broken is still good, 20 % is middling, 30 % is bad; no direction or three are bad whatever the names."""
    rows = [("f", ["longueur"] if k < broken else [], k % directions if directions else None, "voie" if named or not directions or k % directions else None) for k in range(10)]
    df = spark.createDataFrame(rows, "file string, fail array<string>, sens int, voie string")
    got = ck.vehicle_quality_note(df, "file", F.col("sens"), F.col("voie")).first()
    assert got["qualite"] == note and got["commentaire"].count(" ; ") == 1 and got["commentaire"].split(" ; ")[1].startswith("1 ou 2" if directions in (1, 2) else "0 ou plus")


def sheets(spark, bad):
    """Ten days of one sheet; ``bad`` says what each day is: a null hour, or hours at zero."""
    rows = [("C1", 1, "TV", k, *[None if bad[k] == "null" and h == 3 else 0.0 if bad[k] == "zero" and h < 9 else 5.0 for h in range(24)]) for k in range(10)]
    return spark.createDataFrame(rows, "id_comptag string, sens int, indicateur string, jour int, " + ", ".join(f"{h} double" for h in HOURS))


@pytest.mark.parametrize("nulls, zeros, kept", [(3, 3, 10), (5, 5, 10), (6, 0, 0), (0, 6, 0)])
def test_sheets_count_nulls_and_zeros_apart(spark, nulls, zeros, kept):
    bad = ["null"] * nulls + ["zero"] * zeros + ["good"] * (10 - nulls - zeros)
    assert ck.invalid_sheets(sheets(spark, bad)).count() == kept


def hours(*totals):
    return tuple([float(totals[0])] + [0.0] * 23)


@pytest.mark.parametrize(
    "declared, sens, ratio, state, rejected",
    [("double sens", (1, 2), 2, "ok", False), ("double sens", (1, 2), 4, "asymetrique", True), ("sens unique", (1, 2), 2, "sens unique a deux sens", True), ("sens unique", (1,), 2, "ok", False), ("double sens", (1,), 2, "double sens a un seul sens", True), ("double sens", (1, 2, 3), 2, "cas non prevu", True)],
)
def test_declared_directions(spark, declared, sens, ratio, state, rejected):
    rows = [("C1", d, "TV", s, declared, *hours(10 if s == 1 else 10 * ratio)) for d in range(10) for s in sens]
    df = spark.createDataFrame(rows, "id_comptag string, jour int, indicateur string, sens int, circu string, " + ", ".join(f"{h} double" for h in HOURS))
    got = ck.direction_asymmetry(df, declared=F.col("circu")).first()
    assert (got["etat"], got["rejete"]) == (state, rejected)


def test_one_day_in_ten_may_be_asymmetric(spark):
    rows = [("C1", d, "TV", s, *hours(10 if s == 1 else 40 if d < 1 else 10)) for d in range(10) for s in (1, 2)]
    df = spark.createDataFrame(rows, "id_comptag string, jour int, indicateur string, sens int, " + ", ".join(f"{h} double" for h in HOURS))
    assert ck.direction_asymmetry(df).first()["etat"] == "ok"


def test_monthly_rows_by_their_number(spark):
    """Four rows: both directions lose the month; two: the missing one is marked; three: left alone."""
    both = [("C4", 2020, s, i, m, None if (s, i, m) == (1, "tmja", 1) else 5.0) for s in (1, 2) for i in ("tmja", "pc_pl") for m in (1, 2)]
    two = [("C2", 2020, 1, i, m, None if (i, m) == ("tmja", 1) else 5.0) for i in ("tmja", "pc_pl") for m in (1, 2)]
    three = [("C3", 2020, s, i, 1, None if i == "tmja" else 5.0) for s, i in ((1, "tmja"), (1, "pc_pl"), (2, "tmja"))]
    df = spark.createDataFrame(both + two + three, "id_comptag string, annee int, sens int, indicateur string, mois int, valeur double")
    got = {(r["id_comptag"], r["sens"], r["indicateur"], r["mois"]): (r["valeur"], r["cas"]) for r in ck.monthly_pairs(df).collect()}
    assert [k for k, v in got.items() if v[0] == -99 and k[0] == "C4"].__len__() == 2 and got["C4", 2, "tmja", 1] == (-99, "deux sens") and got["C4", 2, "tmja", 2][0] == 5
    assert got["C2", 1, "tmja", 1] == (-99, "un sens") and got["C2", 1, "pc_pl", 1][0] == 5
    assert got["C3", 1, "tmja", 1] == (None, "non prevu") and got["C3", 1, "pc_pl", 1] == (5, "non prevu")


def test_years(spark):
    df = spark.createDataFrame([(y,) for y in (1900, 1999, 2000, 2001, 2020, 2999)], "annee int")
    assert sorted(r[0] for r in ck.years_outside(df).collect()) == [1999, 2000, 2999]


def test_fold_drops_up_to_the_last_clock_time(spark):
    """Eight days: on the first one, a vehicle at exactly the last clock time goes, one a second later stays."""
    day = dt.datetime(2021, 3, 1)
    at = [day + dt.timedelta(hours=8), day + dt.timedelta(hours=10), day + dt.timedelta(hours=10, seconds=1), *[day + dt.timedelta(days=k, hours=9) for k in range(1, 7)], day + dt.timedelta(days=7, hours=10)]
    df = spark.createDataFrame([("C1", t) for t in at], "id_comptag string, date_heure timestamp_ntz")
    assert sorted(r["date_heure"] for r in ve.time_merge(df).collect()) == [day + dt.timedelta(hours=10), day + dt.timedelta(hours=10, seconds=1), *at[3:9]]


@pytest.mark.parametrize("days, enough, full", [(9, True, None), (8, True, None), (7, False, 6), (5, False, 5)])
def test_full_days(spark, days, enough, full):
    df = spark.createDataFrame([("C1", dt.datetime(2021, 3, 1 + k, 8)) for k in range(days)], "id_comptag string, date_heure timestamp_ntz")
    got = ck.enough_days(df).first()
    assert (got["suffisant"], got["jours_pleins"], got["qualite"]) == (enough, full, None if enough else 1)


def test_lane_names_are_normalised(spark):
    from roadtally.operators import joins as jo

    sheet = spark.createDataFrame([("Voie Été-1", 5), ("Voie Été-1", 5)], "cle string, janv int")
    lanes = spark.createDataFrame([("voieete1", "L1")], "cle string, voie string")
    assert [tuple(r) for r in jo.lane_monthly(sheet, lanes, ["janv"]).collect()] == [("voieete1", 5, "L1")]


def test_calibration_is_measured_on_other_rows(spark):
    df = spark.range(2000).select(F.col("id"), (F.col("id") * 10.0).alias("raw")).withColumn("true", F.col("raw") / 5000 + 1).withColumn("fail", F.array().cast("array<string>"))
    learning, test = mo.split(df, "id")
    assert learning.count() + test.count() == 2000 and 300 < test.count() < 500
    got = {r["partie"]: r for r in mo.fit_quality(mo.apply(test, "raw", mo.fit(learning, "raw", "true"), "p"), "raw", "true", "p").collect()}
    assert all(got[k]["rmse"] < 1e-6 and got[k]["r2"] > 0.999999 for k in ("bas", "haut"))


def test_labels_are_carried_both_ways(spark):
    """Nulls in the order come first; no frame reaches to the end of a group, which Spark goes through again for every row."""
    rows = [("a", 1, None, None), ("a", 2, "x", 7), ("a", 3, None, None), ("a", 4, None, 9), ("a", None, None, 5), ("b", 1, None, None), ("b", 2, "y", None)]
    df = spark.createDataFrame(rows, "k string, n int, s string, v int")
    full = wi.fill_back(wi.fill_forward(df, ["k"], "n", "s"), ["k"], "n", "v")
    assert {(r["k"], r["n"]): (r["s"], r["v"]) for r in full.collect()} == {
        ("a", None): (None, 5), ("a", 1): (None, 7), ("a", 2): ("x", 7), ("a", 3): ("x", 9), ("a", 4): ("x", 9), ("b", 1): (None, None), ("b", 2): ("y", None)
    }
    assert "unboundedfollowing" not in full._jdf.queryExecution().toString().lower()
