"""Lane names, one pass of checks, watched writes, and quantiles by counted values."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadtally import standins as S
from roadtally.operators import checks as ck
from roadtally.operators.quantiles import exact_quantiles
from roadtally.plans import chains
from roadtally.schemas import HOURS
from roadtally.sources.tables import Refused, Table

from .oracle import DATA

WIDE = "id_comptag string, annee int, jour date, indicateur string, sens int, voie string, fichier string, " + ", ".join(f"{h} double" for h in HOURS)


def hourly(spark, rows):
    """rows: counter, day of the month, indicator, lane, value of every hour."""
    import datetime as dt

    return spark.createDataFrame([(c, 2021, dt.date(2021, 3, d), i, k + 1, lane, "f", *([v] * 24)) for k, (c, d, i, lane, v) in enumerate(rows)], WIDE)


@pytest.mark.parametrize("name, main", [("Sens 1", True), ("SENS_2", True), ("sens intér", False), ("Sens Exter", True), ("déport sens 1", True), ("Bretelle", False), ("", False), (None, False)])
def test_main_lanes(spark, name, main):
    df = spark.createDataFrame([(name,)], "voie string")
    assert df.select(ck.main_lane(F.col("voie"))).first()[0] == (main or name == "sens intér")


def test_a_counter_with_an_exit_lane_is_accepted(spark):
    lanes = [("Sens 1", 10.0), ("Sens 2", 12.0), ("Bretelle de sortie", 1.0)]
    df = hourly(spark, [("C1", d, i, lane, v) for d in range(1, 10) for i in ("VL", "PL") for lane, v in lanes])
    (r,) = ck.direction_asymmetry(df, lane="voie").collect()
    assert (r.jours, r.ecarts, r.etat, r.rejete) == (18, 0, "ok", False)
    assert ck.direction_asymmetry(df).first().etat == "cas non prevu"  # by number, the ramp is a third direction
    (v,) = ck.verdicts(ck.day_flags(df, lane="voie")).collect()
    assert (v.invalides, v.jours, v.etat, v.accepte) == (0, 9, "ok", True)


def test_a_day_with_one_main_lane_goes_with_its_ramp(spark):
    df = hourly(spark, [("C1", 1, i, lane, 5.0) for i in ("VL", "PL") for lane in ("Sens 1", "Sortie")] + [("C1", 2, i, lane, 5.0) for i in ("VL", "PL") for lane in ("Sens 1", "Sens 2")])
    assert {r.jour.day for r in ck.two_directions_present(df, lane="voie").collect()} == {2}
    assert {r.jour.day for r in ck.two_directions_present(df).collect()} == {1, 2}


def test_verdicts_are_those_of_the_single_checks(spark):
    wide = S.hw(spark, f"{DATA}/sf0.01")
    kept, removed = ck.invalid_days(wide, 22)
    kept = ck.two_directions_present(kept)
    refused = {r.id_comptag for r in ck.direction_asymmetry(kept).where("rejete").collect()}
    days = {r.id_comptag: r.n for r in kept.groupBy("id_comptag").agg(F.countDistinct("jour").alias("n")).collect()}
    got = {r.id_comptag: r for r in ck.verdicts(ck.day_flags(wide, 22)).collect()}
    assert {c for c, r in got.items() if r.invalides} == {r.id_comptag for r in removed.select("id_comptag").distinct().collect()}
    assert {c: r.jours for c, r in got.items() if r.jours} == days
    assert {c for c, r in got.items() if r.jours and r.etat != "ok"} == refused
    assert {c for c, r in got.items() if r.accepte} == {c for c, n in days.items() if n >= 7} - refused


def test_the_report_reads_the_deliveries_once(spark):
    report = chains.hourly_to_indicators(S.hw(spark, f"{DATA}/sf0.001"), most_zeros=22)["rapport"]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Join" not in plan


def test_rules_are_counted_by_the_job_that_writes(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 5).cast("int").alias("annee"), F.when(F.col("id") != 7, F.col("id")).alias("tmja"))
    t = Table(spark, f"file://{tmp_path}/t")
    rules = {"tmja inconnu": F.col("tmja").isNull(), "tmja > 97": F.col("tmja") > 97, "annee": F.col("annee") < 0}
    with pytest.raises(Refused) as refused:
        t.append(df, batch="d", rules=rules)
    assert refused.value.broken == {"tmja inconnu": 1, "tmja > 97": 2}
    with pytest.raises(FileNotFoundError):
        t.read()
    t.append(df.where("tmja <= 97"), batch="d", rules=rules)
    assert t.read().count() == 97


@pytest.mark.parametrize("seed", [1, 2])
def test_quantiles(spark, seed):
    random.seed(seed)
    shares = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.85, "e": 1.0}
    rows = [(random.choice(["x", "y", None]), random.choice([1, 2]), random.choice([None, *[k / 4 for k in range(-20, 20)]])) for _ in range(3000)]
    rows += [("one", 1, 5.0), ("none", 1, None), ("hot", None, 1.0), *[("hot", None, float(k)) for k in range(2000)]]
    found = exact_quantiles(spark.createDataFrame(rows, "g string, k int, v double").repartition(5), ["g", "k"], "v", shares).collect()
    groups = {}
    for g, k, v in rows:
        groups.setdefault((g, k), []).extend([] if v is None else [v])
    assert len(found) == len(groups)
    for r in found:
        values = groups[r.g, r.k]
        assert [r[n] for n in shares] == (pytest.approx(np.quantile(values, list(shares.values()))) if values else [None] * 5)


def test_quantiles_of_all_rows_and_of_none(spark):
    df = spark.range(101).select(F.col("id").alias("v"))
    assert [tuple(r) for r in exact_quantiles(df, [], "v", {"m": 0.5, "q": 0.25}).collect()] == [(50.0, 25.0)]
    assert exact_quantiles(df.where("v < 0"), [], "v", {"m": 0.5}).collect() == []


def test_a_group_of_many_values_fills_many_ranges(spark):
    """No range holds a large group's distinct values."""
    df = spark.range(20_000).select(F.lit("a").alias("g"), F.hash("id").cast("double").alias("v"))
    counts = df.groupBy("g", "v").count().repartitionByRange(4, "g", "v").groupBy(F.spark_partition_id()).count().collect()
    assert len(counts) == 4 and max(r["count"] for r in counts) < 10_000
