"""Indicators from individual vehicles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import speed_bin
from ..schemas import DAYS
from .quantiles import exact_quantiles

KINDS, SIDES = ["VL", "PL", "2R"], ["sens1", "sens2"]
STEP_SECONDS = {"1 hour": 3600, "6 minutes": 360, "1 day": 86400}


def half_even(c: Column, digits: int = 0) -> Column:
    """Half-even rounding of a sum, first freed of what the order of adding leaves in the last bits."""
    return F.bround(F.round(c, 9), digits)


def step_of(ts: Column, step: str) -> Column:
    if step == "1 hour":
        return F.date_trunc("hour", ts).cast("timestamp_ntz")
    return F.window(ts, step)["start"].cast("timestamp_ntz")


def hourly_counts(p: DataFrame, step: str = "1 hour", id_col: str = "id_comptag") -> DataFrame:
    """Vehicles by step, vehicle and direction, zero-filled over each counter's own span, with TV rows.

    A direction in which a counter saw nothing at all is left out.
    """
    n = p.groupBy(id_col, "sens", "type_veh", step_of(F.col("date_heure"), step).alias("pas")).agg(F.count("*").alias("nb_veh"))
    ends = p.groupBy(id_col).agg(F.min("date_heure").alias("a"), F.max("date_heure").alias("b"), F.collect_set("sens").alias("sides"))
    sides = F.filter(F.array(*[F.lit(s) for s in SIDES]), lambda s: F.array_contains("sides", s))
    steps = F.sequence(step_of(F.col("a"), "1 hour"), step_of(F.col("b"), "1 hour"), F.expr(f"INTERVAL {step}"))
    grid = ends.select(id_col, F.explode(sides).alias("sens"), steps.alias("steps")).select(id_col, "sens", F.explode("steps").alias("pas"))
    grid = grid.withColumn("type_veh", F.explode(F.array(*[F.lit(k) for k in KINDS])))
    full = grid.join(n, [id_col, "sens", "type_veh", "pas"], "left").withColumn("nb_veh", F.coalesce("nb_veh", F.lit(0)))
    tv = full.groupBy(id_col, "sens", "pas").agg(F.sum("nb_veh").alias("nb_veh")).withColumn("type_veh", F.lit("TV"))
    return full.unionByName(tv)


def steps_pivot(p: DataFrame, step: str = "6 minutes") -> DataFrame:
    n = p.groupBy("id_comptag", "sens", step_of(F.col("date_heure"), step).alias("pas")).pivot("type_veh", KINDS).count()
    return n.fillna(0, KINDS)


def speed_percentiles(p: DataFrame) -> DataFrame:
    """v10, v50 and v85 by hour and direction, of each vehicle type and of all (TV); linear interpolation."""
    q = F.percentile("vitesse", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.85)))
    h = p.withColumn("pas", step_of(F.col("date_heure"), "1 hour"))
    g = h.groupingSets([["id_comptag", "sens", "pas", "type_veh"], ["id_comptag", "sens", "pas"]], "id_comptag", "sens", "pas", "type_veh").agg(q.alias("q"))
    return g.select("id_comptag", "sens", "pas", F.coalesce("type_veh", F.lit("TV")).alias("type_veh"), *[F.get("q", F.lit(k)).alias(n) for k, n in enumerate(("v10", "v50", "v85"))])


def total_vehicle(counts: DataFrame, keys: Sequence[str], value: str = "nb_veh") -> DataFrame:
    return counts.groupBy(*keys).agg(F.sum(value).alias(value)).withColumn("type_veh", F.lit("TV"))


def day_counts(p: DataFrame) -> DataFrame:
    """Occurrences of each weekday of a counter, its days, and its working days."""
    g = p.select("id_comptag", F.to_date("date_heure").alias("d")).distinct()
    n = g.groupBy("id_comptag", F.weekday("d").alias("jour")).agg(F.count("*").alias("occurrences"))
    t = g.groupBy("id_comptag").agg(F.count("*").alias("jours"), F.count_if(F.weekday("d") < 5).alias("jours_ouvres"))
    return n.join(t, "id_comptag")


def average_week(p: DataFrame) -> DataFrame:
    """Mean vehicles by weekday, hour, vehicle and direction: the sum over the weekday's occurrences."""
    n = p.groupBy("id_comptag", F.weekday("date_heure").alias("jour"), F.hour("date_heure").alias("heure"), "type_veh", "sens").agg(F.count("*").alias("s"))
    w = n.join(day_counts(p).select("id_comptag", "jour", "occurrences"), ["id_comptag", "jour"])
    return w.select("id_comptag", "jour", "heure", "type_veh", "sens", (F.col("s") / F.col("occurrences")).alias("nb_veh"))


def _day_types() -> Column:
    """mja over all 7 days, mjo over working days, and each day by itself; (name, divisor)."""
    one = lambda name, n: F.struct(F.lit(name).alias("type_jour"), F.lit(n).alias("div"))
    named = F.struct(F.get(F.array(*[F.lit(x) for x in DAYS]), F.col("jour")).alias("type_jour"), F.lit(1).alias("div"))
    return F.explode(F.when(F.col("jour") < 5, F.array(one("mja", 7), one("mjo", 5), named)).otherwise(F.array(one("mja", 7), named)))


def hourly_profile(week: DataFrame) -> DataFrame:
    """Average hour of each type of day by direction and for both; half-even rounding."""
    both = F.explode(F.array(F.col("sens"), F.lit("2sens")))
    t = week.withColumn("t", _day_types()).withColumn("direction", both)
    return t.groupBy("id_comptag", "t.type_jour", "t.div", "direction", "heure", "type_veh").agg(F.sum("nb_veh").alias("s")).select("id_comptag", "type_jour", "direction", "heure", "type_veh", half_even(F.col("s") / F.col("div")).cast("int").alias("nb_veh"))


def daily_profile(week: DataFrame) -> DataFrame:
    name = F.get(F.array(*[F.lit(x) for x in DAYS]), F.col("jour"))
    return week.groupBy("id_comptag", name.alias("nom_jour"), "type_veh", "sens").agg(F.sum("nb_veh").alias("nb_veh"))


def direction_compare(week: DataFrame) -> DataFrame:
    side = [F.sum(F.when(F.col("sens") == s, F.col("nb_veh")).otherwise(0.0)).alias(s) for s in SIDES]
    return week.groupBy("id_comptag", "jour").agg(*side)


#: Name, hours, divisor of the published periods.
PERIODS = {"HPM": ([7, 8], 3), "HPS": ([16, 17], 3), "jour": (list(range(6, 22)), 16), "nuit": ([22, 23, 0, 1, 2, 3, 4, 5], 8)}


def peak_periods(week: DataFrame) -> DataFrame:
    """Mean of each period by direction and vehicle.  The sums run over the seven weekdays, without a division by 7."""
    cols = [half_even(F.sum(F.when(F.col("heure").isin(hours), F.col("nb_veh")).otherwise(0.0)) / n).alias(name) for name, (hours, n) in PERIODS.items()]
    return week.groupBy("id_comptag", "sens", "type_veh").agg(*cols)


def busiest_day(p: DataFrame) -> DataFrame:
    """The day, or days, with most vehicles of each type."""
    n = p.groupBy("id_comptag", "type_veh", F.to_date("date_heure").alias("date")).agg(F.count("*").alias("nb_veh"))
    most = n.groupBy("id_comptag", "type_veh").agg(F.max("nb_veh").alias("nb_veh"))
    return n.join(most, ["id_comptag", "type_veh", "nb_veh"], "left_semi")


def week_indicators(week: DataFrame, heavy_known: bool = True) -> DataFrame:
    """tmja, heavy mean and share of the average week; TV rows are used where there are any."""
    tv = F.sum(F.when(F.col("type_veh") == "TV", F.col("nb_veh")))
    tmja = half_even(F.coalesce(tv, F.sum("nb_veh")) / 7).cast("int")
    pl = half_even(F.sum(F.when(F.col("type_veh") == "PL", F.col("nb_veh")).otherwise(0.0)) / 7).cast("int")
    g = week.groupBy("id_comptag").agg(tmja.alias("tmja"), pl.alias("pl"))
    share = F.round(F.try_divide(F.col("pl"), F.col("tmja")) * 100, 2) if heavy_known else F.lit(None).cast("double")
    return g.withColumn("pc_pl", share)


def mjo_grouping_sets(p: DataFrame) -> DataFrame:
    """Speeds and working-day mean by direction and vehicle, by either, and over all.

    Passages are counted by direction, vehicle, day and speed first; totals and
    quantiles of the sets, up to that of everything, come out of these counts.
    """
    work = p.where(F.weekday("date_heure") < 5).select("sens", "type_veh", "vitesse", F.to_date("date_heure").alias("jour"))
    sets = F.explode(F.array(*[F.struct(s.alias("sens"), t.alias("type_veh")) for s in (F.col("sens"), F.lit("tous")) for t in (F.col("type_veh"), F.lit("TV"))]))
    each = work.groupBy("sens", "type_veh", "jour").agg(F.count("*").alias("n")).select(sets.alias("g"), "jour", "n").groupBy("g.sens", "g.type_veh", "jour").agg(F.sum("n").alias("n"))
    mean = each.groupBy("sens", "type_veh").agg((F.sum("n") / F.count("jour")).alias("mjo"))
    speeds = exact_quantiles(work.select(sets.alias("g"), "vitesse").select("g.*", "vitesse"), ["sens", "type_veh"], "vitesse", {"v10": 0.1, "v50": 0.5, "v85": 0.85})
    return speeds.join(mean, ["sens", "type_veh"]).select("sens", "type_veh", "v10", "v50", "v85", "mjo")


def speed_class_table(p: DataFrame) -> DataFrame:
    return p.groupBy("sens", "type_veh", speed_bin(F.col("vitesse")).alias("classe"), F.weekday("date_heure").alias("jour"), F.to_date("date_heure").alias("date")).agg(F.count("*").alias("nb_veh"))


def speed_profile(p: DataFrame) -> DataFrame:
    """Mean v85 by direction and hour for working days, all days, Saturday and Sunday."""
    v = speed_percentiles(p).where("type_veh = 'TV'").withColumns({"jour": F.weekday("pas"), "heure": F.hour("pas")})
    kinds = F.filter(F.array(F.lit("mja"), F.when(F.col("jour") < 5, "mjo"), F.when(F.col("jour") == 5, "samedi"), F.when(F.col("jour") == 6, "dimanche")), lambda k: k.isNotNull())
    return v.withColumn("type_jour", F.explode(kinds)).groupBy("sens", "heure", "type_jour").agg(F.avg("v85").alias("v85"))


def csv_indicators(p: DataFrame) -> DataFrame:
    """tmja and tmjo of each counter as rounded light plus rounded heavy daily means, and the shares; directions summed."""
    d = p.groupBy("id_comptag", "sens", F.to_date("date_heure").alias("date")).agg(F.count_if(F.col("type_veh") == "VL").alias("vl"), F.count_if(F.col("type_veh") == "PL").alias("pl"))
    work = F.weekday("date") < 5
    mean = lambda c, only: F.bround(F.avg(F.when(work, F.col(c)) if only else F.col(c))).cast("int")
    side = d.groupBy("id_comptag", "sens").agg(*[mean(c, only).alias(f"{c}_{n}") for n, only in (("a", False), ("o", True)) for c in ("vl", "pl")])
    g = side.groupBy("id_comptag").agg(*[F.sum(c).alias(c) for c in ("vl_a", "pl_a", "vl_o", "pl_o")])
    share = lambda n: F.round(F.try_divide(F.col(f"pl_{n}"), F.col(f"vl_{n}") + F.col(f"pl_{n}")) * 100, 2)
    return g.select("id_comptag", (F.col("vl_a") + F.col("pl_a")).alias("tmja"), share("a").alias("pc_pl_mja"), (F.col("vl_o") + F.col("pl_o")).alias("tmjo"), share("o").alias("pc_pl_mjo"))


def time_merge(p: DataFrame, id_col: str = "id_comptag") -> DataFrame:
    """Folds a partial first and last day together.

    8 days with overlapping ends: vehicles up to the last clock time go, and the
    last day moves to the first date.  8 without: the first day moves to the last
    date.  More: both end days go.  Fewer: the first day moves to the last date.
    The ends of each counter are one aggregation, joined back.
    """
    e = p.groupBy(id_col).agg(F.min("date_heure").alias("a"), F.max("date_heure").alias("b"), F.countDistinct(F.to_date("date_heure")).alias("n"))
    j = p.join(e, id_col)
    day, first, last = F.to_date("date_heure"), F.to_date("a"), F.to_date("b")
    clock = lambda c: F.date_format(c, "HH:mm:ss.SSSSSS")
    move = lambda to, frm: (F.col("date_heure") + F.make_dt_interval(F.datediff(to, frm))).cast("timestamp_ntz")
    overlap = clock("b") >= clock("a")
    gone = (F.col("n") > 8) & ((day == first) | (day == last)) | (F.col("n") == 8) & overlap & (day == first) & (clock("date_heure") <= clock("b"))
    new = F.when((F.col("n") == 8) & overlap & (day == last), move(first, last)).when((F.col("n") <= 8) & ~((F.col("n") == 8) & overlap) & (day == first), move(last, first)).otherwise(F.col("date_heure"))
    return j.where(~gone).withColumn("date_heure", new).drop("a", "b", "n")
