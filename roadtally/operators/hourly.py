"""Indicators from hourly counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import overlaps_holidays, period_text
from ..schemas import HOURS
from .quantiles import exact_quantiles

DAY_KEY = ["id_comptag", "jour", "indicateur"]


def unpivot_hours(wide: DataFrame, keys: Sequence[str], hours: Sequence[str] = HOURS) -> DataFrame:
    """24 columns to one row an hour."""
    long = wide.unpivot(list(keys), list(hours), "label", "valeur")
    return long.select(*keys, F.regexp_extract("label", r"h(\d+)_", 1).cast("int").alias("heure"), "valeur")


def hour_stats(wide: DataFrame, hour: str) -> DataFrame:
    """Of one hour, by vehicle and weekday or weekend: sigma (n - 1), mean, median, mean +- 2 sigma.

    There are few groups and many rows: the median is that of counted values.
    """
    part = F.when(F.weekday("jour") < 5, "semaine").otherwise("weekend")
    rows = wide.select("indicateur", part.alias("type_jour"), F.col(hour).alias("v"))
    s, m = F.stddev_samp("v"), F.avg("v")
    spread = rows.groupBy("indicateur", "type_jour").agg(s.alias("sigma"), m.alias("moyenne"), (m - 2 * s).alias("bas"), (m + 2 * s).alias("haut"))
    middle = exact_quantiles(rows, ["indicateur", "type_jour"], "v", {"mediane": 0.5}).withColumnsRenamed({"indicateur": "__i", "type_jour": "__t"})
    return spread.join(middle, F.col("indicateur").eqNullSafe(F.col("__i")) & F.col("type_jour").eqNullSafe(F.col("__t"))).select("indicateur", "type_jour", "sigma", "moyenne", "mediane", "bas", "haut")


def directions(wide: DataFrame) -> DataFrame:
    """Both directions added up: TV (VL + PL) and PL rows of each counter-day, files joined where they differ."""
    total = [F.sum(h).alias(h) for h in HOURS]
    files = F.array_join(F.array_sort(F.collect_set("fichier")), " ; ").alias("fichier")
    keys = ["id_comptag", "annee", "jour"]
    both = F.explode(F.when(F.col("indicateur") == "PL", F.array(F.lit("TV"), F.lit("PL"))).otherwise(F.array(F.lit("TV"))))
    return wide.withColumn("kind", both).groupBy(*keys, F.col("kind").alias("indicateur")).agg(*total, files)


def tmja_from_hourly(days: DataFrame, period: Column | None = None) -> DataFrame:
    """Daily mean of each counter, year (and period) and indicator, truncated, and the heavy share.

    Days count by their rows.  Counters without heavy rows have no result.
    One aggregation: the two indicators are told apart inside it.
    """
    total = sum((F.coalesce(F.col(h), F.lit(0.0)) for h in HOURS), F.lit(0.0))
    names = ["id_comptag", "annee"] + (["mois"] if period is not None else [])
    keys = ["id_comptag", "annee"] + ([period.alias("mois")] if period is not None else [])
    sums = days.select(*keys, "indicateur", total.alias("total"))  # added up once for each row
    mean = lambda kind: F.try_divide(F.sum(F.when(F.col("indicateur") == kind, F.col("total"))), F.count_if(F.col("indicateur") == kind)).cast("int")
    g = sums.groupBy(*names).agg(mean("TV").alias("tv"), mean("PL").alias("pl"))
    g = g.where("tv > 0 and pl is not null")
    wide = g.select(*names, F.col("tv").cast("double").alias("tmja"), F.round(F.col("pl") / F.col("tv") * 100, 2).alias("pc_pl"))
    return wide.unpivot(names, ["tmja", "pc_pl"], "indicateur", "valeur")


def monthly_from_hourly(days: DataFrame) -> DataFrame:
    return tmja_from_hourly(days, F.month("jour"))


def period_from_hourly(days: DataFrame) -> DataFrame:
    g = days.groupBy("id_comptag").agg(F.min("jour").alias("debut"), F.max("jour").alias("fin"))
    return g.select("id_comptag", period_text(F.col("debut"), F.col("fin")).alias("periode"))


def typical_day(days: DataFrame) -> DataFrame:
    """TV only: mean of each hour over all days (MJA), and over working days outside holidays (MJO), truncated."""
    tv = days.where("indicateur = 'TV'").withColumn("ouvre", (F.weekday("jour") < 5) & ~overlaps_holidays(F.col("jour"), F.col("jour")))
    kinds = F.explode(F.when(F.col("ouvre"), F.array(F.lit("MJA"), F.lit("MJO"))).otherwise(F.array(F.lit("MJA"))))
    return tv.withColumn("type_jour", kinds).groupBy("id_comptag", "type_jour").agg(*[(F.sum(h) / F.count("*")).cast("int").alias(h) for h in HOURS])


def typical_day_long(days: DataFrame) -> DataFrame:
    """Typical days in long form, with a clock time."""
    long = unpivot_hours(typical_day(days), ["id_comptag", "type_jour"])
    return long.select("id_comptag", "type_jour", F.format_string("%02d:00", "heure").alias("horaire"), "valeur")


def two_files_sum(wide: DataFrame, keys: Sequence[str] = ("id_comptag", "jour")) -> DataFrame:
    """Directions from separate files added up: total, heavy total and share of each counter-day."""
    total = sum((F.col(h) for h in HOURS), F.lit(0.0))
    g = wide.groupBy(*keys).agg(F.sum(total).alias("tv"), F.sum(F.when(F.col("indicateur") == "PL", total).otherwise(0.0)).alias("pl"), F.countDistinct("fichier").alias("fichiers"))
    return g.withColumn("pc_pl", F.round(F.try_divide(F.col("pl"), F.col("tv")) * 100, 2))


def daily_mean_trim(totals: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Daily mean without zero days; of 7 or 8 days the first and last are merged, of more both are dropped."""
    d = totals.where(F.col(value) != 0)
    g = d.groupBy(key).agg(F.count("*").alias("n"), F.sum(value).alias("s"), F.min_by(value, day).alias("a"), F.max_by(value, day).alias("z"))
    mean = F.when(F.col("n") > 8, (F.col("s") - F.col("a") - F.col("z")) / F.nullif(F.col("n") - 2, F.lit(0))).when(F.col("n") >= 7, F.col("s") / F.nullif(F.col("n") - 1, F.lit(0))).otherwise(F.col("s") / F.col("n"))
    return g.select(key, F.col("n").alias("jours"), mean.alias("moyenne"))
