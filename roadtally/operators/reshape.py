"""Reshaping, sorting, set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import period_parts
from ..schemas import HOURS, INVALID, MONTHS


def longest_edges(df: DataFrame, n: int) -> DataFrame:
    """The n longest edges, ramps first."""
    return df.orderBy(F.desc("bretelle"), F.desc("longueur"), "id").limit(n)


def union_tables(*tables: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def unpivot_annual(df: DataFrame, counts: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Wide indicators to rows with the count's key, without nulls; a row without count has a null key."""
    wide = df.withColumns({c: F.col(c).cast("double") for c in indicators})
    long = wide.unpivot(["id_comptag", "annee"], list(indicators), "indicateur", "valeur").where("valeur is not null")
    k = counts.groupBy("id_comptag", "annee").agg(F.min("id").alias("id_comptag_uniq"))
    return long.join(k, ["id_comptag", "annee"], "left").select("id_comptag_uniq", "indicateur", "valeur")


def unpivot_monthly(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.unpivot(list(keys), MONTHS, "mois", "valeur").where("valeur is not null")


def months_pivot(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One column a month, by conditional sums."""
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col("mois") == k, F.col(value))).alias(m) for k, m in enumerate(MONTHS, 1)])


def hourly_table(df: DataFrame, counts: DataFrame) -> DataFrame:
    k = counts.groupBy("id_comptag", "annee").agg(F.min("id").alias("id_comptag_uniq"))
    return df.join(k, ["id_comptag", "annee"]).select("id_comptag_uniq", "jour", "indicateur", *HOURS, "fichier")


def unpivot_assoc(df: DataFrame, assoc: DataFrame, indicators: Sequence[str]) -> DataFrame:
    """Indicators of associated counts, keyed by reference and period."""
    wide = df.withColumns({c: F.col(c).cast("double") for c in indicators})
    long = wide.unpivot(["id_cptag_ref", "periode"], list(indicators), "indicateur", "valeur").where("valeur is not null")
    return long.join(assoc.select("id_cptag_ref", "periode", F.col("id").alias("id_assoc")), ["id_cptag_ref", "periode"]).select("id_assoc", "indicateur", "valeur")


def hour_pivot(long: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Long hours to 24 columns with TV (all but TV rows) and PL."""
    kinds = F.explode(F.when(F.col("type_veh") == "PL", F.array(F.lit("TV"), F.lit("PL"))).when(F.col("type_veh") == "TV", F.array().cast("array<string>")).otherwise(F.array(F.lit("TV"))))
    cols = [F.sum(F.when(F.col("heure") == h, F.col("valeur")).otherwise(0)).alias(c) for h, c in enumerate(HOURS)]
    return long.withColumn("indicateur", kinds).groupBy(*keys, "indicateur").agg(*cols)


def month_prefix(df: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """``janv_tmja`` and the like: month, indicator, value."""
    long = df.unpivot(list(keys), list(cols), "__c", "valeur").where("valeur is not null")
    return long.select(*keys, F.regexp_extract("__c", "^([a-z]+)_", 1).alias("mois"), F.regexp_extract("__c", "^[a-z]+_(.+)$", 1).alias("indicateur"), "valeur")


def quarter_to_months(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Values of t1 to t4, each on its three months."""
    long = df.unpivot(list(keys), ["t1", "t2", "t3", "t4"], "__q", "valeur").where("valeur is not null")
    q = F.substring("__q", 2, 1).cast("int")
    month = F.explode(F.transform(F.sequence(3 * q - 2, 3 * q), lambda m: F.get(F.array(*[F.lit(x) for x in MONTHS]), m - 1)))
    return long.withColumn("mois", month).select(*keys, "mois", "valeur")


def periods_to_months(df: DataFrame, keys: Sequence[str], groups: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Groups of (period, tmja, pc_pl) columns to one row for the month that holds most of each period's days."""
    parts = F.array(*[F.struct(F.get(period_parts(F.col(p)), F.lit(0)).alias("p"), F.col(t).alias("tmja"), F.col(s).alias("pc_pl")) for p, t, s in groups])
    long = df.select(*keys, F.posexplode(parts).alias("rang", "g")).select(*keys, "rang", "g.p.debut", "g.p.fin", "g.tmja", "g.pc_pl").where("debut is not null")
    split = F.trunc("fin", "month")
    days = F.when(F.trunc("debut", "month") == split, F.trunc("debut", "month")).when(F.datediff(split, "debut") >= F.datediff("fin", split) + 1, F.trunc("debut", "month")).otherwise(split)
    return long.select(*keys, "rang", F.get(F.array(*[F.lit(x) for x in MONTHS]), F.month(days) - 1).alias("mois"), "tmja", "pc_pl")


def year_long(df: DataFrame, zone: str, since: int = 2010) -> DataFrame:
    """Values of a zone by year, years before ``since`` under ``autr``: the latest of them counts."""
    label = F.when(F.col("annee") < since, "autr").otherwise(F.col("annee").cast("string"))
    return df.groupBy(zone, label.alias("periode")).agg(F.max_by("tmja", F.struct("annee", "id")).alias("tmja"))


def daily_blocks(cells: DataFrame, start: int, step: int, stop: str = "Moyenne") -> DataFrame:
    """Blocks of a sheet's cells (file, line, col, value): one row a day and hour, up to the line of the mean."""
    end = cells.where(F.col("value") == stop).groupBy("file").agg(F.min("line").alias("__end"))
    c = cells.join(end, "file", "left").where("__end is null or line < __end")
    at = F.col("line") - start
    hours = c.where((at >= 0) & (F.pmod(at, F.lit(step)) < 24)).withColumns({"bloc": F.floor(at / step).cast("int"), "heure": F.pmod(at, F.lit(step)).cast("int")})
    pick = lambda k: F.max(F.when(F.col("col") == k, F.col("value").try_cast("double")))
    return hours.groupBy("file", "bloc", "heure").agg(pick(0).alias("tv"), pick(1).alias("pl"))


def monthly_final(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """Monthly rows with the sentinel for missing values, shares with two decimals, without the excluded counters."""
    v = F.when(F.col("indicateur") == "pc_pl", F.bround("valeur", 2)).otherwise(F.col("valeur"))
    return df.join(excluded, "id_comptag", "left_anti").withColumn("valeur", F.coalesce(v, F.lit(INVALID)))


def clock(hour: Column) -> Column:
    return F.format_string("%02d:00", hour)
