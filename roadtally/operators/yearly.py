"""Aggregations of yearly and monthly deliveries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import INVALID


def files_mean(files: DataFrame, key: str) -> DataFrame:
    """Several files of a point: truncated mean of tmja, rounded mean of the shares above 0."""
    share = F.avg(F.when(F.col("pc_pl") > 0, F.col("pc_pl")))
    return files.groupBy(key).agg(F.avg("tmja").cast("int").alias("tmja"), F.round(share, 2).alias("pc_pl"), F.count("*").alias("fichiers"))


def monthly_two_directions(m: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Months of both directions: traffic summed, share (0 to 1) averaged in percent; what isn't positive is invalid."""
    g = m.groupBy(*keys).agg(F.sum("tmja").alias("tmja"), (F.avg("part") * 100).alias("pc_pl"))
    valid = lambda c: F.when(F.col(c) > 0, F.col(c)).otherwise(INVALID)
    return g.where(F.col("pc_pl").isNull() | (F.col("pc_pl") <= 99)).select(*keys, valid("tmja").alias("tmja"), F.round(valid("pc_pl"), 2).alias("pc_pl"))


def monthly_one_or_two(m: DataFrame, keys: Sequence[str], sides: str) -> DataFrame:
    """Traffic of two directions summed; that of one doubled, with a remark."""
    one = F.countDistinct(sides) == 1
    return m.groupBy(*keys).agg(F.sum("tmja").alias("s"), one.alias("one"), F.round(F.avg("part") * 100, 2).alias("pc_pl")).select(
        *keys, F.when(F.col("one"), F.col("s") * 2).otherwise(F.col("s")).alias("tmja"), "pc_pl", F.when(F.col("one"), "1 seul sens *2").alias("obs")
    )


def vl_pl_to_share(df: DataFrame) -> DataFrame:
    """TV = VL + PL, and the heavy share."""
    tv = F.col("vl") + F.col("pl")
    return df.withColumns({"tv": tv, "pc_pl": F.round(F.try_divide(F.col("pl"), tv) * 100, 2)}).drop("vl", "pl")


MISSING = "Donnees Non Disponibles"


def map_counts(df: DataFrame) -> DataFrame:
    """Per counter: tmja summed, mean share, first source in order; both null where data are said to be missing."""
    lost = F.bool_or(F.coalesce(F.col("obs").contains(MISSING), F.lit(False)))
    g = df.groupBy("id_comptag").agg(F.sum("tmja").alias("t"), F.avg("pc_pl").alias("p"), F.min("src").alias("src"), lost.alias("lost"))
    return g.select("id_comptag", F.when(~F.col("lost"), F.col("t")).alias("tmja"), F.when(~F.col("lost"), F.round("p", 4)).alias("pc_pl"), "src")


def max_per_year(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows with the highest count of each key; ties stay."""
    best = df.groupBy(*keys).agg(F.max(value).alias(value))
    return df.join(best, [*keys, value], "left_semi")


def single_direction_pair(df: DataFrame, zone: str) -> DataFrame:
    return df.groupBy(zone, "annee").agg(F.sum("tmja").alias("tmja"), F.round(F.avg("pc_pl"), 4).alias("pc_pl"))


def harmonise_group(df: DataFrame, group: str, value: str) -> DataFrame:
    """One value a group: the common one, else the smallest known."""
    return df.groupBy(group).agg(F.min(value).alias(value))


def concat_files(df: DataFrame, key: str, file: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(file)), " ; ").alias("fichiers"))


def station_per_counter(df: DataFrame, key: str, station: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(station).alias(station))


def quality_by_type(df: DataFrame) -> DataFrame:
    return df.groupBy("qualite", "note", "type_poste").agg(F.count("*").alias("n"))


#: Order of the quality texts.
QUALITIES = ["NC", "faible", "moyenne", "bonne"]


def quality_crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of every pair of qualities, 0 where there are none; rows carry their rank."""
    t = df.groupBy(row).pivot(column, QUALITIES).count().fillna(0, QUALITIES)
    return t.withColumn("rang", F.array_position(F.array(*[F.lit(x) for x in QUALITIES]), F.col(row)).cast("int"))


def counter_span(df: DataFrame) -> DataFrame:
    return df.groupBy("id_comptag").agg(F.min("annee").alias("premiere"), F.max("annee").alias("derniere"), F.array_join(F.array_sort(F.collect_set("indicateur")), ",").alias("indicateurs"))


def year_filtered(df: DataFrame, year: int) -> DataFrame:
    return df.where(F.col("annee") <= year)


def yearly_evolution(df: DataFrame) -> DataFrame:
    """Ratio of tmja to the year before, and to the counter's first year."""
    w = Window.partitionBy("id_comptag").orderBy("annee")
    first = F.first("tmja").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return df.select("id_comptag", "annee", "tmja", F.try_divide(F.col("tmja"), F.lag("tmja").over(w)).alias("evolution_an"), F.try_divide(F.col("tmja"), first).alias("evolution_totale"))


def evolution_impact(df: DataFrame, with_outliers: Column, without: Column) -> DataFrame:
    """Gap in points between an evolution with and without outliers, for rows with and without a manager."""
    return df.withColumns({"impact": F.abs(with_outliers - without) * 100, "avec_gestionnaire": F.col("gestionnai").isNotNull()})


def annual_from_monthly_rows(df: DataFrame, excluded: DataFrame) -> DataFrame:
    """tmja, and the share where there is one, of each counter, without the excluded ones."""
    kept = df.join(excluded, "id_comptag", "left_anti")
    pick = lambda k: F.max(F.when(F.col("indicateur") == k, F.col("annuel"))).alias(k)
    return kept.groupBy("id_comptag", "annee").agg(pick("tmja"), pick("pc_pl"))


def zone_geometries(df: DataFrame) -> DataFrame:
    """Distinct positions of each zone and kind of point."""
    return df.groupBy("zone", "type").agg(F.countDistinct(F.struct("x", "y")).alias("positions"), F.count("*").alias("points"))


def zone_case(df: DataFrame) -> DataFrame:
    """How a zone is counted: a double point, else one or two simple positions, else one detector, else mixed."""
    g = zone_geometries(df).groupBy("zone").agg(F.bool_or(F.col("type") == "Double").alias("double"), F.every(F.col("type") == "Simple").alias("simple"), F.every(F.col("type") == "Detecteur").alias("detecteur"), F.sum("positions").alias("n"))
    case = F.when(F.col("double"), "double").when(F.col("simple") & F.col("n").isin(1, 2), F.concat(F.lit("simple "), F.col("n").cast("string"))).when(F.col("detecteur") & (F.col("n") == 1), "detecteur").when(F.col("simple") | F.col("detecteur"), "rejete").otherwise("mixte")
    return g.select("zone", case.alias("cas"))


def calibrated_merge(df: DataFrame, header: DataFrame) -> DataFrame:
    """Rows of a calibrated file with the lane text of its header; blank lanes are left out, lanes number the directions."""
    lanes = header.where(F.trim("lane") != "")
    lanes = lanes.withColumn("sens_num", F.row_number().over(Window.partitionBy("file").orderBy("rangenum")))
    return df.join(lanes, ["file", "rangenum"])
