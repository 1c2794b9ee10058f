"""Joins of the catalogue.  Sides are broadcast only below a checked size; Spark does that by its own threshold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalise_label


def id_mapping(df: DataFrame, mapping: DataFrame, col: str = "id_comptag") -> DataFrame:
    """Replaces a provider's id by ours where a mapping exists."""
    m = mapping.select(F.col("id_gest").alias("__gest"), F.col("id_gti").alias("__gti"))
    return df.join(m, F.col(col) == F.col("__gest"), "left").withColumn(col, F.coalesce("__gti", col)).drop("__gest", "__gti")


def known_unknown(df: DataFrame, catalogue: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One ``connu`` column instead of two tables: whether the catalogue has the key."""
    c = catalogue.select(*keys).distinct().withColumn("__known", F.lit(True))
    return df.join(c, list(keys), "left").withColumn("connu", F.coalesce("__known", F.lit(False))).drop("__known")


def count_key(df: DataFrame, counts: DataFrame) -> DataFrame:
    """The key of the count of the same counter and year; the smallest where there are several."""
    k = counts.groupBy("id_comptag", "annee").agg(F.min("id").alias("id_comptag_uniq"))
    return df.join(k, ["id_comptag", "annee"], "left")


def count_key_latest(df: DataFrame, counts: DataFrame) -> DataFrame:
    """The key of the counter's latest count."""
    k = counts.groupBy("id_comptag").agg(F.max_by("id", F.struct(F.col("annee"), -F.col("id"))).alias("id_comptag_uniq"))
    return df.join(k, "id_comptag", "left")


def assoc_key(assoc: DataFrame, refs: DataFrame) -> DataFrame:
    """Keys of associated counts of the given references and periods."""
    return assoc.join(refs, ["id_cptag_ref", "periode"])


def missing_traffic(counts: DataFrame, indicators: DataFrame) -> DataFrame:
    return counts.join(indicators.where("indicateur = 'tmja'").select(F.col("id_comptag_uniq").alias("id")), "id", "left_anti")


def last_known(df: DataFrame) -> DataFrame:
    """Latest known tmja and share of each counter, each with its year."""
    last = lambda c: F.max_by(F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("annee").alias("a"))), F.when(F.col(c).isNotNull(), F.col("annee")))
    g = df.groupBy("id_comptag").agg(last("tmja").alias("t"), last("pc_pl").alias("p"))
    return g.select("id_comptag", F.col("t.v").alias("tmja"), F.col("t.a").alias("annee_tmja"), F.col("p.v").alias("pc_pl"), F.col("p.a").alias("annee_pc_pl"))


def tv_pl(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """TV and PL rows side by side, and the share: one aggregation instead of a self-join."""
    pick = lambda k: F.max(F.when(F.col("indicateur") == k, F.col(value))).alias(k.lower())
    return df.groupBy(*keys).agg(pick("TV"), pick("PL")).where("tv is not null and pl is not null").withColumn("pc_pl", F.round(F.try_divide(F.col("pl"), F.col("tv")) * 100, 2))


def fallback_key(df: DataFrame, catalogue: DataFrame, main: Column, second: Column, value: str) -> DataFrame:
    """Looks a row up by its main key, else by its second."""
    a = catalogue.where("cle1 is not null").groupBy("cle1").agg(F.min(value).alias("__a"))
    b = catalogue.where("cle2 is not null").groupBy("cle2").agg(F.min(value).alias("__b"))
    j = df.withColumns({"__main": main, "__second": second})
    j = j.join(a, j["__main"] == a["cle1"], "left").join(b, j["__second"] == b["cle2"], "left")
    return j.withColumn(value, F.coalesce("__a", "__b")).drop("cle1", "cle2", "__a", "__b", "__main", "__second")


def station(df: DataFrame, rules: DataFrame, stations: DataFrame) -> DataFrame:
    """Station name by its road's rule (a prefix to cut), then the counter of that station."""
    named = df.join(rules, "route", "left")
    name = F.when(F.col("prefixe").isNotNull() & F.col("fichier").startswith(F.col("prefixe")), F.substr("fichier", F.length("prefixe") + 1)).otherwise(F.col("fichier"))
    return named.withColumn("station", name).drop("prefixe").join(stations, "station", "left")


def section_then_catalogue(df: DataFrame, sections: DataFrame, catalogue: DataFrame) -> DataFrame:
    """The counter of the section, else that of the stored point of the same road."""
    j = df.join(sections, "section", "left").join(catalogue, "route", "left")
    return j.withColumn("id_comptag", F.coalesce("id_section", "id_route")).drop("id_section", "id_route")


def cross_complete(df: DataFrame, key: str, hours: Sequence[int], kinds: Sequence[str], sides: Sequence) -> DataFrame:
    """Every combination of hour, vehicle and direction for each key: constant lists, exploded."""
    lists = lambda v: F.explode(F.array(*[F.lit(x) for x in v]))
    return df.select(key).distinct().withColumn("heure", lists(hours)).withColumn("type_veh", lists(kinds)).withColumn("sens", lists(sides))


def anti_pairs(df: DataFrame, pairs: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(pairs, list(keys), "left_anti")


def reconcile(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys in one set only, or in both."""
    x, y = a.select(key).distinct().withColumn("__a", F.lit(1)), b.select(key).distinct().withColumn("__b", F.lit(1))
    where = F.when(F.col("__a").isNull(), "droite").when(F.col("__b").isNull(), "gauche").otherwise("deux")
    return x.join(y, key, "full").select(key, where.alias("presence"))


def from_points(df: DataFrame, points: DataFrame, value: str) -> DataFrame:
    """By the rounded start marker, where there is no id."""
    p = points.groupBy(F.round(value, 2).alias("__v")).agg(F.min("id_comptag").alias("id_point"))
    return df.join(p, F.round(df[value], 2) == p["__v"], "left").drop("__v")


def manual_address(df: DataFrame, manual: DataFrame) -> DataFrame:
    """Missing addresses from a table made by hand."""
    m = manual.select("id_comptag", F.col("adresse").alias("__manual"))
    return df.join(m, "id_comptag", "left").withColumn("adresse", F.coalesce("adresse", "__manual")).drop("__manual")


def counter_quality(indicators: DataFrame, counts: DataFrame, qualities: DataFrame) -> DataFrame:
    j = indicators.join(counts.select(F.col("id").alias("id_comptag_uniq"), "id_comptag", "annee"), "id_comptag_uniq")
    return j.join(qualities, "id_comptag_uniq", "left")


def lane_monthly(sheet: DataFrame, lanes: DataFrame, months: Sequence[str]) -> DataFrame:
    """Sheet rows of a lane by its normalised name; exact copies of a row once."""
    key = normalise_label(F.col("cle")).alias("cle")
    return sheet.select(key, *months).distinct().join(lanes.withColumn("cle", normalise_label(F.col("cle"))).distinct(), "cle")


def indicator_series(counts: DataFrame, indicators: DataFrame, counter: str, wanted: Sequence[str], year: int) -> DataFrame:
    c = counts.where((F.col("id_comptag") == counter) & (F.col("annee") == year))
    return c.join(indicators.where(F.col("indicateur").isin(list(wanted))), c["id"] == indicators["id_comptag_uniq"]).select("id_comptag", "annee", "id_comptag_uniq", "indicateur", "valeur")


def zone_number(counters: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone number of a stored remark; provider zones are joined on it."""
    n = F.regexp_extract("obs", r"zone (\d+)", 1).try_cast("int")
    return counters.withColumn("zone", n).join(zones, "zone", "left")


def ranked_first(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
