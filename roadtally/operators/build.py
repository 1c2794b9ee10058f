"""Target rows: counters, counts and indicators, of references and of associates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import holiday_note, period_valid
from ..schemas import TABLES
from .checks import require_columns
from .geo import xy
from .joins import count_key, count_key_latest, id_mapping
from .matching import duplicates, final_id
from .windows import rank_in_reference


def _project(df: DataFrame, table: str) -> DataFrame:
    return df.select(*[c for c in TABLES[table] if c in df.columns])


def counters(df: DataFrame, constants: dict[str, object]) -> DataFrame:
    """Counter rows with the provider's constants, coordinates and only the table's columns; rows without id or kind are left out."""
    require_columns(df, ["id_comptag", "type_poste", "x", "y"])
    made = xy(df, "x", "y").withColumns({k: F.lit(v) for k, v in constants.items()})
    return _project(made.where("id_comptag is not null and type_poste is not null"), "compteur")


def counts(df: DataFrame, known: DataFrame, year: int, vehicle: str) -> DataFrame:
    """Count rows with a ``rejet`` column: unknown counter, bad period, or null."""
    k = known.select("id_comptag").distinct().withColumn("__known", F.lit(True))
    j = df.join(k, "id_comptag", "left").withColumns({"annee": F.lit(str(year)), "type_veh": F.lit(vehicle)})
    why = F.when(F.col("__known").isNull(), "compteur inconnu").when(~period_valid(F.col("periode")), "periode")
    return j.withColumn("rejet", why).drop("__known")


def all_counts(known: DataFrame, new: DataFrame) -> DataFrame:
    """Known and new counts stacked; of several with one id the best stays."""
    return duplicates(known.unionByName(new)).where("est_ref")


def all_indicators(made: DataFrame, indicators: DataFrame) -> DataFrame:
    """Indicators of the counts just built, each once."""
    kept = indicators.join(made.select("id_comptag").distinct(), "id_comptag", "left_semi")
    return kept.dropDuplicates(["id_comptag", "annee", "indicateur", "valeur"])


def assoc_counts(df: DataFrame, mapping: DataFrame, stored_counts: DataFrame, stored: DataFrame, in_holidays: Column) -> DataFrame:
    """Associated counts: mapped reference, key of its latest count, rank, holiday remark."""
    j = id_mapping(df, mapping, "id_comptag")
    j = count_key_latest(j, stored_counts).withColumnRenamed("id_comptag_uniq", "id_cptag_ref")
    j = j.withColumn("obs", holiday_note(F.col("obs"), in_holidays))
    return rank_in_reference(j, stored, "id_cptag_ref", F.col("id"))


def assoc_counters(df: DataFrame, new_ref: str, stored_ref: str) -> DataFrame:
    """Associated counters with the reference's id and whole-number marker and distance."""
    return df.select("id_comptag", F.coalesce(new_ref, stored_ref).alias("id_cpteur_ref"), "route", F.col("pr").try_cast("int").alias("pr"), F.col("abs").try_cast("int").alias("abs"))


def assoc_indicators(df: DataFrame, assoc: DataFrame) -> DataFrame:
    """Indicator rows moved to the associates by counter, names in upper case."""
    return df.join(assoc.select("id_comptag", "id_assoc"), "id_comptag").select("id_assoc", F.upper("indicateur").alias("indicateur"), "valeur")


def demote_list(decided: DataFrame, last: DataFrame, year: int) -> DataFrame:
    """(new id, stored id, last stored year, new year) of stored counters that make room."""
    return decided.join(last.select(F.col("id_comptag").alias("id_db"), F.col("annee_tmja").alias("annee_db")), "id_db", "left").select(F.col("id_comptag").alias("id_new"), "id_db", "annee_db", F.lit(year).alias("annee_new"))


def demote_apply(counts_: DataFrame, demoted: DataFrame, assoc: DataFrame) -> DataFrame:
    """After demotion: where each count belongs, and the reference of each associate."""
    old = demoted.select(F.col("id_db").alias("id_comptag"), F.col("id_new").alias("__ref")).groupBy("id_comptag").agg(F.min("__ref").alias("__ref"))
    moved = counts_.join(old, "id_comptag", "left").select("id", F.when(F.col("__ref").isNull(), "comptage").otherwise("comptage_assoc").alias("cible"), F.col("__ref").alias("reference"))
    turned = assoc.join(old.withColumnRenamed("id_comptag", "reference"), "reference", "left").select("id", F.lit("comptage_assoc").alias("cible"), F.coalesce("__ref", "reference").alias("reference"))
    return moved.unionByName(turned)


def low_quality(df: DataFrame, counts_: DataFrame) -> DataFrame:
    """Keys of counts of the lowest note, each once."""
    return count_key(df.where("note = 1"), counts_).select("id_comptag_uniq").where("id_comptag_uniq is not null").distinct()


def map_upsert(df: DataFrame, counts_: DataFrame) -> DataFrame:
    """Map-derived counts: update where the count exists, else insert."""
    k = counts_.select("id_comptag", "annee").distinct().withColumn("__k", F.lit(True))
    return df.join(k, ["id_comptag", "annee"], "left").withColumn("action", F.when(F.col("__k"), "update").otherwise("insert")).drop("__k")


def indicators_final_id(df: DataFrame, points: DataFrame, counts_: DataFrame) -> DataFrame:
    """Indicators under the final id of their counter, with the count's key."""
    p = points.select("id_comptag", final_id(F.col("id_db"), F.col("id_comptag"), F.col("force")).alias("__final"))
    j = df.join(p, "id_comptag").withColumn("id_comptag", F.col("__final")).drop("__final")
    return count_key(j, counts_)


def obs_new_point(df: DataFrame, dates: Sequence[str]) -> DataFrame:
    """Remark of an inserted point."""
    return df.withColumn("obs", F.concat_ws(",", F.lit("nouveau_point"), *[F.date_format(c, "yyyy-MM-dd") for c in dates]))
