"""Matching new counts with the catalogue.

Steps that the provider tools keep in separate tables are one table with a
class column here: a row is never lost between two tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .geo import post_rank

MAPPING, ASSOCIATE, DEMOTE, NEW = "correspondance", "associe", "nouveau, ancien associe", "nouveau"


def score() -> Column:
    """Order of preference, best first: kind of counter, outside holidays, traffic, share; then the id.

    A struct compares field by field, without the precision a sum of powers of ten loses.
    """
    outside = F.when(F.col("vacances") | F.col("vacances").isNull(), 1).otherwise(2)
    return F.struct((-post_rank(F.col("type_poste"))).alias("a"), (-outside).alias("b"), (-F.col("tmja")).alias("c"), (-F.col("pc_pl")).alias("d"), F.col("id_comptag").alias("e"))


def ref_assoc(df: DataFrame, group: str) -> DataFrame:
    """The best point of each group is the reference; the others get its id.

    The best is found by an aggregation, so a group with very many points is combined before the shuffle.
    """
    best = df.groupBy(group).agg(F.min(score())["e"].alias("id_ref"))
    return df.join(best, group).withColumn("est_ref", F.col("id_comptag") == F.col("id_ref"))


def duplicates(df: DataFrame, key: str = "id_comptag", row: str = "id") -> DataFrame:
    """The same rule among counts that share an id: one stays."""
    order = F.struct(score().alias("s"), F.col(row).alias("r"))
    best = df.groupBy(key).agg(F.min(order)["r"].alias("garde"))
    return df.join(best, key).withColumn("est_ref", F.col(row) == F.col("garde"))


def existing_on_section(df: DataFrame, stored: DataFrame) -> DataFrame:
    """References, with the stored counter of their section where there is one."""
    s = stored.groupBy("gid").agg(F.min("id_comptag").alias("id_db"))
    return df.join(s, "gid", "left").withColumn("section_occupee", F.col("id_db").isNotNull())


def decision(topological: Column, stored_id: Column, new: Column, db: Column, holidays: Column, same_year: Column) -> Column:
    """The decision table: what becomes of a new reference whose section has a stored counter."""
    higher, lower = post_rank(new) > post_rank(db), post_rank(new) < post_rank(db)
    one_off = (new == "ponctuel") & (db == "ponctuel")
    return (
        F.when(stored_id.isNull(), NEW)
        .when(topological & (new == db), MAPPING)
        .when(lower, ASSOCIATE)
        .when(higher, DEMOTE)
        .when(one_off & holidays, ASSOCIATE)
        .when(one_off, DEMOTE)
        .when(~same_year, DEMOTE)
        .otherwise(NEW)
    )


def overrides(df: DataFrame, manual: DataFrame) -> DataFrame:
    """Manual moves: (id_comptag, classe, ref, supprime).  Associates of a reference that left follow its replacement."""
    m = manual.select("id_comptag", F.col("classe").alias("__classe"), F.col("ref").alias("__ref"), F.col("supprime").alias("__gone"))
    j = df.join(m, "id_comptag", "left").where(~F.coalesce("__gone", F.lit(False)))
    j = j.withColumns({"classe": F.coalesce("__classe", "classe"), "id_ref": F.coalesce("__ref", "id_ref")}).drop("__classe", "__ref", "__gone")
    moved = manual.where("ref is not null").select(F.col("id_comptag").alias("__old"), F.col("ref").alias("__new"))
    return j.join(moved, j["id_ref"] == moved["__old"], "left").withColumn("id_ref", F.coalesce("__new", "id_ref")).drop("__old", "__new")


def mapping_rows(df: DataFrame, excluded: DataFrame) -> DataFrame:
    m = df.where(F.col("classe") == MAPPING).join(excluded, "id_comptag", "left_anti")
    return m.select(F.col("id_comptag").alias("id_gest"), F.col("id_db").alias("id_gti")).where("id_gest <> id_gti")


def same_section(df: DataFrame) -> DataFrame:
    """Rows of sections on which several counters give the same indicator."""
    n = F.count("*").over(Window.partitionBy("gid", "indicateur"))
    return df.withColumn("n", n).where("n > 1")


def split_declared(df: DataFrame, declared: DataFrame) -> DataFrame:
    """Counters with the reference they are declared an associate of; ``ambigu`` marks sections left with several references."""
    j = df.join(declared.select(F.col("associe").alias("id_comptag"), F.col("reference").alias("id_ref")), "id_comptag", "left")
    n = F.count_if(F.col("id_ref").isNull()).over(Window.partitionBy("gid"))
    return j.withColumn("ambigu", n > 1)


def final_id(stored: Column, new: Column, forced: Column) -> Column:
    return F.when(forced, new).otherwise(F.coalesce(stored, new))


def mapping_by_route_marker(provider: DataFrame, stored: DataFrame) -> DataFrame:
    """Mapping rows of provider points on the same road and marker as a stored counter, where the ids differ."""
    s = stored.groupBy("route", "pr").agg(F.min("id_comptag").alias("id_gti"))
    return provider.join(s, ["route", "pr"]).select(F.col("id_comptag").alias("id_gest"), "id_gti").where("id_gest <> id_gti")


def assoc_reference(stored: Column, new: Column, stored_type: Column) -> Column:
    """The reference of an associate: equal or only one known: that; else the stored one unless it is one-off."""
    return F.when(stored.isNull() | new.isNull() | (stored == new), F.coalesce(stored, new)).when(stored_type != "ponctuel", stored).otherwise(new)
