"""Ways through the library, each one lazy plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import period_text
from ..operators import build as bu
from ..operators import checks as ck
from ..operators import geo
from ..operators import hourly as ho
from ..operators import joins as jo
from ..operators import matching as ma
from ..operators import reshape as rs
from ..operators import vehicles as ve
from ..operators import yearly as ye


def vehicles_to_week(passages: DataFrame) -> dict[str, DataFrame]:
    """Individual vehicles -> counters with enough days -> average week -> its tables."""
    enough = ck.enough_days(passages).where("suffisant").select("id_comptag")
    kept = ve.time_merge(passages.join(enough, "id_comptag", "left_semi"))
    week = ve.average_week(kept)
    return {"semaine": week, "profil_horaire": ve.hourly_profile(week), "periodes": ve.peak_periods(week), "jours_charges": ve.busiest_day(kept), "indicateurs": ve.week_indicators(week)}


def hourly_to_indicators(wide: DataFrame, most_zeros: int = 8, days: int = 7) -> dict[str, DataFrame]:
    """Hourly deliveries -> one pass of checks by counter and day -> both directions -> annual and monthly indicators and period.

    The report is two aggregations of the day table; the rows that stay are those of its good days.
    """
    flags = ck.day_flags(wide, most_zeros)
    verdict = ck.verdicts(flags, days)
    accepted = verdict.where("accepte").select("id_comptag")
    good = flags.where("not invalide and not seul").select("id_comptag", "jour").join(accepted, "id_comptag", "left_semi")
    both = ho.directions(wide.join(good, ["id_comptag", "jour"], "left_semi"))
    return {"horaire": both, "annuel": ho.tmja_from_hourly(both), "mensuel": ho.monthly_from_hourly(both), "periode": ho.period_from_hourly(both), "rapport": ck.reasons(verdict)}


def individual_to_hourly(passages: DataFrame, keys: list[str]) -> DataFrame:
    """Individual vehicles -> zero-filled hourly counts -> the 24-column table."""
    counts = ve.hourly_counts(passages).where("type_veh <> 'TV'")
    long = counts.select("id_comptag", "sens", F.to_date("pas").alias("jour"), F.hour("pas").alias("heure"), "type_veh", F.col("nb_veh").alias("valeur"))
    return rs.hour_pivot(long, keys)


def place_new_points(new: DataFrame, stored: DataFrame, segments: DataFrame, distance: float, same_segment: Column, same_year: Column, cell: float | None = None) -> DataFrame:
    """New points -> section -> reference or associate -> what becomes of each: one table with a ``classe`` column."""
    split = geo.split_by_section(new, segments, distance, cell=cell)
    on_road = split.where("classe in ('seul', 'plusieurs')")
    refs = ma.ref_assoc(on_road.drop("classe"), "gid")
    there = geo.nearest(stored, segments, distance, cell=cell).groupBy("gid").agg(F.min_by("id_comptag", F.struct("distance", "id_comptag")).alias("id_db"))
    db = stored.select(F.col("id_comptag").alias("id_db"), F.col("type_poste").alias("type_db"), F.col("pr").alias("pr_db"))
    j = refs.join(there, "gid", "left").join(db, "id_db", "left")
    decided = ma.decision(same_segment, F.col("id_db"), F.col("type_poste"), F.col("type_db"), F.coalesce("vacances", F.lit(True)), same_year)
    placed = j.select("id_comptag", "gid", "id_ref", "id_db", F.when(F.col("est_ref"), decided).otherwise(ma.ASSOCIATE).alias("classe"))
    rest = split.where("classe not in ('seul', 'plusieurs')").select("id_comptag", F.lit(None).cast("int").alias("gid"), F.lit(None).cast("string").alias("id_ref"), F.lit(None).cast("string").alias("id_db"), "classe")
    return placed.unionByName(rest)


def classify(new: DataFrame, stored: DataFrame, mapping: DataFrame, segments: DataFrame, distance: float, cell: float | None = None) -> dict[str, DataFrame]:
    """New points -> ids by the stored mapping -> known or not -> mapping of the unknown that share a segment with a stored point -> known or not.

    ``correspondances``: the mapping rows found (id_gest, id_gti); ``comptages``: the new points under their final id, with ``connu``.
    ``mapping`` has an id once at most.
    """
    first = jo.known_unknown(jo.id_mapping(new, mapping), stored, ["id_comptag"])
    same = geo.same_segment(first.where("not connu").select("id_comptag", "x", "y"), stored.select("id_comptag", "x", "y"), segments, distance, cell=cell)
    found = same.where("id_gest <> id_gti").select("id_gest", "id_gti").join(mapping, "id_gest", "left_anti")
    return {"correspondances": found, "comptages": jo.known_unknown(jo.id_mapping(first.drop("connu"), found), stored, ["id_comptag"])}


def city_files(passages: DataFrame, files: DataFrame) -> dict[str, DataFrame]:
    """A city's vehicle files, one a direction -> hourly table of both directions and annual indicators with their period.

    ``passages``: fichier, date_heure, type_veh; ``files``: fichier, id_comptag, sens.  Files that are not listed are left out.
    """
    p = passages.join(files, "fichier")
    counts = p.groupBy("id_comptag", F.to_date("date_heure").alias("jour"), F.hour("date_heure").alias("heure"), "type_veh").agg(F.count("*").alias("valeur"))
    span = p.groupBy("id_comptag").agg(F.min("date_heure").alias("a"), F.max("date_heure").alias("b"), F.countDistinct("sens").alias("nb_sens"), F.min("fichier").alias("fichier"))
    span = span.select("id_comptag", "nb_sens", "fichier", F.year("a").alias("annee"), period_text(F.to_date("a"), F.to_date("b")).alias("periode"))
    return {"horaire": rs.hour_pivot(counts, ["id_comptag", "jour"]), "agrege": ve.csv_indicators(p).join(span, "id_comptag")}


def records_to_indicators(passages: DataFrame, notes: DataFrame) -> dict[str, DataFrame]:
    """Calibrated records -> counters with enough days, their ends folded -> hourly table -> annual indicators, with the quality note of the counter.

    ``notes``: id_comptag and any columns, a counter once; counters without a note stay.
    """
    enough = ck.enough_days(passages).where("suffisant").select("id_comptag")
    folded = ve.time_merge(passages.join(enough, "id_comptag", "left_semi"))
    hours = individual_to_hourly(folded, ["id_comptag", "jour"]).withColumn("annee", F.year("jour"))
    return {"horaire": hours, "agrege": ho.tmja_from_hourly(hours).join(notes, "id_comptag", "left")}


def map_table(sheet: DataFrame, counts: DataFrame, year: int, file: str) -> dict[str, DataFrame]:
    """The table behind a road map -> checks of its rows -> counts of all directions, each an update or an insert.

    ``sheet``: id_comptag, carto and diffusable (``t``), src, tmja, pc_pl, obs.  ``ecarts``: rows by counter and broken rule; such
    counters have no row in ``comptages``.
    """
    yes = lambda c: F.coalesce(F.col(c) == "t", F.lit(False))
    flags = ck.flags_concordant(sheet, yes("carto"), yes("diffusable"), F.col("src").isNotNull())
    shown = sheet.where(yes("carto"))
    lost = ck.flags_concordant(shown, F.col("tmja").isNull(), F.coalesce(F.col("obs").contains(ye.MISSING), F.lit(False)))
    broken = lambda df, rule: df.select("id_comptag", F.lit(rule).alias("regle"))
    faults = broken(flags, "carto, diffusable et src").union(broken(lost, "mention")).groupBy("id_comptag", "regle").agg(F.count("*").alias("n"))
    kept = ye.map_counts(shown.join(faults, "id_comptag", "left_anti")).withColumns({"annee": F.lit(year), "fichier": F.lit(file)})
    return {"ecarts": faults, "comptages": bu.map_upsert(kept, counts)}
