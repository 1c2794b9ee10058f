"""Data-quality checks.  A check returns a table: what it found, or the rows that pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..schemas import HOURS, INVALID


class CheckFailed(ValueError):
    """An assertion on a table doesn't hold."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table itself; raises when a required column is missing.  Looks at the schema only."""
    if missing := [c for c in columns if c not in df.columns]:
        raise CheckFailed(f"missing columns: {', '.join(missing)}")
    return df


def values_outside(df: DataFrame, column: str, allowed: Sequence) -> DataFrame:
    """Each value that isn't allowed (null included) and its number of rows."""
    return df.where(F.col(column).isNull() | ~F.col(column).isin(list(allowed))).groupBy(column).agg(F.count("*").alias("n"))


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the number of nulls of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, and how often."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def class_sizes(df: DataFrame, column: str) -> DataFrame:
    """Rows of each class, their share, and the whole: a split that loses rows shows here."""
    sizes = df.groupBy(column).agg(F.count("*").alias("n"))
    return sizes.withColumn("total", F.sum("n").over(Window.partitionBy(F.lit(0))))  # a row a class


def join_cardinality(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """What a left join on the key would do to the left rows: kept, unmatched, multiplied."""
    n = right.groupBy(key).agg(F.count("*").alias("__n"))
    j = left.join(n, key, "left")
    return j.agg(F.count("*").alias("left_rows"), F.count_if(F.col("__n").isNull()).alias("unmatched"), F.count_if(F.col("__n") > 1).alias("multiplied"), F.sum(F.coalesce("__n", F.lit(1))).alias("joined_rows"))


def years_outside(df: DataFrame, column: str = "annee", after: int = 2000, last: int | None = None, unknown: Sequence[int] = (1900,)) -> DataFrame:
    """Years that no count can have, and their rows: up to ``after``, or past ``last`` (the current year); ``unknown`` stands for no year."""
    year = F.col(column)
    upto = F.year(F.current_date()) if last is None else F.lit(last)
    return df.where(~year.isin(list(unknown)) & ((year <= after) | (year > upto))).groupBy(column).agg(F.count("*").alias("n"))


def group_over(df: DataFrame, key: Sequence[str], most: int) -> DataFrame:
    """Groups with more than ``most`` rows."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > most)


def flags_concordant(df: DataFrame, *flags: Column) -> DataFrame:
    """Rows on which the flags disagree."""
    same = reduce(lambda a, b: a & b, [flags[0] == f for f in flags[1:]])
    return df.where(~same)


def _hours(hours: Sequence[str]) -> tuple[Column, Column]:
    """Whether an hour is null, and the number of hours at zero."""
    values = F.array(*[F.col(h) for h in hours])
    return F.exists(values, lambda v: v.isNull()), F.size(F.filter(values, lambda v: v == 0))


def bad_hour(hours: Sequence[str], most_zeros: int) -> Column:
    """A null hour, or more hours at zero than allowed."""
    null, zeros = _hours(hours)
    return null | (zeros > most_zeros)


def invalid_days(df: DataFrame, most_zeros: int = 8, hours: Sequence[str] = HOURS) -> tuple[DataFrame, DataFrame]:
    """(kept, removed): a bad row removes all rows of its day and counter."""
    bad = df.where(bad_hour(hours, most_zeros)).select("jour", "id_comptag").distinct()
    return df.join(bad, ["jour", "id_comptag"], "left_anti"), df.join(bad, ["jour", "id_comptag"], "left_semi")


def invalid_sheets(df: DataFrame, most_zeros: int = 8, share: float = 0.5, key: Sequence[str] = ("id_comptag",), hours: Sequence[str] = HOURS) -> DataFrame:
    """Rows of keys none of whose sheets (direction and indicator) is bad.

    A sheet is bad when more than ``share`` of its days have a null hour, or
    when more than ``share`` have too many zeros; the two are not added up.
    """
    null, zeros = _hours(hours)
    part = lambda c: F.avg(c.cast("int"))
    bad = df.groupBy(*key, "sens", "indicateur").agg(part(null).alias("__null"), part(zeros > most_zeros).alias("__zeros"))
    bad = bad.where((F.col("__null") > share) | (F.col("__zeros") > share))
    return df.join(bad.select(*key).distinct(), list(key), "left_anti")


def min_days(df: DataFrame, days: int, id_col: str = "id_comptag", day_col: str = "jour") -> DataFrame:
    """Rows of counters with at least so many distinct days."""
    enough = df.groupBy(id_col).agg(F.countDistinct(day_col).alias("n")).where(F.col("n") >= days)
    return df.join(enough.select(id_col), id_col, "left_semi")


def enough_days(df: DataFrame, id_col: str = "id_comptag", ts: str = "date_heure") -> DataFrame:
    """More than 8 days are enough; 8 are when the last clock time is not before the first.

    ``jours_pleins``: the full days that a refusal reports, null where the days
    are enough: 8 without overlap are 6, 7 are 6, fewer are as many as they are.
    ``qualite``: the note 1 of a count that is kept with a message only.
    """
    g = df.groupBy(id_col).agg(F.countDistinct(F.to_date(ts)).alias("jours"), F.min(ts).alias("first"), F.max(ts).alias("last"))
    clock = lambda c: F.date_format(c, "HH:mm:ss")
    ok = F.when(F.col("jours") > 8, True).when(F.col("jours") == 8, clock("first") <= clock("last")).otherwise(False)
    full = F.when(~ok, F.when(F.col("jours") == 8, 6).when(F.col("jours") == 7, 6).otherwise(F.col("jours")))
    return g.select(id_col, "jours", ok.alias("suffisant"), full.cast("long").alias("jours_pleins"), F.when(~ok, 1).alias("qualite"))


#: Names of main lanes, as ``lane_key`` writes them; all others are ramps or unknown.
MAIN_LANES = ("sens1", "sens2", "deportsens1", "deportsens2", "sensexter", "sensinter", "sens1n137", "sens2n137", "sens1n11", "sens2n11", "sens1n10", "sens2n10", "sens1n141", "sens2n141")


def lane_key(lane: Column) -> Column:
    """A lane's name in lower case without spaces, underscores and accents."""
    return F.translate(F.regexp_replace(F.lower(lane), "[ _]", ""), "éèêç", "eeec")


def main_lane(lane: Column) -> Column:
    return F.coalesce(lane_key(lane).isin(*MAIN_LANES), F.lit(False))


def _lone(rows: Column, vl: Column, pl: Column) -> Column:
    """A day with one VL and one PL row and nothing else lacks a direction."""
    return (rows == 2) & (vl == 1) & (pl == 1)


def two_directions_present(df: DataFrame, lane: str | None = None) -> DataFrame:
    """Drops counter-days that consist of one VL and one PL row only: one direction is missing.

    With ``lane``, a column of lane names, only rows of main lanes are looked at;
    a day that is dropped goes with its ramps.
    """
    seen = df if lane is None else df.where(main_lane(F.col(lane)))
    lone = seen.groupBy("jour", "id_comptag").agg(F.count("*").alias("n"), F.count_if(F.col("indicateur") == "VL").alias("vl"), F.count_if(F.col("indicateur") == "PL").alias("pl"))
    lone = lone.where(_lone(F.col("n"), F.col("vl"), F.col("pl")))
    return df.join(lone, ["jour", "id_comptag"], "left_anti")


#: What a counter says of its directions.
TWO_WAY, ONE_WAY = "double sens", "sens unique"


def day_flags(df: DataFrame, most_zeros: int = 8, factor: float = 3, declared: Column | None = None, lane: str | None = None) -> DataFrame:
    """One row for each counter and day, from one pass over the hourly rows, on which all rules of a delivery can be decided.

    invalide (an hour is null or too many are zero, of any lane), seul (a
    direction is missing), couples (indicators with two directions), ecarts (those
    of which one is above ``factor`` times the other), sens (the directions),
    declare.  With ``lane``, directions are the names of main lanes.
    """
    side = F.col("sens" if lane is None else lane)
    main = F.lit(True) if lane is None else main_lane(side)
    total = sum((F.coalesce(F.col(h), F.lit(0.0)) for h in HOURS), F.lit(0.0))
    n = F.count_if(F.col("__main")).alias("n")
    rows = df.select("id_comptag", "jour", "indicateur", side.alias("s"), bad_hour(HOURS, most_zeros).alias("bad"), main.alias("__main"), total.alias("t"), (F.lit(TWO_WAY) if declared is None else declared).alias("d"))
    sides = rows.groupBy("id_comptag", "jour", "indicateur", "s").agg(F.sum(F.when(F.col("__main"), F.col("t"))).alias("t"), n, F.bool_or("bad").alias("bad"), F.max(F.when(F.col("__main"), F.col("d"))).alias("d"))
    kinds = sides.groupBy("id_comptag", "jour", "indicateur").agg(F.count_if(F.col("n") > 0).alias("k"), F.max("t").alias("most"), F.min("t").alias("least"), F.sum("n").alias("n"), F.bool_or("bad").alias("bad"), F.collect_set(F.when(F.col("n") > 0, F.col("s"))).alias("s"), F.max("d").alias("d"))
    both = F.col("k") == 2
    of = lambda kind: F.sum(F.when(F.col("indicateur") == kind, F.col("n")).otherwise(0))
    return kinds.groupBy("id_comptag", "jour").agg(
        F.coalesce(F.bool_or("bad"), F.lit(False)).alias("invalide"), _lone(F.sum("n"), of("VL"), of("PL")).alias("seul"), F.count_if(both).alias("couples"),
        F.count_if(both & (F.col("most") > factor * F.col("least"))).alias("ecarts"), F.array_distinct(F.flatten(F.collect_list("s"))).alias("sens"), F.max("d").alias("declare"),
    )


def _state(sides: Column, declared: Column, couples: Column, flagged: Column, error_rate: float) -> Column:
    return (
        F.when((sides == 2) & (declared == TWO_WAY), F.when(flagged > couples / error_rate, "asymetrique").otherwise("ok"))
        .when((sides == 2) & (declared == ONE_WAY), "sens unique a deux sens").when((sides == 1) & (declared == ONE_WAY), "ok").when((sides == 1) & (declared == TWO_WAY), "double sens a un seul sens").otherwise("cas non prevu")
    )


def direction_asymmetry(df: DataFrame, factor: float = 3, error_rate: float = 10, declared: Column | None = None, lane: str | None = None) -> DataFrame:
    """Per counter: days with both directions, flagged days, the state, and whether it is refused.

    A day is flagged when one direction is above ``factor`` times the other;
    too many flagged days are asymmetric.  ``declared`` (two-way where it isn't
    given) must agree with the directions found: one-way with two directions,
    two-way with one, and any other number are refused; one-way with one is not
    compared.  With ``lane``, directions are the names of main lanes, ramps are
    left out, and a counter without a main lane has no row.
    """
    days = day_flags(df if lane is None else df.where(main_lane(F.col(lane))), factor=factor, declared=declared, lane=lane)
    g = days.groupBy("id_comptag").agg(F.sum("couples").alias("jours"), F.sum("ecarts").alias("ecarts"), F.size(F.array_distinct(F.flatten(F.collect_set("sens")))).alias("n"), F.max("declare").alias("d"))
    state = _state(F.col("n"), F.col("d"), F.col("jours"), F.col("ecarts"), error_rate)
    return g.select("id_comptag", "jours", "ecarts", state.alias("etat"), (state != "ok").alias("rejete"))


def verdicts(days: DataFrame, least_days: int = 7, error_rate: float = 10) -> DataFrame:
    """What ``day_flags`` say of each counter: invalides (days removed), jours (days left), etat of its directions, accepte."""
    good = ~F.col("invalide") & ~F.col("seul")
    over = lambda c: F.sum(F.when(good, F.col(c)).otherwise(0))
    g = days.groupBy("id_comptag").agg(F.count_if("invalide").alias("invalides"), F.count_if(good).alias("jours"), over("couples").alias("c"), over("ecarts").alias("e"), F.size(F.array_distinct(F.flatten(F.collect_set(F.when(good, F.col("sens")))))).alias("n"), F.max("declare").alias("d"))
    g = g.withColumn("etat", F.when(F.col("jours") > 0, _state(F.col("n"), F.col("d"), F.col("c"), F.col("e"), error_rate)))
    return g.select("id_comptag", "invalides", "jours", "etat", ((F.col("etat") == "ok") & (F.col("jours") >= least_days)).alias("accepte"))


def reasons(verdict: DataFrame) -> DataFrame:
    """A row for each thing to say of a counter: days that were removed, directions that were refused, accepted."""
    why = F.array(F.when(F.col("invalides") > 0, "jours invalides"), F.when(F.col("etat") != "ok", "asymetrie"), F.when(F.col("accepte"), "accepte"))
    return verdict.select("id_comptag", F.explode(F.filter(why, lambda r: r.isNotNull())).alias("reason"))


def watch(df: DataFrame, rules: dict[str, Column]) -> tuple[DataFrame, Observation]:
    """The same rows, and how many of them break each rule, counted by the job that first goes through them.

    A rule is a condition that no row should meet; a null condition isn't met.
    """
    seen = Observation()
    return df.observe(seen, *[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()]), seen


def monthly_pairs(df: DataFrame) -> DataFrame:
    """Long monthly rows (sens, indicateur, mois, valeur), and the case of their counter-year.

    Two directions of two indicators: a month that one direction lacks is
    invalid in both.  One or two rows of months: what is missing is invalid.
    Other numbers are left as they are and reported.
    """
    key = ["id_comptag", "annee"]
    rows = df.groupBy(*key).agg(F.countDistinct("sens", "indicateur").alias("__rows"))
    months = df.groupBy(*key, "indicateur", "mois").agg(F.count("valeur").alias("__there"))
    j = df.join(rows, key).join(months, [*key, "indicateur", "mois"])
    case = F.when(F.col("__rows") == 4, "deux sens").when(F.col("__rows") <= 2, "un sens").otherwise("non prevu")
    value = F.when(case == "deux sens", F.when(F.col("__there") < 2, INVALID).otherwise(F.col("valeur"))).when(case == "un sens", F.coalesce("valeur", F.lit(INVALID))).otherwise(F.col("valeur"))
    return j.select(*[c for c in df.columns if c != "valeur"], value.alias("valeur"), case.alias("cas"))


def outlier_hours(long: DataFrame, keys: Sequence[str] = ("id_comptag", "indicateur", "weekend", "heure")) -> DataFrame:
    """Marks hours below the mean by more than two standard deviations of their group (null keys have no group)."""
    low = long.groupBy(*keys).agg((F.avg("valeur") - 2 * F.stddev_samp("valeur")).alias("__low"))
    j = long.join(low, list(keys), "left")
    return j.select(*[c for c in long.columns], F.when(F.col("valeur") < F.col("__low"), INVALID).otherwise(F.col("valeur")).alias("corrige"))


def annual_vs_monthly(annual: DataFrame, monthly: DataFrame, key: Sequence[str], most_gap: float = 5.0, most_points: float = 1.0) -> DataFrame:
    """Annual tmja and share against the months'; the monthly share is weighted by traffic."""
    m = monthly.groupBy(*key).agg(F.avg("tmja").alias("tmja_mensuel"), (F.sum(F.col("tmja") * F.col("pc_pl")) / F.sum("tmja")).alias("pc_pl_mensuel"))
    j = annual.join(m, list(key))
    gap = F.abs(F.col("tmja") - F.col("tmja_mensuel")) / F.col("tmja_mensuel") * 100
    points = F.abs(F.col("pc_pl") - F.col("pc_pl_mensuel"))
    verdict = lambda c, most: F.when(c <= most, "OK").otherwise("KO")
    return j.select(*key, "tmja", "tmja_mensuel", gap.alias("ecart_tmja"), verdict(gap, most_gap).alias("etat_tmja"), "pc_pl", "pc_pl_mensuel", points.alias("ecart_pc_pl"), verdict(points, most_points).alias("etat_pc_pl"))


#: Codes that mark a broken record of a calibrated counter.
BAD_ADVICE, BAD_LENGTH, BAD_SPEED, ZERO_CODE = 114870, 30000, 50000, 182


def vehicle_outliers(df: DataFrame) -> DataFrame:
    """The list of what is wrong with each vehicle row."""
    tags = F.array(
        F.when(F.col("AdviceCode") == BAD_ADVICE, "adviceCode"), F.when(F.col("Length") >= BAD_LENGTH, "longueur"),
        F.when(F.col("Speed") >= BAD_SPEED, "vitesse"), F.when((F.col("Length") == ZERO_CODE) | (F.col("Speed") == ZERO_CODE), "value0"),
    )
    return df.withColumn("fail", F.filter(tags, lambda t: t.isNotNull()))


#: The remarks of the two notes, by note.
BROKEN_NOTES = {
    1: "plus de 30% de valeur de longueur ou de vitesse aberrantes ou a 0, ou d'adviceCode speciaux",
    2: "entre 10% et 30% de valeur de longueur ou de vitesse aberrantes ou a 0, ou d'adviceCode speciaux",
    3: "moins de 10% de valeur de longueur ou de vitesse aberrantes ou a 0, ou d'adviceCode speciaux",
}
DIRECTION_NOTES = {1: "0 ou plus de 2 sens, peu importe le nom", 2: "1 ou 2 sens, certains ou tous non nommés", 3: "1 ou 2 sens nommé"}


def vehicle_quality_note(df: DataFrame, key: str, direction: Column, direction_name: Column) -> DataFrame:
    """Two notes of each file, the final one, and its remark.

    Broken rows: 1 from 30 % on, 2 above 10 %, else 3.  Directions: 3 when there
    are one or two and all are named, 2 when a name is missing, 1 for any other
    number.  Final: 1 if either is 1, 2 if they differ, else the common one.
    """
    g = df.groupBy(key).agg(F.avg((F.size("fail") > 0).cast("int")).alias("part"), F.countDistinct(direction).alias("n"), F.count_if(direction.isNotNull() & direction_name.isNull()).alias("unnamed"))
    broken = F.when(F.col("part") >= 0.3, 1).when(F.col("part") > 0.1, 2).otherwise(3)
    sides = F.when(~F.col("n").isin(1, 2), 1).when(F.col("unnamed") > 0, 2).otherwise(3)
    final = F.when((broken == 1) | (sides == 1), 1).when(broken != sides, 2).otherwise(broken)
    text = lambda note, texts: F.element_at(F.array(*[F.lit(texts[k]) for k in (1, 2, 3)]), note)
    return g.select(key, "part", final.alias("qualite"), F.concat_ws(" ; ", text(broken, BROKEN_NOTES), text(sides, DIRECTION_NOTES)).alias("commentaire"))


def files_accounted(listed: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Listed files that no point uses."""
    return listed.join(used, key, "left_anti")


def station_count(df: DataFrame, file: str, station: str) -> DataFrame:
    n = F.countDistinct(station)
    return df.groupBy(file).agg(n.alias("n"), F.when(n == 0, "aucune").when(n == 1, "une").otherwise("plusieurs").alias("stations"))


def report(accepted: DataFrame, rejected: dict[str, DataFrame], key: str) -> DataFrame:
    """Accepted keys, and rejected ones with the reason of each check that refused them."""
    rows = [accepted.select(key, F.lit("accepte").alias("reason")).distinct()]
    rows += [df.select(key, F.lit(reason).alias("reason")).distinct() for reason, df in rejected.items()]
    return reduce(DataFrame.unionByName, rows)
