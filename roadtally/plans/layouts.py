"""Provider deliveries by shape: what to rename, how to make the id, which operators follow.

A layout is data, not code: ``shape_table`` turns a provider's table into the
common columns, whatever the provider.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as fn
from ..operators import checks as ck
from ..operators import hourly as ho
from ..operators import joins as jo
from ..operators import reshape as rs
from ..operators import windows as wi
from ..operators import yearly as ye
from ..schemas import HOURS, INVALID, MONTHS


@dataclass(frozen=True)
class Layout:
    """Columns of a delivery.

    ``names`` maps the provider's to ours; ``marker`` holds ``pr+abs`` text, ``metres`` a distance
    from the start; ``start`` and ``end``, or ``year`` and ISO ``week``, give the period; ``cell``
    holds traffic and share on two lines: rows without marker or traffic are left out.
    """

    names: dict[str, str]
    dep: int | None = None
    marker: str | None = None
    metres: str | None = None
    share_is_ratio: bool = False
    start: str | None = None
    end: str | None = None
    year: str | None = None
    week: str | None = None
    keep_summer: bool = True
    cell: str | None = None
    constants: dict[str, object] = field(default_factory=dict)


def shape_table(df: DataFrame, layout: Layout) -> DataFrame:
    """id_comptag, route, pr, abs, tmja, pc_pl, periode and the constants of the layout."""
    out = df.withColumnsRenamed(layout.names)
    if layout.cell:
        out = out.withColumn("__c", fn.tmja_and_share(F.col(layout.cell))).withColumns({"tmja": F.col("__c.tmja").cast("int"), "pc_pl": F.col("__c.pc_pl")})
        out = out.where((F.col("tmja") > 0) & F.col(layout.marker).isNotNull()).drop("__c")
    if "route" in out.columns:
        out = out.withColumn("route", fn.route_name(F.col("route")))
    place = fn.parse_pr_abs(F.col(layout.marker)) if layout.marker else fn.split_distance(F.col(layout.metres)) if layout.metres else None
    if place is not None:
        out = out.withColumn("__p", place).withColumns({"pr": F.col("__p.pr"), "abs": F.col("__p.abs")}).drop("__p")
    if "id_comptag" not in out.columns:
        dep = F.lit(layout.dep) if layout.dep is not None else F.col("dep")
        out = out.withColumn("id_comptag", fn.id_comptag(dep, F.col("route"), F.col("pr"), F.col("abs")))
    if layout.share_is_ratio:
        out = out.withColumn("pc_pl", fn.ratio_to_percent(F.col("pc_pl")))
    start, end = layout.start, layout.end
    if layout.year and layout.week:
        out = out.withColumn("__w", fn.iso_week(F.col(layout.year), F.col(layout.week)))
        start, end = "__w.debut", "__w.fin"
    if start and end:
        if not layout.keep_summer:
            out = out.where(fn.outside_summer(F.col(start), F.col(end)))
        out = out.withColumn("periode", fn.period_text(F.col(start), F.col(end)))
    out = out.withColumns({k: F.lit(v) for k, v in layout.constants.items()})
    wanted = ["id_comptag", "route", "pr", "abs", "tmja", "pc_pl", "periode", *layout.constants]
    return out.select(*[c for c in wanted if c in out.columns])


@dataclass(frozen=True)
class Monthly:
    """How a delivery spreads values over its columns.

    ``quarters``: t1 to t4; ``periods``: groups of (period, tmja, pc_pl); ``indicators``: columns
    such as ``janv_tmja``; ``vl_pl``: those are light and heavy vehicles.
    """

    quarters: bool = False
    periods: tuple[tuple[str, str, str], ...] = ()
    indicators: tuple[str, ...] = ()
    vl_pl: bool = False


def monthly_table(df: DataFrame, layout: Monthly, keys: Sequence[str]) -> DataFrame:
    """The keys, mois, indicateur, valeur; values that are missing have no row."""
    if layout.quarters:
        return rs.quarter_to_months(df, keys).select(*keys, "mois", F.lit("tmja").alias("indicateur"), F.col("valeur").cast("double").alias("valeur"))
    if layout.periods:
        wide = rs.periods_to_months(df, keys, layout.periods)
    else:
        long = rs.month_prefix(df, keys, [f"{m}_{i}" for m in MONTHS for i in layout.indicators])
        if not layout.vl_pl:
            return long.withColumn("valeur", F.col("valeur").cast("double"))
        one = lambda i: F.sum(F.when(F.col("indicateur") == i, F.col("valeur"))).alias(i)
        wide = ye.vl_pl_to_share(long.groupBy(*keys, "mois").agg(one("vl"), one("pl"))).withColumnRenamed("tv", "tmja")
    wide = wide.withColumns({c: F.col(c).cast("double") for c in ("tmja", "pc_pl")})
    return wide.unpivot([*keys, "mois"], ["tmja", "pc_pl"], "indicateur", "valeur").where("valeur is not null")


def day_blocks(sheets: DataFrame, start: int, step: int) -> DataFrame:
    """Sheets of a direction each, in blocks of a day: total, heavy total and share of each counter-day.

    ``sheets``: id_comptag, jour0 (the first block's day), file, line, col, value.
    """
    blocks = rs.daily_blocks(sheets, start, step)
    of = sheets.select("file", "id_comptag", "jour0").distinct()
    days = blocks.join(of, "file").withColumn("jour", F.date_add("jour0", F.col("bloc")))
    kinds = F.explode(F.array(F.struct(F.lit("VL").alias("type_veh"), (F.col("tv") - F.col("pl")).alias("v")), F.struct(F.lit("PL").alias("type_veh"), F.col("pl").alias("v"))))
    long = days.select("id_comptag", "jour", "heure", F.col("file").alias("fichier"), kinds.alias("k")).select("id_comptag", "jour", "heure", "fichier", "k.type_veh", F.col("k.v").alias("valeur"))
    wide = rs.hour_pivot(long, ["id_comptag", "jour", "fichier"])
    # both directions, each in a file of its own; TV holds all vehicles already
    total = ho.two_files_sum(wide.where("indicateur = 'TV'"), ("id_comptag", "jour")).select("id_comptag", "jour", "tv", "fichiers")
    heavy = ho.two_files_sum(wide.where("indicateur = 'PL'"), ("id_comptag", "jour")).select("id_comptag", "jour", "pl")
    return total.join(heavy, ["id_comptag", "jour"]).withColumn("pc_pl", F.round(F.try_divide(F.col("pl"), F.col("tv")) * 100, 2))


def monthly_sheets(lines: DataFrame, sheet: Sequence[str] = ("feuille",)) -> DataFrame:
    """Sheets on which a road's line and a marker's line take turns: the sheet, id_comptag, mois, indicateur, valeur, obs.

    ``lines``: the sheet, ligne, intitule (the département, on lines of a road), route (a road, or a marker
    ``pr+abs``), annuel (a share is below 1), and a column a month.  A line without road has that of the line
    before, one without marker that of the next.  Four lines are two directions, whose traffic is added up; two
    are one, whose traffic is doubled with a remark; other numbers give no traffic.  Shares are averaged over the
    directions, a missing one counting as the invalid number; what isn't positive then has no row.
    """
    marker = F.col("route").contains("+")
    named = lines.withColumns({"__pr": F.when(marker, F.regexp_replace("route", " ", "")), "__voie": F.when(~marker, fn.route_name(F.col("route"))), "__dep": F.when(~marker, F.col("intitule").try_cast("int").cast("string"))})
    full = wi.fill_back(wi.fill_forward(named, sheet, "ligne", "__voie", "__dep"), sheet, "ligne", "__pr")
    placed = full.select(*sheet, F.concat_ws("-", "__dep", "__voie", "__pr").alias("id_comptag"), fn.row_kind(F.col("annuel")).alias("kind"), *[F.col(m).cast("double") for m in MONTHS])
    long = placed.unpivot([*sheet, "id_comptag", "kind"], MONTHS, "mois", "v")
    of = lambda kind, v: F.when(F.col("kind") == kind, v)
    g = long.groupBy(*sheet, "id_comptag", "mois").agg(F.count("*").alias("n"), F.sum(of("tmja", F.col("v"))).alias("s"), F.avg(of("pc_pl", F.coalesce("v", F.lit(float(INVALID))))).alias("p"))
    total = F.when(F.col("n") == 4, F.nullif(F.col("s"), F.lit(0.0))).when(F.col("n") == 2, 2 * F.col("s"))
    wide = g.select(*sheet, "id_comptag", "mois", "n", total.cast("long").cast("double").alias("tmja"), F.when(F.col("p") > 0, F.round(F.col("p") * 100, 2)).alias("pc_pl"))
    out = wide.unpivot([*sheet, "id_comptag", "mois", "n"], ["tmja", "pc_pl"], "indicateur", "valeur").where("valeur is not null")
    return out.withColumn("obs", F.when((F.col("n") == 2) & (F.col("indicateur") == "tmja"), "1 seul sens *2")).drop("n")


def hourly_sheets(lines: DataFrame, known: DataFrame, most_zeros: int = 8, share: float = 0.5, titles: int = 4, stop: str = "Moyenne Jours") -> dict[str, DataFrame]:
    """Hourly sheets of loops: ``horaire`` (feuille, id_comptag, jour, indicateur, 24 columns) and ``rejets`` (feuille, motif).

    ``lines``: feuille, ligne, cells.  Line 0 names the lane and the loop, line ``titles`` the hours (``7-8h``, in any order) from
    the third cell on; after it day, vehicle and hours, the day on its first line only, up to an empty line and that of the
    means.  ``known``: cle1 (loop), cle2 (lane), id_comptag; a loop that isn't known is looked up by its lane.
    Sheets of unknown loops, and those with too many nulls or zeros, are refused as a whole.
    """
    cell = lambda k: F.get("cells", F.lit(k))
    on = lambda line, c: F.max(F.when(F.col("ligne") == line, c))
    heads = lines.where(F.col("ligne").isin(0, titles) | (cell(0) == stop))  # only these lines are grouped
    sheets = heads.groupBy("feuille").agg(on(0, cell(0)).alias("voie"), on(0, cell(1)).alias("boucle"), on(titles, F.col("cells")).alias("titres"), F.min(F.when(cell(0) == stop, F.col("ligne"))).alias("fin"))
    # where each hour stands, found once a sheet
    sheets = sheets.withColumn("rang", F.array(*[F.array_position("titres", f"{h}-{h + 1}h").cast("int") for h in range(24)]))
    sheets = jo.fallback_key(sheets, known.withColumn("cle2", F.replace("cle2", F.lit("_"), F.lit(" "))), F.col("boucle"), F.replace("voie", F.lit("_"), F.lit(" ")), "id_comptag")
    rows = lines.join(sheets.where("id_comptag is not null").select("feuille", "id_comptag", "rang", "fin"), "feuille").where((F.col("ligne") > titles) & (F.col("ligne") < F.col("fin") - 1))
    hours = [F.get("cells", F.get("rang", F.lit(h)) - 1).try_cast("double").alias(c) for h, c in enumerate(HOURS)]
    days = rows.select("feuille", "id_comptag", "ligne", cell(0).try_cast("date").alias("jour"), cell(1).alias("indicateur"), *hours)
    days = wi.fill_forward(days, ["feuille"], "ligne", "jour").drop("ligne").withColumn("sens", F.lit(1))
    good = ck.invalid_sheets(days, most_zeros, share, key=("feuille",)).drop("sens")
    bad = days.select("feuille").distinct().join(good.select("feuille").distinct(), "feuille", "left_anti")
    unknown = sheets.where("id_comptag is null").select("feuille", F.lit("boucle inconnue").alias("motif"))
    return {"horaire": good, "rejets": unknown.unionByName(bad.withColumn("motif", F.lit("trop de nuls ou de zeros")))}


def zones_by_year(points: DataFrame, since: int = 2010, span: tuple[int, int] = (2015, 2020), city: str = "LimMet") -> DataFrame:
    """Counts of a city by zone: one row a zone and year, years before ``since`` as ``autr`` (the latest of them).

    ``points``: id, zone, type (Double, Simple, Detecteur), x, y, annee, debut, tmja, pc_pl, voie.  A double point stands
    for its zone; without one the simple ones, or a detector where there is nothing else.  Simple points at two positions
    are the two directions: traffic added up by year, shares averaged, the place halfway, ``fictif``.  Otherwise a year's
    highest count stays, of equal ones the later.  Zones with more positions have no row.  ``type_poste``: permanent
    with every year of ``span``, tournant with three of them.
    """
    one = points.groupBy("zone", "type", "x", "y").agg(F.lit(1).alias("k"))
    n = lambda kind: F.count_if(F.col("type") == kind).alias(kind)
    at = one.groupBy("zone").agg(n("Double"), n("Simple"), n("Detecteur"), F.count("*").alias("n"))
    mixed = F.col("Simple") < F.col("n")
    case = (
        F.when(F.col("Double") > 0, "double")
        .when(F.col("Simple").isin(1, 2), F.concat(F.when(mixed, "mixte ").otherwise("simple "), F.col("Simple").cast("string")))
        .when((F.col("Detecteur") == 1) & (F.col("n") == 1), "detecteur")
    )
    case_of = at.select("zone", case.alias("cas")).where("cas is not null")
    kind = F.when(F.col("cas") == "double", "Double").when(F.col("cas") == "detecteur", "Detecteur").otherwise("Simple")
    used = points.join(case_of, "zone").where(F.col("type") == kind)
    pair, place = F.col("cas").isin("simple 2", "mixte 2"), F.struct("x", "y")
    year = used.groupBy("zone", "cas", "annee").agg(
        F.sum("tmja").alias("s"), F.avg("pc_pl").alias("p"), F.max(F.struct("tmja", "debut", "id", "pc_pl")).alias("m"),
        F.min(place).alias("a"), F.max(place).alias("b"), F.min("voie").alias("voie"),
    )
    known = F.when(F.col("annee").between(*span) & F.col("s").isNotNull(), F.col("annee"))
    zone = year.groupBy("zone").agg(F.min("a").alias("za"), F.max("b").alias("zb"), F.min("voie").alias("zv"), F.countDistinct(known).alias("ans"))
    rows = year.select("zone", "cas", "annee", F.when(pair, F.col("s")).otherwise(F.col("m.tmja")).cast("long").alias("tmja"), F.round(F.when(pair, F.col("p")).otherwise(F.col("m.pc_pl")), 4).alias("pc_pl"))
    label = F.when(F.col("annee") < since, "autr").otherwise(F.col("annee").cast("string"))
    rows = rows.groupBy("zone", "cas", label.alias("periode")).agg(F.max("annee").alias("annee"), F.max_by(F.struct("tmja", "pc_pl"), "annee").alias("v"))
    middle = lambda c: F.when(pair, (F.col(f"za.{c}") + F.col(f"zb.{c}")) / 2).otherwise(F.col(f"za.{c}"))
    out = rows.join(zone, "zone").withColumns({"x": middle("x"), "y": middle("y"), "type_poste": F.when(F.col("ans") == span[1] - span[0] + 1, "permanent").when(F.col("ans") >= 3, "tournant").otherwise("ponctuel")})
    ident = F.concat(F.lit(f"{city}-"), F.coalesce(F.lower("zv"), F.lit("??")), F.format_string("-%.3f;%.3f", "x", "y"))
    return out.select("zone", ident.alias("id_comptag"), "cas", pair.alias("fictif"), "x", "y", "type_poste", "periode", "annee", "v.tmja", "v.pc_pl")


#: One layout for each shape of annual delivery.
ANNUAL_BY_MARKER = Layout({"axe": "route", "trafic": "tmja", "part_pl": "pc_pl"}, marker="localisation", constants={"type_veh": "TV"})
ANNUAL_BY_METRES = Layout({"axe": "route", "trafic": "tmja", "part_pl": "pc_pl"}, metres="distance", share_is_ratio=True)
ONE_OFF_COUNTS = Layout({"axe": "route", "trafic": "tmja", "part_pl": "pc_pl"}, marker="localisation", start="debut", end="fin", keep_summer=False, constants={"type_poste": "ponctuel"})
BY_ISO_WEEK = Layout({"axe": "route", "trafic": "tmja", "part_pl": "pc_pl"}, marker="localisation", year="annee", week="semaine", constants={"type_poste": "tournant"})

ANNUAL_CELLS = Layout({"rd": "route"}, marker="p_r", cell="cellule", constants={"type_poste": "tournant"})

#: And one for each way of giving months.
QUARTERS = Monthly(quarters=True)
FOUR_PERIODS = Monthly(periods=tuple((f"periode_{k}", f"tmja_{k}", f"pc_pl_{k}") for k in range(1, 5)))
TWELVE_MONTHS = Monthly(indicators=("tmja", "pc_pl"))
LIGHT_AND_HEAVY_MONTHS = Monthly(indicators=("vl", "pl"), vl_pl=True)
