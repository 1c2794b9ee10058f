"""Column -> Column functions.  All are built-in expressions; none is a Python UDF."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import HEAVY_LIMIT, HOLIDAYS, INVALID, MONTHS, SPEED_LIMITS


def normalise_label(c: Column) -> Column:
    """Lower case, without accents, spaces, ``_`` and ``-``."""
    return F.regexp_replace(F.translate(F.lower(c), "éèêç", "eeec"), "[ _-]", "")


def normalise_columns(df: DataFrame) -> DataFrame:
    """Column names in lower case, without accents, space as ``_`` and ``%`` as ``pc_``."""
    plain = str.maketrans("éèêàçù", "eeeacu")
    return df.toDF(*[n.lower().translate(plain).replace("%", "pc_").replace(" ", "_") for n in df.columns])


def route_name(c: Column) -> Column:
    """Letters and number of a road, upper case, without spaces and leading zeros; RN is N, RD is D."""
    plain = F.upper(F.regexp_replace(c, r"[\s_-]", ""))
    return F.regexp_replace(F.regexp_replace(plain, r"^R(?=[ND]\d)", ""), r"^([A-Z]+)0+(?=\d)", "$1")


def id_comptag(dep: Column, route: Column, pr: Column, abs_: Column) -> Column:
    return F.concat(dep.cast("string"), F.lit("-"), route, F.lit("-"), pr.cast("string"), F.lit("+"), abs_.cast("string"))


def id_comptag_city(city: Column, street: Column, lon: Column, lat: Column) -> Column:
    """``City-street-lon;lat`` with four decimals; separators inside the names become ``_``."""
    name = lambda c: F.regexp_replace(c, r"[ \-;,_]+", "_")
    return F.concat(name(city), F.lit("-"), name(street), F.lit("-"), F.format_string("%.4f;%.4f", lon, lat))


def coords_from_id(c: Column) -> Column:
    """lon, lat of a city id; a third dash is the sign of the longitude."""
    dashes = F.length(c) - F.length(F.replace(c, F.lit("-"), F.lit("")))
    lon = F.regexp_extract(c, r"-(\d+\.?\d*);", 1).cast("double")
    return F.struct(F.when(dashes >= 3, -lon).otherwise(lon).alias("lon"), F.regexp_extract(c, r";(-?\d+\.?\d*)$", 1).cast("double").alias("lat"))


def parse_pr_abs(c: Column, digits: int = 4) -> Column:
    """``12+345``, ``12.3`` or ``12,3``: marker, and metres with the decimals padded on the right."""
    pr, rest = F.regexp_extract(c, r"^\s*(\d+)", 1), F.regexp_extract(c, r"[+.,](\d+)\s*$", 1)
    plus = c.contains("+")
    metres = F.when(rest == "", "0").when(plus, rest).otherwise(F.rpad(rest, digits, "0"))
    return F.struct(F.nullif(pr, F.lit("")).cast("int").alias("pr"), metres.cast("int").alias("abs"))


def split_distance(metres: Column) -> Column:
    """A cumulative distance as marker and metres."""
    return F.struct(F.floor(metres / 1000).cast("int").alias("pr"), (metres % 1000).cast("int").alias("abs"))


def pr_from_filename(c: Column) -> Column:
    """Road, marker and metres of a name such as ``D12_PR3+450.txt``."""
    part = lambda k: F.regexp_extract(c, r"(?i)(R?[ND]\d+[A-Z]?)[ _-]+PR\s*(\d+)\+(\d+)", k)
    return F.struct(F.nullif(route_name(part(1)), F.lit("")).alias("route"), F.nullif(part(2), F.lit("")).cast("int").alias("pr"), F.nullif(part(3), F.lit("")).cast("int").alias("abs"))


def number_fr(c: Column) -> Column:
    """``12,5%`` as 12.5; anything else is null."""
    return F.regexp_replace(F.translate(F.regexp_replace(c, r"[\s%]", ""), ",", "."), r"^$", "x").try_cast("double")


def tmja_and_share(c: Column) -> Column:
    """A cell ``1234\\n5,6%``: count and share; an empty or crossed-out share is 0."""
    return F.struct(number_fr(F.split_part(c, F.lit("\n"), F.lit(1))).alias("tmja"), F.coalesce(number_fr(F.split_part(c, F.lit("\n"), F.lit(2))), F.lit(0.0)).alias("pc_pl"))


def row_kind(value: Column) -> Column:
    return F.when(value < 1, "pc_pl").otherwise("tmja")


def ratio_to_percent(value: Column) -> Column:
    return F.when(value < 1, value * 100).otherwise(value)


def period_text(start: Column, end: Column) -> Column:
    """``YYYY/MM/DD-YYYY/MM/DD``; an unknown side is ``??``; both unknown: null."""
    side = lambda c: F.coalesce(F.date_format(c, "yyyy/MM/dd"), F.lit("??"))
    return F.when(start.isNull() & end.isNull(), F.lit(None)).otherwise(F.concat(side(start), F.lit("-"), side(end)))


def period_join(*periods: Column) -> Column:
    return F.array_join(F.filter(F.array(*periods), lambda p: p.isNotNull()), " ; ")


DAY = r"\d{4}/(0[1-9]|1[0-2])/(0[1-9]|[12]\d|3[01])"


def period_valid(c: Column) -> Column:
    return F.coalesce(c.rlike(f"^{DAY}-{DAY}( ; {DAY}-{DAY})*$"), F.lit(False))


def period_parts(c: Column) -> Column:
    """Array of (start, end) of a period text."""
    day = lambda p, k: F.try_to_timestamp(F.split_part(p, F.lit("-"), F.lit(k)), F.lit("yyyy/MM/dd")).cast("date")
    return F.transform(F.split(c, r" *; *"), lambda p: F.struct(day(p, 1).alias("debut"), day(p, 2).alias("fin")))


def iso_week(year: Column, week: Column) -> Column:
    """Monday and Sunday of an ISO week."""
    monday = F.date_add(F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week"), (7 * (week - 1)).cast("int"))
    return F.struct(monday.alias("debut"), F.date_add(monday, 6).alias("fin"))


def major_month(df: DataFrame, key: str, start: str, end: str) -> DataFrame:
    """The month that holds most days of a period; the earlier one when they tie."""
    days = df.select(key, F.explode(F.sequence(F.col(start), F.col(end))).alias("day")).groupBy(key, F.trunc("day", "month").alias("month")).count()
    return days.groupBy(key).agg(F.max_by(F.col("month"), F.struct(F.col("count"), -F.unix_date("month"))).alias("month"))


def overlaps_holidays(start: Column, end: Column) -> Column:
    """The calendar is a short constant list, so the test is one expression without a join."""
    spans = [(start <= F.lit(b).cast("date")) & (end >= F.lit(a).cast("date")) for a, b in HOLIDAYS]
    return reduce(lambda x, y: x | y, spans)


def outside_summer(start: Column, end: Column) -> Column:
    """Keep unless it starts or ends in July or August; unknown dates do not count."""
    return ~F.coalesce(F.month(start).isin(7, 8), F.lit(False)) & ~F.coalesce(F.month(end).isin(7, 8), F.lit(False))


def vehicle_class(silhouette: Column) -> Column:
    return F.when(silhouette.isin(1, 12), "VL").when(silhouette == 13, "2R").otherwise("PL")


def vehicle_class_length(length: Column) -> Column:
    return F.when(length.isNull() | (length < 7.2), "VL").otherwise("PL")


def vehicle_class_ser(kind: Column, ser: Column, heavy_from: Column, two_wheels_to: Column) -> Column:
    """Radar size against a station's own thresholds, where it has any."""
    return F.when(two_wheels_to.isNotNull() & (ser <= two_wheels_to), "2R").when(heavy_from.isNotNull() & (ser >= heavy_from), "PL").when(heavy_from.isNotNull(), "VL").otherwise(kind)


def speed_limit(c: Column) -> Column:
    """``90/80``: limit of cars when allowed, and that of heavy vehicles."""
    car = F.split_part(c, F.lit("/"), F.lit(1)).try_cast("int")
    car = F.when(car.isin(SPEED_LIMITS), car)
    heavy = reduce(lambda w, kv: w.when(car == kv[0], kv[1]), list(HEAVY_LIMIT.items())[1:], F.when(car == 130, HEAVY_LIMIT[130])).otherwise(car)
    return F.struct(car.alias("vma_vl"), heavy.alias("vma_pl"))


#: Edges of the speed classes in km/h.
SPEED_EDGES = [0, 20, 30, 40, 50, 60, 70, 80, 90, 100, 110, 9999]


def speed_bin(v: Column) -> Column:
    """Right-closed classes ``(0,20]`` to ``(110,9999]``; null outside them."""
    spans = list(zip(SPEED_EDGES, SPEED_EDGES[1:]))
    return reduce(lambda w, s: w.when((v > s[0]) & (v <= s[1]), f"({s[0]},{s[1]}]"), spans[1:], F.when((v > 0) & (v <= 20), "(0,20]"))


def code_map(c: Column, codes: dict[str, str], default: Column | None = None) -> Column:
    table = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return F.coalesce(table[c], c if default is None else default)


def month_key(c: Column) -> Column:
    """A month's number, or its French name or a part of it, as one of twelve keys."""
    plain = F.translate(F.lower(F.trim(c)), "éèêûô.", "eeeuo")
    number = plain.try_cast("int")
    by_number = F.get(F.array(*[F.lit(m) for m in MONTHS]), number - 1)
    starts = {"jan": 0, "fev": 1, "mar": 2, "avr": 3, "mai": 4, "juin": 5, "juil": 6, "aou": 7, "sep": 8, "oct": 9, "nov": 10, "dec": 11}
    by_name = F.coalesce(*[F.when(plain.startswith(s), MONTHS[k]) for s, k in starts.items()])
    return F.coalesce(by_number, by_name)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0))


def null_to_sentinel(c: Column) -> Column:
    return F.coalesce(c, F.lit(INVALID))


def sentinel_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(INVALID))


def holiday_note(obs: Column, in_holidays: Column, note: str = "compte pendant les vacances") -> Column:
    """Adds the remark; an old remark is kept in either case."""
    return F.when(in_holidays, F.concat_ws(" ; ", obs, F.lit(note))).otherwise(obs)


def explode_lanes(df: DataFrame, id_col: str, obs_col: str, lanes_col: str) -> DataFrame:
    """``voie : a,b ; nom_site : s`` beside a list of lane ids: one row a lane, with a join key."""
    lanes = F.split(F.regexp_extract(obs_col, r"voie : ([^;]*?)\s*(;|$)", 1), ",")
    site = F.trim(F.regexp_extract(obs_col, r"nom_site : ([^;]*)", 1))
    z = df.select(id_col, site.alias("site"), F.explode(F.arrays_zip(lanes.alias("voie"), F.split(lanes_col, ",").alias("id_voie"))).alias("z"))
    return z.select(id_col, "site", F.trim("z.voie").alias("voie"), F.trim("z.id_voie").alias("id_voie"), normalise_label(F.concat("site", F.trim("z.voie"))).alias("cle"))


def hour_label(hour: Column) -> Column:
    return F.format_string("h%d_%d", hour, hour + 1)


def hour_of_label(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, r"(\d+)[_-]\d+", 1), F.lit("")).cast("int")


def time_fields(ts: Column) -> list[Column]:
    return [F.weekday(ts).alias("jour"), F.dayofyear(ts).alias("jour_annee"), F.hour(ts).alias("heure"), F.to_date(ts).alias("date")]


def address_number(c: Column) -> Column:
    """Number and street of ``... numero 12 rue x`` or ``n°12 rue x``."""
    plain = F.translate(F.lower(c), "éèê", "eee")
    part = lambda k: F.regexp_extract(plain, r"(?:numero|n°)\s*(\d+)\s+(.+)$", k)
    return F.struct(F.nullif(part(1), F.lit("")).cast("int").alias("numero"), F.nullif(part(2), F.lit("")).alias("rue"))


def reference_folder(path: Column, root: str = "en_cours") -> Column:
    """The folder that stands for both directions of a file, by its depth below ``root`` (of the whole path where that is not in it).

    Below three folders it is the middle one; below one or two the last, or the one above where that is a ``vers ...`` folder.
    Null for files at another depth, and where nothing is above a ``vers ...`` folder.  Both kinds of slashes part folders.
    """
    below = F.filter(F.split(F.substring_index(path, root, -1), r"[/\\]"), lambda part: part != "")
    folders = F.slice(below, 1, F.greatest(F.size(below) - 1, F.lit(0)))
    at = lambda k: F.get(folders, F.size(folders) - k)
    return F.when(F.size(folders) == 3, at(2)).when(F.size(folders).isin(1, 2), F.when(at(1).contains("vers "), at(2)).otherwise(at(1)))


def post_type_by_files(n: Column) -> Column:
    return F.when(n > 4, "permanent").when(n >= 2, "tournant").otherwise("ponctuel")


def post_type_by_years(n: Column, all_years: int) -> Column:
    return F.when(n >= all_years, "permanent").when(n >= 3, "tournant").otherwise("ponctuel")


def french_date(c: Column) -> Column:
    """``lundi 2 janvier 2019`` as a date."""
    part = lambda k: F.regexp_extract(F.lower(c), r"(\d{1,2})(?:er)?\s+(\p{L}+)\s+(\d{4})", k)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), month_key(part(2)))
    return F.when(month > 0, F.make_date(part(3).try_cast("int"), month.cast("int"), part(1).try_cast("int")))


def id_from_location(c: Column, dep: Column) -> Column:
    """``D12 PR 3+450``: the counter's id; the text itself where there is no marker."""
    part = lambda k: F.regexp_extract(c, r"(?i)(R?[ND]\s?\d+)\D*PR\s*(\d+)\s*\+\s*(\d+)", k)
    return F.when(part(2) != "", id_comptag(dep, route_name(part(1)), part(2), part(3))).otherwise(c)


def totals_from_text(c: Column, heavy: Column) -> Column:
    """``1234 (5,6 %)``: number and share; a missing share is worked out of the heavy total."""
    n = F.regexp_extract(c, r"^\s*(\d+)", 1).try_cast("int")
    share = number_fr(F.regexp_extract(c, r"\(([^)]*)\)", 1))
    return F.struct(n.alias("total"), F.coalesce(share, F.round(100 * heavy / F.nullif(n, F.lit(0)), 2)).alias("part"))
