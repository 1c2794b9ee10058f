"""Text, JSON and catalogue sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import vehicle_class
from ..schemas import HOURS
from ..scratch import materialise

PIECE = ["file", "piece"]


def lines_of(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """file, piece, pos, line: the lines of text files, numbered from 0 in each; empty lines are left out.

    Spark cuts a file at byte ranges, so a large one is read by many tasks; a
    piece is the place where such a range begins.  Lines are numbered within
    their piece, and the sizes of the pieces before it are added.  What readers
    carry from line to line goes on from piece to piece in the same way: no step
    holds a whole file.  The numbered lines are written once, since a reader goes
    through them several times.
    """
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    name = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    raw = raw.select(name.alias("file"), F.col("_metadata.file_block_start").alias("piece"), F.decode(F.col("value").cast("binary"), encoding).alias("line"), F.monotonically_increasing_id().alias("id"))
    rows = raw.withColumn("nth", F.row_number().over(Window.partitionBy(*PIECE).orderBy("id")))
    sizes = rows.groupBy(*PIECE).agg(F.count("*").alias("n"))
    before = sizes.select(*PIECE, (F.sum("n").over(Window.partitionBy("file").orderBy("piece")) - F.col("n") - 1).alias("before"))
    return materialise(rows.join(before, PIECE).select(*PIECE, (F.col("before") + F.col("nth")).alias("pos"), "line").where(F.trim("line") != ""), "lines")


def head_of(lines: DataFrame, count: int) -> DataFrame:
    """file, head: the first lines of each file, a null for an empty one."""
    at = [F.max(F.when(F.col("pos") == k, F.col("line"))) for k in range(count)]
    return lines.where(F.col("pos") < count).groupBy("file").agg(F.array(*at).alias("head"))


def carried(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """A sum over the pieces of a file that come before each."""
    return pieces.withColumn(name, F.coalesce(F.sum(value).over(Window.partitionBy("file").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def delimited(spark: SparkSession, path: str, sep: str = ";", schema: str | None = None, encoding: str = "UTF-8", skip_rows: int = 0) -> DataFrame:
    """A delimited file with a header; empty text is null, é è ê become e.

    ``skip_rows`` lines before the header are left out; that needs a schema.
    """
    if skip_rows:
        if schema is None:
            raise ValueError("skipped rows need a schema")
        rows = lines_of(spark, path, encoding).where(F.col("pos") > skip_rows)
        df = rows.select(F.from_csv("line", F.lit(schema), {"sep": sep, "nullValue": ""}).alias("r")).select("r.*")
    else:
        reader = spark.read.option("sep", sep).option("header", True).option("encoding", encoding).option("nullValue", "")
        df = (reader.schema(schema) if schema else reader).csv(path)
    return df.select(*[F.translate(c, "éèê", "eee").alias(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])


#: The columns of a tube counter's file.
TUBE = {"valide": "Véhicule Valide", "horodate": "Horodate de passage", "seconde": "Seconde", "centieme": "Centième", "silhouette": "Silhouette", "voie": "Voie", "vitesse": "Vitesse (km/h)"}


def vehicle_tube(spark: SparkSession, path: str) -> DataFrame:
    """Tube counters: Latin-1, columns set apart by tab or NUL, rows one field to the right of the header.

    Valid rows, timestamp of text + second + hundredth, class of the silhouette, direction = lane + 1.
    """
    lines = lines_of(spark, path, "ISO-8859-1")
    cells = lambda line: F.split(line, r"[\x00\t]")
    rows = lines.where("pos > 0").join(head_of(lines, 1).select("file", cells(F.get("head", F.lit(0))).alias("names")), "file")
    raw = rows.select("names", cells(F.col("line")).alias("cells")).select(*[F.get("cells", F.array_position("names", F.lit(n)).cast("int")).alias(c) for c, n in TUBE.items()])
    raw = raw.where(F.col("valide").try_cast("double") == 1)
    part = lambda c: F.col(c).cast("double").cast("int")
    at = F.try_to_timestamp("horodate", F.lit("dd/MM/yyyy HH:mm")).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), part("seconde") + part("centieme") / 100)
    return raw.select(at.alias("date_heure"), F.lit(1).alias("nb_veh"), vehicle_class(part("silhouette")).alias("type_veh"), F.concat(F.lit("sens"), (part("voie") + 1).cast("string")).alias("sens"), F.col("vitesse").cast("double").alias("vitesse"))


def vehicle_radar(spark: SparkSession, path: str) -> DataFrame:
    """Radar files: dots set the head's fields apart, the sixth to eighth are year (two digits), month and day of the start.

    Rows: direction, day of month, HHmm, SScc, speed after two characters,
    series, class.  A day that falls back means a new month.
    """
    lines = lines_of(spark, path)
    head = lambda k: F.trim(F.split_part(F.get("head", F.lit(0)), F.lit("."), F.lit(k + 1)))
    start = F.make_date(2000 + head(5).cast("int"), head(6).cast("int"), head(7).cast("int"))
    f = F.split(F.trim("line"), " ")
    rows = lines.where("pos > 0").select(*PIECE, "pos", *[F.get(f, F.lit(k)).alias(c) for k, c in enumerate(("sens", "d", "hm", "sc", "vts", "ser", "type_veh"))]).withColumn("day", F.col("d").cast("int"))
    w, files = Window.partitionBy(*PIECE).orderBy("pos"), Window.partitionBy("file").orderBy("piece")
    rows = rows.withColumn("fell", F.coalesce((F.col("day") < F.lag("day").over(w)).cast("int"), F.lit(0)))
    # between pieces: the day before a piece's first one, at the beginning that of the head
    pieces = rows.groupBy(*PIECE).agg(F.min_by("day", "pos").alias("a"), F.max_by("day", "pos").alias("z"), F.sum("fell").alias("falls")).join(head_of(lines, 1).select("file", start.alias("start")), "file")
    pieces = pieces.withColumn("step", (F.col("a") < F.coalesce(F.lag("z").over(files), F.dayofmonth("start"))).cast("int"))
    pieces = carried(pieces, F.col("step") + F.col("falls"), "months").select(*PIECE, "start", (F.col("months") + F.col("step")).alias("so_far"))
    rows = rows.join(pieces, PIECE).withColumn("months", F.col("so_far") + F.sum("fell").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    date = F.date_add(F.add_months(F.trunc("start", "month"), F.col("months").cast("int")), F.col("day") - 1)
    second = F.concat_ws(".", F.substring("sc", 1, 2), F.substring("sc", 3, 2)).cast("decimal(8,6)")
    at = F.make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date), F.substring("hm", 1, 2).cast("int"), F.substring("hm", 3, 2).cast("int"), second)
    return rows.select("file", at.alias("date_heure"), F.lit(1).alias("nb_veh"), F.expr("substring(vts, 3)").cast("int").alias("vitesse"), F.col("ser").cast("int").alias("ser"), F.upper("type_veh").alias("type_veh"), F.concat(F.lit("sens"), "sens").alias("sens"))


#: Codes of a FIM title, with the vehicles they count and the kind of file.
FIM_CODES = {
    "1.T": ("TV", "mode3"), "3.P": ("PL", "mode3"), "2.V": ("VL", "mode4"), "2.P": ("PL", "mode4"), "4.V": ("VL", "mode4"), "4.P": ("PL", "mode4"), "4.T": ("TV", "mode4"),
    "2.": ("TV", "mode2"), "1.": ("TV", "mode1"), "5.": ("VELO", "mode5"), "05.": ("VELO", "mode5"),
}
#: Codes that stand for others.
FIM_REPAIRS = {"QT.S0": "1.T", "QL.S0": "3.P", "LC.S0": "3.P"}
FIM_VALUES = 12


def _fim_blocks(spark: SparkSession, path: str) -> DataFrame:
    """file, piece, pos, line, bloc (0 before the first title), code (titles only)."""
    codes = "|".join(c.replace(".", r"\.") for c in sorted([*FIM_CODES, *FIM_REPAIRS, "4."], key=len, reverse=True))
    # eleven fields, the code, and something after it: a line of values ends with its twelfth
    code = F.nullif(F.regexp_extract("line", rf"^(?:[^.]*\.){{11}}\s*({codes})\s+\S", 1), F.lit(""))
    lines = lines_of(spark, path).withColumn("line", F.trim("line")).withColumn("code", code)
    titles = carried(lines.groupBy(*PIECE).agg(F.count("code").alias("n")), F.col("n"), "so_far").drop("n")
    upto = Window.partitionBy(*PIECE).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    return lines.join(titles, PIECE).withColumn("bloc", F.col("so_far") + F.count("code").over(upto)).drop("so_far")


def fim_blocks(spark: SparkSession, path: str, velo: bool = False) -> DataFrame:
    """FIM files: blocks of a title and lines of twelve values; an empty value is 0.

    The first title gives start (fields 6 to 10), step in minutes (field 11) and,
    where it ends with one, the position of all blocks; each title gives
    direction (field 5) and vehicles.  Code ``4.`` without a letter stands for
    light and heavy vehicles by turns.
    """
    rows = _fim_blocks(spark, path)
    field = lambda k: F.trim(F.split_part("line", F.lit("."), F.lit(k + 1)))
    number = lambda k: field(k).cast("int")
    year = F.when(number(5) < 69, 2000 + number(5)).when(number(5) < 100, 1900 + number(5)).otherwise(number(5))
    start = F.make_timestamp_ntz(year, number(6), number(7), number(8), number(9), F.lit(0))
    place = r"([-+])(\d{1,3})\.(\d{4})\.(\d{4})\.([-+])(\d{1,3})\.(\d{4})\.(\d{4})\.$"
    group = lambda k: F.regexp_extract("line", place, k)
    degree = lambda k: F.concat(group(k), group(k + 1), F.lit("."), group(k + 2), group(k + 3)).try_cast("double")
    first = rows.where("bloc = 1 and code is not null").select("file", start.alias("start"), number(10).alias("pas"), degree(1).alias("lat"), degree(5).alias("lon"))
    repaired = F.when(F.col("code") == "4.", F.when(F.col("bloc") % 2 == 1, "4.V").otherwise("4.P")).otherwise(F.col("code"))
    for old, new in FIM_REPAIRS.items():
        repaired = F.when(F.col("code") == old, new).otherwise(repaired)
    of = lambda k: F.create_map(*[F.lit(x) for c, v in FIM_CODES.items() for x in (c, v[k])])[repaired]
    kind, mode = (F.lit("VELO"), F.lit("mode5")) if velo else (of(0), of(1))
    heads = rows.where("code is not null").select("file", "bloc", kind.alias("type_veh"), mode.alias("mode"), F.concat(F.lit("sens"), F.lower(field(4))).alias("sens"))
    # a block can go on in later pieces, where its lines are counted on
    values = rows.where("code is null and bloc > 0")
    before = values.groupBy(*PIECE, "bloc").agg(F.count("*").alias("n"))
    before = before.select(*PIECE, "bloc", (F.sum("n").over(Window.partitionBy("file", "bloc").orderBy("piece")) - F.col("n") - 1).alias("before"))
    line = F.col("before") + F.row_number().over(Window.partitionBy(*PIECE, "bloc").orderBy("pos"))
    values = values.join(before, [*PIECE, "bloc"]).withColumn("n", line)
    cells = F.slice(F.split(F.regexp_replace("line", r"\.$", ""), r"\."), 1, FIM_VALUES)
    cells = values.select("file", "bloc", "n", F.posexplode(cells).alias("k", "v")).join(heads, ["file", "bloc"]).join(first, "file")
    at = F.col("start") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("n") * FIM_VALUES + F.col("k")) * F.col("pas"))
    return cells.select("file", "mode", "type_veh", "sens", at.alias("date_heure"), F.coalesce(F.trim("v").try_cast("int"), F.lit(0)).alias("nb_veh"), "lon", "lat")


def fim_uneven(spark: SparkSession, path: str) -> DataFrame:
    """Files whose blocks differ in their number of lines."""
    sizes = _fim_blocks(spark, path).where("bloc > 0").groupBy("file", "bloc").agg(F.count_if(F.col("code").isNull()).alias("n"))
    return sizes.groupBy("file").agg(F.min("n").alias("min"), F.max("n").alias("max")).where("min <> max")


#: Lines before the header and after the data of an IRIS file; where route, marker and direction stand (line, cell).
IRIS_HEAD, IRIS_FOOT = 10, 11
IRIS_ROUTE, IRIS_MARKER, IRIS_SIDE = (4, 16), (5, 16), (2, 22)


def iris_hourly(spark: SparkSession, path: str, dep: int = 16) -> DataFrame:
    """Daily rows H1 to H24 of the csv files in TV and PL folders; Latin-1, dates dd/MM/yyyy; ``_Voie`` files are left out."""
    lines = lines_of(spark, path, "ISO-8859-1").where(F.col("file").endswith(".csv") & ~F.col("file").contains("_Voie"))
    cell = lambda at: F.get(F.split(F.get("head", F.lit(at[0])), ";"), F.lit(at[1]))
    point = F.concat(F.lit(f"{dep}-D"), cell(IRIS_ROUTE), F.lit("-"), cell(IRIS_MARKER))
    names = F.split(F.get("head", F.lit(IRIS_HEAD)), ";")
    heads = head_of(lines, IRIS_HEAD + 1).select("file", point.alias("id_comptag"), F.concat(F.lit("sens "), F.right(cell(IRIS_SIDE), F.lit(1))).alias("sens"), names.alias("names"))
    heads = heads.join(lines.groupBy("file").agg((F.max("pos") - IRIS_FOOT).alias("last")), "file")
    rows = lines.where(F.col("pos") > IRIS_HEAD).join(heads, "file").where("pos <= last").select("id_comptag", "sens", F.regexp_extract("file", "/(TV|PL)/", 1).alias("indicateur"), "names", "line")
    rows = rows.withColumn("cells", F.split("line", ";"))
    get = lambda name: F.get("cells", F.array_position("names", F.lit(name)).cast("int") - 1)
    return rows.select("id_comptag", "sens", "indicateur", F.to_date(get("Jours"), "dd/MM/yyyy").alias("jour"), *[get(f"H{k + 1}").try_cast("double").alias(h) for k, h in enumerate(HOURS)])


def vehicle_csv(spark: SparkSession, path: str) -> DataFrame:
    """Vehicle rows with a length: light below 7.2 m, heavy below 22 m; broken records (code 128) go."""
    raw = spark.read.option("header", True).schema("DateTime timestamp_ntz, Length double, AdviceCode int").csv(path).where("AdviceCode <> 128")
    return raw.select(F.col("DateTime").alias("date_heure"), F.when(F.col("Length") < 7.2, "VL").when(F.col("Length") < 22, "PL").alias("type_veh"), F.col("Length").alias("longueur"))


def minute_counts(spark: SparkSession, path: str) -> DataFrame:
    """The large minute file, without repeated rows."""
    return spark.read.option("header", True).schema("station string, minute timestamp_ntz, nb_veh int").csv(path).distinct()


def geojson(spark: SparkSession, path: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Features of GeoJSON collections, of any properties and geometry: a file or more, one JSON document each.

    ``fields`` names properties and their types; a property that is missing or of
    another kind is null.  type is that of the geometry; points has the
    positions of a point (one), a line, or a polygon's rings one behind the
    other; lon and lat are the first.  A null geometry gives nulls.  proprietes
    keeps all properties as a variant.
    """
    doc = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
    f = doc.select(F.explode(F.variant_get(F.try_parse_json("value"), "$.features", "array<variant>")).alias("f"))
    get = lambda at, kind: F.try_variant_get("f", at, kind)
    kind, one, line, rings = get("$.geometry.type", "string"), get("$.geometry.coordinates", "array<double>"), get("$.geometry.coordinates", "array<array<double>>"), get("$.geometry.coordinates", "array<array<array<double>>>")
    points = F.when(kind == "Point", F.array(one)).when(kind.isin("LineString", "MultiPoint"), line).when(kind.isin("Polygon", "MultiLineString"), F.flatten(rings))
    position = lambda p: F.struct(F.get(p, F.lit(0)).alias("lon"), F.get(p, F.lit(1)).alias("lat"))
    out = f.select(*[get(f"$.properties['{name}']", t).alias(name) for name, t in (fields or {}).items()], kind.alias("type"), F.transform(points, position).alias("points"), get("$.properties", "variant").alias("proprietes"))
    first = F.get("points", F.lit(0))
    return out.select(*(fields or {}), "type", first["lon"].alias("lon"), first["lat"].alias("lat"), "points", "proprietes")


def catalog(df: DataFrame, dep: int | None = None, type_poste: str | Sequence[str] | None = None, gestionnai: str | None = None) -> DataFrame:
    """A stored table by département, kind and manager; the filters reach the scan."""
    kinds = [type_poste] if isinstance(type_poste, str) else list(type_poste or ())
    if dep is not None:
        df = df.where(F.col("dep") == dep)
    if kinds:
        df = df.where(F.col("type_poste").isin(kinds))
    return df if gestionnai is None else df.where(F.col("gestionnai") == gestionnai)


def files_by_name(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Files whose path matches, gathered by the point that the pattern's first group names; only the listing is read."""
    names = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").where(F.col("path").rlike(pattern))
    points = names.select(F.regexp_extract("path", pattern, 1).alias("point"), F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("nom"))
    return points.groupBy("point").agg(F.array_sort(F.collect_list("nom")).alias("fichiers"), F.count("*").alias("n"))


def file_dedup(files: DataFrame, point: str, name: str, content: str) -> DataFrame:
    """Of files of one point with the same content, the first by name."""
    return files.groupBy(point, F.sha2(content, 256).alias("empreinte")).agg(F.min(name).alias(name))


def file_kind(cells: DataFrame, kind: str) -> DataFrame:
    """Cells of the files whose first cell names the kind."""
    first = cells.groupBy("file").agg(F.min_by("value", "line").alias("k")).where(F.col("k") == kind)
    return cells.join(first.select("file"), "file", "left_semi")
