"""Quality rules by distribution divergence, in DataFrame operations only.

Base rules count words and repeats.  The verdict compares two histograms of a
document - character classes, and common words - with the references of every
language by Jensen-Shannon distance.  References are the means of the
histograms of all rows of a language, so no row weighs more for being long; the
bins of the word histogram are the ``BINS`` most frequent words of each
language in the corpus itself.  How far a document may be from a reference is
``SPREAD`` times the median distance of that language's own rows, which odd
rows hardly move.  A document stays when each histogram is near enough to some language's.
Guards: the character histogram is compared from ``MIN_CHARS`` code points on,
the word histogram from ``MIN_WORDS`` words on, and shorter texts take no part
in the references; they pass the comparison.

A word can be a bin only if it makes up a thousandth of its language's words,
so a thousand words a language reach the driver at most.  The features of each
row are written once to the shared folder; references are as many rows as there
are languages.

Defined results: null text = no words, base_failed; a null language takes no
part in the references; without any reference the verdict is the base rules',
and distances are 0; repeated rows get the same result each; an empty table
gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, materialise, text_or_empty, words_of

MIN_CHARS, MIN_WORDS = 200, 50
BINS, SPREAD = 16, 2.8
#: A word must make up one of so many words of its language to be a bin.
RARE = 1000
#: Regular expressions of the character classes; what none takes is the last class.
CLASSES = (r"\p{Ll}", r"\p{Lu}", r"\p{N}", r"[\x20\x09-\x0D]", r"[.,;:!?'\"()\-]")


SPACES = 3


def covered_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in the array."""

    def of(hashes: Column) -> Column:
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(p: Column) -> Column:
            twice = F.filter(p, lambda x, k: ((k > 0) & (F.get(p, k - 1)["h"] == x["h"])) | (F.get(p, k + 1)["h"] == x["h"]))
            return F.array_sort(F.transform(twice, lambda x: x["i"]))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
        step = lambda acc, i: F.struct((i + 3).alias("end"), (acc["n"] + i + 3 - F.greatest(acc["end"], i)).cast("long").alias("n"))
        total = F.aggregate(let(pairs, places), start, step, lambda acc: acc["n"])
        return F.when(repeats, total).otherwise(F.lit(0).cast("long"))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - 2), lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(let(windows, of))


def _lines(text: Column) -> Column:
    def repeated(lines: Column) -> Column:
        return (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")

    return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), repeated)


def _text(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """doc_id, lang, t, and a hash of the text, which with the id stands for a row (equal rows have equal features)."""
    lang = F.lit("") if lang_col is None else F.col(lang_col)
    return docs.select(F.col(id_col).alias("doc_id"), lang.cast("string").alias("lang"), text_or_empty(text_col).alias("t"), F.xxhash64(text_or_empty(text_col)).alias("th"))


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """Base counts and the histogram of character classes of each row."""
    rows = _text(docs, id_col, text_col, lang_col).withColumn("t0", F.col("t"))
    for k, pattern in enumerate(CLASSES):  # no character is in two classes: each is looked for in what the ones before it leave
        rows = rows.withColumn(f"t{k + 1}", F.regexp_replace(f"t{k}", pattern + "+", ""))
    counts = [F.length(f"t{k}") - F.length(f"t{k + 1}") for k in range(len(CLASSES))]
    rows = rows.withColumn("w", words_of(F.col("t"))).select(
        "doc_id", "th", "lang", F.length("t").alias("n_chars"), F.size("w").cast("long").alias("n_words"), (F.length("t") - counts[SPACES]).cast("long").alias("word_chars"),
        (F.size(F.split(f"t{len(CLASSES)}", "[#*$%&|<>]", -1)) - 1).cast("long").alias("n_symbols"),
        _lines(F.col("t")).alias("n_dup_lines"), covered_words(F.col("w")).alias("n_repeat_words"), F.array(*[c.cast("double") for c in counts]).alias("classes"),
    )
    total = F.aggregate("classes", F.lit(0.0), lambda x, y: x + y)
    rows = rows.withColumn("classes", F.concat("classes", F.array(F.greatest(F.lit(0.0), F.col("n_chars") - total))))
    return rows.withColumn("classes", F.transform("classes", lambda x: x / F.greatest(F.col("n_chars"), F.lit(1))))


def _words(docs: DataFrame, id_col: str, text_col: str, lang_col: str | None) -> DataFrame:
    """One row a word, in lower case and without marks at its end."""
    rows = _text(docs, id_col, text_col, lang_col)
    return rows.select("doc_id", "th", "lang", F.explode(words_of(F.col("t"))).alias("w")).select("doc_id", "th", "lang", F.lower(F.rtrim("w", F.lit(".,;:!?"))).alias("word"))


def common_words(words: DataFrame, rows: DataFrame, bins: int = BINS) -> list[str]:
    """The most frequent words of each language, each once."""
    total = rows.where("lang is not null").groupBy("lang").agg(F.sum("n_words").alias("total"))
    counts = words.where("lang is not null and word <> ''").groupBy("lang", "word").agg(F.count("*").alias("n"))
    frequent = counts.join(total, "lang").where(F.col("n") * RARE >= F.col("total")).select("lang", "word", "n").collect()
    own: dict[str, list[tuple[int, str]]] = {}
    for r in frequent:
        own.setdefault(r["lang"], []).append((-r["n"], r["word"]))
    return sorted({w for found in own.values() for _, w in sorted(found)[:bins]})


def with_common(rows: DataFrame, words: DataFrame, bins: list[str]) -> DataFrame:
    """``rows`` with the shares of the bins among their words, and of all other words."""
    if not bins:
        return rows.withColumn("common", F.array(F.lit(1.0)))
    # literals, whose size Spark knows: at most ``BINS`` words a language
    listed = F.array(*[F.struct(F.lit(k).alias("bin"), F.lit(w).alias("word")) for k, w in enumerate(bins)])
    table = rows.sparkSession.range(1).select(F.explode(listed).alias("b")).select("b.bin", "b.word")
    each = words.join(table, "word").groupBy("doc_id", "th", "bin").agg(F.count("*").alias("n"))
    parts = [F.sum(F.when(F.col("bin") == k, F.col("n")).otherwise(0)).cast("double") for k in range(len(bins))]
    found = each.groupBy(F.col("doc_id").alias("c_id"), F.col("th").alias("c_th")).agg(F.array(*parts).alias("found"))
    # rows that are there several times were counted together
    copies = rows.groupBy(F.col("doc_id").alias("n_id"), F.col("th").alias("n_th")).agg(F.count("*").alias("copies"))
    found = found.join(copies, F.col("c_id").eqNullSafe(F.col("n_id")) & (F.col("c_th") == F.col("n_th")))
    j = rows.join(found, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("th") == F.col("c_th")), "left")
    share = F.transform(F.coalesce("found", F.array_repeat(F.lit(0.0), F.lit(len(bins)))), lambda x: x / F.coalesce("copies", F.lit(1)) / F.greatest(F.col("n_words"), F.lit(1)))
    rest = lambda a: F.greatest(F.lit(0.0), 1 - F.aggregate(a, F.lit(0.0), lambda x, y: x + y))
    return j.withColumn("common", let(share, lambda a: F.concat(a, F.array(rest(a))))).select(*rows.columns, "common")


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance, base 2: 0 for equal distributions, 1 for disjoint ones."""
    part = lambda x, y: F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)
    terms = F.zip_with(p, q, lambda x, y: (part(x, y) + part(y, x)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, b: a + b)))


def _long() -> Column:
    return (F.col("n_words") >= MIN_WORDS) & (F.col("n_chars") >= MIN_CHARS) & F.col("lang").isNotNull()


def references(rows: DataFrame, bins: int) -> list[tuple[str, list[float], list[float]]]:
    """Language and mean histograms; as many as there are languages."""
    mean = lambda c, k: F.array(*[F.avg(F.get(c, F.lit(i))) for i in range(k)]).alias(c)
    found = rows.where(_long()).groupBy("lang").agg(mean("classes", len(CLASSES) + 1), mean("common", bins + 1))
    return [(r["lang"], r["classes"], r["common"]) for r in found.orderBy("lang").collect()]


def limits(rows: DataFrame, langs: list[str], spread: float) -> list[tuple[float, float]]:
    """``spread`` times how far from each language's references half of its own rows are."""
    own = lambda c: F.get(c, F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")).cast("int") - 1)
    upto = lambda c: (spread * F.percentile_approx(own(c), 0.5)).alias(c)
    found = {r["lang"]: (r["to_classes"], r["to_common"]) for r in rows.where(_long()).groupBy("lang").agg(upto("to_classes"), upto("to_common")).collect()}
    return [found[x] for x in langs]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", bins: int = BINS, spread: float = SPREAD) -> DataFrame:
    """One row per input row: base counts, base_failed, the least distances, kept."""
    rows, words = materialise(features(docs, id_col, text_col, lang_col), "quality-features"), _words(docs, id_col, text_col, lang_col)
    common = common_words(words, rows, bins)
    rows = materialise(with_common(rows, words, common), "quality-histograms")
    refs = references(rows, len(common))
    literal = lambda values: F.array(*[F.lit(float(v)) for v in values])
    to = lambda c, k: F.array(*[distance(F.col(c), literal(r[k])) for r in refs]) if refs else F.array(F.lit(0.0))
    rows = rows.withColumns({"to_classes": to("classes", 1), "to_common": to("common", 2)}).drop("classes", "common")
    far = lambda c, k: F.lit(False)
    if refs:
        rows = materialise(rows, "quality-distances")
        most = limits(rows, [r[0] for r in refs], spread)
        far = lambda c, k: ~F.exists(F.zip_with(c, literal([m[k] for m in most]), lambda x, y: x <= y), lambda x: x)
    n, repeated = F.col("n_words"), F.col("n_repeat_words")
    odd = ((F.col("n_chars") >= MIN_CHARS) & far("to_classes", 0)) | ((n >= MIN_WORDS) & far("to_common", 1))
    rows = rows.withColumn("base_failed", (n < 50) | (100 * repeated > 50 * n))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & ~odd).alias("kept"), F.array_min("to_classes").alias("char_distance"), F.array_min("to_common").alias("word_distance"))
