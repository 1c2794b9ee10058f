"""A small table with every awkward row, and the same as Python values."""

import random

#: Clashing names on purpose: columns that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, key int, size string, fp string, word string, copies int, range int, norm string, kept boolean, component string"
EXTRA = (None, 7, "s", "x", "w", 3, 1, "n", True, "c")


def base_rows():
    random.seed(11)
    words = ["the", "of", "road", "count", "été", "straße", "niño", "Traffic", "LIGHT", "heavy", "12,5", "day", "hour", "and", "is"]
    say = lambda n: " ".join(random.choice(words) + random.choice(["", "", ",", "."]) for _ in range(n))
    passage = say(40)
    rows = [
        (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n\x0b\x0c\r ", None, "a"), (4, "word", "de", "b"), (5, "two words", "fr", "b"), (6, "Two  Words", "fr", None),
        (7, "12 34 !!", None, None), (8, " x  y　\n\n  z  ", "en", "c"), (9, "日本語 テキスト 🎉", "ja", "c"), (10, "a" * 5000, "en", "c"), (11, "ab " * 3000, "en", "c"),
    ]
    rows += [(12 + k, say(60 + 7 * k), "en" if k % 3 else "de", "abc"[k % 3]) for k in range(12)]
    rows += [(30 + k, f"{say(8)} {passage}\n{passage} {say(5)}", "en", "d") for k in range(6)]
    rows += [(40, "a <|endoftext|> b", "en", "d"), (41, "end<|ENDOFTEXT|><|startoftext|>", "en", "d")]
    long = say(30_000)
    rows += [(50, long, "en", "d"), (51, long[:90_000] + "XYZ" + long[90_000:], "en", "d"), (52, long, "en", None)]
    rows += [(60, rows[20][1], "en", "a"), (61, rows[20][1].replace(" ", "  "), "en", "a"), (20, rows[15][1], "de", "b"), (20, rows[15][1], "de", "b")]
    rows += [(None, rows[14][1], "en", "b"), (None, "null id " + say(20), "en", "b")]
    return rows


def frame(spark, rows=None):
    rows = base_rows() if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows], SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
