"""Small helpers shared by the training-data operators.

White space is always the six ASCII characters of ``[\\x20\\x09-\\x0D]``; words
are the maximal runs of anything else.  A null text counts as empty.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..scratch import forget, fresh_path, materialise, shared_dir  # noqa: F401

SPACES = " \t\n\x0b\x0c\r"
#: Finds a character outside the range in which Python's ``re`` and the tokenizers' patterns agree on
#: letters, digits and white space, NFC changes nothing, and lower case is one character for another.
NOT_PLAIN = re.compile(r"[^\t-\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u017f\u2010-\u2027\u2030-\u205e\u20ac]")
#: The letters in that range.
LETTERS = "".join(chr(c) for c in range(0x180) if chr(c).isalpha())
SPACE_CLASS = r"[\x20\x09-\x0D]"


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_of(text: Column) -> Column:
    """Array of the words of a text, JVM-side; an empty array when it has none."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS + "+"))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def doc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds
