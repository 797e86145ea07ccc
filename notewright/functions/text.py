"""Text helpers whose results must agree with Python's string methods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters str.strip() and str.split() treat as white space. Java's Unicode \s
# covers all of them but the four separators.
PY_SPACE = r"[\s\x1c-\x1f]"

# Fixed value: the line ends of str.splitlines(), where a carriage return and a line feed together count once.
LINE_ENDS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"(?U)^{PY_SPACE}+|{PY_SPACE}+\z", "")


def is_blank(col: Column) -> Column:
    return ~col.rlike(rf"(?U)[^\s\x1c-\x1f]")


def line_count(col: Column) -> Column:
    """Number of lines as ``len(s.splitlines()) or 1``: a final line end opens no new line."""
    breaks = F.length(col) - F.length(F.translate(col, LINE_ENDS, ""))
    pairs = F.length(col) - F.length(F.replace(col, F.lit("\r\n"), F.lit("\n")))
    last = F.right(col, F.lit(1))
    ends = ((last != "") & F.contains(F.lit(LINE_ENDS), last)).cast("int")
    return breaks - pairs + F.lit(1) - ends


def word_count(col: Column) -> Column:
    """White-space separated words, the default stand-in for a tokenizer."""
    return F.regexp_count(col, F.lit(r"(?U)[^\s\x1c-\x1f]+"))


def to_whole_number(col: Column) -> Column:
    """``int(value)`` for text: signs, outer blanks and single underscores pass, others give null.

    Values outside the 64-bit range and digits outside ASCII give null as well.
    """
    text = strip(col.cast("string"))
    plain = F.when(text.rlike(r"\A[+-]?[0-9]+(?:_[0-9]+)*\z"), F.regexp_replace(text, "_", ""))
    return plain.try_cast("bigint")


def text_key(col: Column) -> Column:
    """32-byte stand-in for a whole text, so that no shuffle has to carry the text itself.

    It is the SHA-256 of the full text; equal keys mean equal texts for every practical purpose.
    """
    return F.unhex(F.sha2(col, 256))


def text_key_hex(col: Column) -> Column:
    return F.lower(F.hex(col))
