"""Text helpers against Python's own string methods."""

import hashlib

from pyspark.sql import functions as F

from notewright.functions import text
from notewright.functions.hashing import shard_of

STRINGS = [
    "", " ", "a", " a ", "\ta b\n", "a\n", "a\nb", "a\r\nb\r\n", "a\n\nb", "\n", "a\x0bb\x0cc", "a\x1cb\x1dc\x1e",
    "\x1f x \x1f", "a\x85b", "a b ", " a ", "　", "ß ü x", "one  two\tthree",
    "\r", "a\r\r\nb",
]


def column(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r["v"] for r in df.select("i", fn(F.col("s")).alias("v")).orderBy("i").collect()]


def test_strip(spark):
    assert column(spark, STRINGS, text.strip) == [s.strip() for s in STRINGS]


def test_blank(spark):
    assert column(spark, STRINGS, text.is_blank) == [not s.strip() for s in STRINGS]


def test_line_count(spark):
    assert column(spark, STRINGS, text.line_count) == [len(s.splitlines()) or 1 for s in STRINGS]


def test_word_count(spark):
    assert column(spark, STRINGS, text.word_count) == [len(s.split()) for s in STRINGS]


def test_whole_number(spark):
    values = ["12", " 7 ", "-3", "+4", "1_000", "1__0", "_1", "3.7", "n/a", "", "0012", None, "9" * 30]
    want = [12, 7, -3, 4, 1000, None, None, None, None, None, 12, None, None]
    assert column(spark, values, text.to_whole_number) == want


def test_shard_is_md5_modulo(spark):
    ids = [f"usmle-{i}" for i in range(300)] + ["ü-1", "", "a" * 100]
    for n in (1, 2, 7, 8, 1_000_003, 2**31):
        want = [int(hashlib.md5(i.encode()).hexdigest(), 16) % n for i in ids]
        assert column(spark, ids, lambda c: shard_of(c, n)) == want


def test_text_key_tells_texts_apart(spark):
    values = ["a", "a ", "A", "", None]
    keys = column(spark, values, lambda c: text.text_key_hex(text.text_key(c)))
    assert keys == [None if v is None else hashlib.sha256(v.encode()).hexdigest() for v in values]
