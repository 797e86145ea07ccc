"""What the operators of this folder share: input columns, words, seeded numbers, packed arrays."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.session import configure, shuffle_partitions

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# White space between words, as Java and Python both read it.
SPACE = r"[\x20\x09-\x0D]+"


def ready(spark: SparkSession) -> SparkSession:
    """The engine's settings, and this checkout on the path of local Python workers."""
    configure(spark)
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` and nothing else; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))


def whole_text(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row in one struct, ``row``, out of the way of any column that is added."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def fold(column: Column, modulus: int) -> Column:
    """The remainder of the CRC-32 of a value written as text."""
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(modulus))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits all depend on all input bits."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def column_rows(batches: Iterable[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of plain values; nulls stay None and whole numbers stay whole."""
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(name)).to_pylist() for name in names])


def row_batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2048) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows."""
    rows = iter(rows)
    while chunk := list(islice(rows, size)):
        columns = [pa.array(column, type=field.type) for column, field in zip(zip(*chunk), schema)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


# A key with more than 1 in LARGE of all rows is a large one; there are fewer than LARGE of them.
LARGE = 16_384


def join_counted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` joined to ``keys``, which has one row a key and, as ``rows``, how many rows hold it.

    Large keys are broadcast, fewer than ``LARGE`` by definition, so their rows stay where they are. The others
    are joined by a shuffle in which no key is hot. A null key matches nothing.
    """
    total = keys.agg(F.sum("rows")).first()[0] or 0
    large = F.col("rows") > F.lit(total // LARGE)
    here = keys.where(large).drop("rows")
    marked = rows.join(F.broadcast(here.withColumn("_large", F.lit(True))), key, "left")
    rest = marked.where(F.col("_large").isNull()).select(*rows.columns).join(keys.where(~large).drop("rows"), key)
    return marked.where("_large").drop("_large").unionByName(rest)


def bucket_count(docs: DataFrame, bucket_bytes: int, least: int, most: int = 8192) -> int:
    """Into how many buckets to deal what is made of all texts, so that each is of ``bucket_bytes`` of text or less.

    Beyond ``most`` the blocks that chunks send to buckets would be too small to be worth a row."""
    size = docs.agg(F.sum(F.octet_length(whole_text()))).first()[0] or 0
    return max(least, min(most, -(-size // bucket_bytes)))


def by_bucket(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that has any with the places of its rows, which keep their order."""
    bucket = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        yield b, order[cuts[b]:cuts[b + 1]]


def lane(word: bytes, seed: int = 0) -> int:
    return xxhash.xxh64_intdigest(word, seed)


def one_a_task(sent: DataFrame, buckets: int) -> DataFrame:
    """The rows of each ``bucket`` in a task of their own; a hash of the number would put some together."""
    return sent.repartitionById(max(buckets, shuffle_partitions(sent.sparkSession)), F.col("bucket"))
