"""Sharded output files: JSON lines, Parquet, and the list of processed ids."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from notewright.operators.resume import clean_ids
from notewright.session import path_exists

SHARD_SIZE = 50_000
MAX_SHARD_BYTES = "500MB"
JSON_FILES = "*.{json,jsonl,txt}"
SIZE_UNITS = {
    "KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12,
    "KIB": 2**10, "MIB": 2**20, "GIB": 2**30, "TIB": 2**40,
}


def write_jsonl(
    df: DataFrame, path: str, shard_size: int = SHARD_SIZE, mode: str = "append",
    partition_by: str | None = None,
) -> None:
    """One JSON object per line, nulls spelled out, at most ``shard_size`` records per file.

    Several workers, or several shards of one job, may append to one folder: Spark gives every file a
    name of its own. ``partition_by`` makes a folder per value instead of a prefix in the name.
    """
    writer = df.write.mode(mode).option("maxRecordsPerFile", shard_size)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.option("ignoreNullFields", "false").json(path)


def write_table(
    df: DataFrame, path: str, shard_size: int = SHARD_SIZE, mode: str = "append",
    partition_by: str | None = None,
) -> None:
    """As :func:`write_jsonl`, to Parquet. A run that resumes then reads the ids without the rest."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", shard_size)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_record_lines(
    records: DataFrame, path: str, shard_size: int = SHARD_SIZE, mode: str = "append"
) -> None:
    """As :func:`write_jsonl` for enriched records, but each line has only the keys of its kind: a
    failed record has no schema fields, a good one no raw reply."""
    lines = records.select(record_line(records.columns).alias("value"))
    lines.write.mode(mode).option("maxRecordsPerFile", shard_size).text(path)


def record_line(columns: list[str]) -> Column:
    head = ["id", "patient_note", "source"]
    tail = [c for c in ("extraction_ok", "created_at") if c in columns]
    fields = [c for c in columns if c not in {*head, *tail, "model_output_raw", "shard"}]
    options = {"ignoreNullFields": "false"}
    good = F.to_json(F.struct(*head, *fields, *tail), options)
    failed = F.to_json(
        F.struct(*head, "extraction_ok", "model_output_raw", *[c for c in tail if c == "created_at"]),
        options,
    )
    return F.when(F.col("extraction_ok"), good).otherwise(failed)


def read_jsonl(
    spark: SparkSession, path: str, schema: StructType | str, files: str = JSON_FILES
) -> DataFrame:
    """All shards of a folder as one table; raises where the folder or the shards are missing."""
    df = spark.read.schema(schema).option("pathGlobFilter", files).json(path)
    listing = spark.read.format("binaryFile").option("pathGlobFilter", files)
    if listing.load(path).select("path").isEmpty():
        raise FileNotFoundError(f"no JSON lines files in {path}")
    return df


def describe_shards(df: DataFrame) -> DataFrame:
    """One row: how many records, and the column names."""
    return df.agg(F.count("*").alias("n_records")).withColumn(
        "columns", F.lit(",".join(df.columns))
    )


def size_in_bytes(size: str | int) -> int:
    """``500MB`` and the like; decimal units, or binary ones with an ``i``."""
    if isinstance(size, int):
        return size
    match = re.fullmatch(r"\s*(\d+)\s*([KMGT]I?B)\s*", size.upper())
    if not match:
        raise ValueError(f"size not understood: {size!r}")
    return int(match[1]) * SIZE_UNITS[match[2]]


def row_bytes(df: DataFrame) -> Column:
    """Size of a row before compression: texts by their bytes, nested values by their JSON."""
    total = F.lit(0).cast("bigint")
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        if kind in ("string", "binary"):
            size = F.octet_length(f.name)
        elif kind in ("array", "map", "struct", "variant"):
            size = F.octet_length(F.to_json(f.name))
        else:
            size = F.lit(8)
        total = total + F.coalesce(size, F.lit(0))
    return total


def export_parquet(
    df: DataFrame, path: str, max_shard_size: str | int = MAX_SHARD_BYTES,
    avg_row_bytes: float | None = None, mode: str = "error", compact: bool = False,
) -> int:
    """Write Parquet files of at most about ``max_shard_size``, measured before compression.

    The cap becomes a number of rows per file, from ``avg_row_bytes`` or from one pass over ``df``, so
    pass a table that is stored and not a long plan. ``compact`` first merges small partitions, at the
    price of a shuffle. Returns the number of rows per file.
    """
    if avg_row_bytes is None:
        avg_row_bytes = df.agg(F.avg(row_bytes(df)).alias("b")).first()["b"] or 1.0
    rows = max(1, int(size_in_bytes(max_shard_size) // max(avg_row_bytes, 1.0)))
    rows = min(rows, 2**31 - 1)
    out = df.hint("rebalance") if compact else df
    out.write.mode(mode).option("maxRecordsPerFile", rows).parquet(path)
    return rows


def union_shards(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The outputs of several workers as one table; a column that one of them lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def write_ids(df: DataFrame, path: str) -> None:
    """Append the ids of ``df``, one per line."""
    df.select("id").write.mode("append").text(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(id)`` from text files with one id per line; no files, no ids."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], "id string")
    return clean_ids(spark.read.text(path), "value")
