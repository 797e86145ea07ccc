"""Read the notes corpus and the question bank, and give every row its place in the corpus.

All "first" rules go by ``ord``, a unique 64-bit number that rises in corpus order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from notewright.functions.fields import json_path
from notewright.session import scratch_path, settle, shuffle_partitions

# A rank and a row's place share one number: this many rows in a Parquet file, or in a task of a JSON scan.
ROWS_PER_FILE = 1 << 40
ROWS_PER_TASK = 1 << 33


def read_notes(
    spark: SparkSession, path: str, fmt: str = "parquet", id_col: str = "_id",
    note_col: str = "description", order_by: str | None = None,
) -> DataFrame:
    """``(ord, id, note)``, with ``other_id`` too where the corpus has a column ``id`` besides ``id_col``.

    A note that is missing altogether is an empty note; an explicit null, or a value that is no string,
    is null. ``order_by`` names a unique number to go by; else rows go by file name and place in the file.
    For that the files are ranked first, which is a job over file names alone; the numbers of JSON rows hold
    as long as the files and the split settings stay as they are, their order always.
    """
    if fmt == "json":
        rows = _with_json_ordinal(_json_rows(spark, path), order_by)
        note = _json_text(note_col)
        ident, other = _json_scalar(id_col), _json_scalar("id")
        extra = [other.alias("other_id")] if id_col != "id" else []
        missing = F.try_variant_get("v", json_path(note_col), "variant").isNull()
        note = F.when(missing, F.lit("")).otherwise(note)
        return rows.select(F.col("_ord").alias("ord"), ident.alias("id"), note.alias("note"), *extra)
    rows = spark.read.format(fmt).load(path)
    return _with_ordinal(rows, fmt, order_by).select(
        F.col("_ord").alias("ord"),
        _plain(rows, id_col).cast("string").alias("id"),
        _string_or_null(rows, note_col, F.lit("")).alias("note"),
        *([F.col("id").cast("string").alias("other_id")] if _has_other_id(rows, id_col) else []),
    )


def stream_notes(
    spark: SparkSession, path: str, schema: str, id_col: str = "_id", note_col: str = "description",
    files_per_batch: int = 1000,
) -> DataFrame:
    """``(ord, id, note)`` of the Parquet files that arrive under ``path``, for the incremental run.

    A stream has no order of rows, so ``ord`` is only a number that tells rows apart. Each micro-batch
    takes up ``files_per_batch`` files and is committed by itself.
    """
    rows = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )
    return rows.select(
        F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("ord"),
        _plain(rows, id_col).cast("string").alias("id"),
        _string_or_null(rows, note_col, F.lit("")).alias("note"),
    )


def stream_json_notes(
    spark: SparkSession, path: str, id_col: str = "_id", note_col: str = "description", files_per_batch: int = 1000,
    files: str = "*.{json,jsonl,txt}",
) -> DataFrame:
    """``(ord, id, note)`` of the JSON lines that arrive under ``path``, by the same rules as :func:`read_notes`.

    A line is kept as a variant, so a note that is missing is an empty note and an explicit null is null. A line that
    is no JSON has neither id nor note. ``ord`` is a number of the file and the line's text.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", files).text(path)
    place = F.xxhash64("_metadata.file_path", "value").alias("ord")
    rows = lines.select(place, F.try_parse_json("value").alias("v"))
    missing = F.try_variant_get("v", json_path(note_col), "variant").isNull() & F.col("v").isNotNull()
    note = F.when(missing, F.lit("")).otherwise(_json_text(note_col))
    return rows.select("ord", _json_scalar(id_col).alias("id"), note.alias("note"))


def read_bank(
    spark: SparkSession, path: str, fmt: str = "parquet", index_col: str = "index",
    question_col: str = "question", order_by: str | None = None,
) -> DataFrame:
    """``(ord, idx_raw, question)``. A missing column, or a question that is no string, gives null."""
    if fmt == "json":
        rows = _with_json_ordinal(_json_rows(spark, path), order_by)
        return rows.select(
            F.col("_ord").alias("ord"),
            # A number or text that holds a whole number; 3.7 counts as 3 but "3.7" does not.
            F.try_variant_get("v", json_path(index_col), "bigint").cast("string").alias("idx_raw"),
            _json_text(question_col).alias("question"),
        )
    rows = spark.read.format(fmt).load(path)
    index = _plain(rows, index_col)
    if index_col in rows.columns and rows.schema[index_col].dataType.typeName() != "string":
        index = index.try_cast("bigint")
    return _with_ordinal(rows, fmt, order_by).select(
        F.col("_ord").alias("ord"), index.cast("string").alias("idx_raw"),
        _string_or_null(rows, question_col, F.lit(None)).cast("string").alias("question"),
    )


def ranked(places: DataFrame) -> DataFrame:
    """``places`` with ``_rank``: how many rows come before each in the order of all columns.

    The rows are dealt out by ranges and counted there; only the counts of the ranges, one row a shuffle
    partition, meet in one place. The result is on shared storage, so ranks do not change later.
    """
    spark = places.sparkSession
    columns = places.columns
    parts = places.repartitionByRange(shuffle_partitions(spark), *columns).sortWithinPartitions(*columns)
    numbered = parts.select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROWS_PER_TASK - 1)).alias("_at"),
    )
    numbered = settle(numbered, scratch_path(spark, "ranks"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy("_part").agg(F.count("*").alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    found = numbered.join(F.broadcast(starts), "_part")
    return found.select(*columns, (F.col("_start") + F.col("_at")).alias("_rank"))


def _with_ordinal(rows: DataFrame, fmt: str, order_by: str | None) -> DataFrame:
    if order_by:
        return rows.withColumn("_ord", F.col(order_by).cast("bigint"))
    if fmt != "parquet":
        raise ValueError(f"{fmt} rows have no place of their own; name a column in order_by")
    placed = rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    files = ranked(rows.select(F.col("_metadata.file_path").alias("_file")).distinct())
    # One row a file; the planner broadcasts it where it is small.
    return placed.join(files, "_file", "left").withColumn("_ord", F.col("_rank") * F.lit(ROWS_PER_FILE) + F.col("_row"))


def _with_json_ordinal(rows: DataFrame, order_by: str | None) -> DataFrame:
    """Splits are ranked by file and start. A split lies in one task, and in order."""
    if order_by is not None:
        return rows.withColumn("_ord", F.try_variant_get("v", json_path(order_by), "bigint"))
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_split")]
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(ROWS_PER_TASK - 1)).alias("_at")
    # The reader must not be asked for no column but these, so the rows are counted too.
    splits = rows.groupBy(*split).agg(F.count("v").alias("_n")).where("_n >= 0").drop("_n")
    splits = ranked(splits)
    placed = rows.select("*", *split, at).join(splits, ["_file", "_split"], "left")
    return placed.withColumn("_ord", F.col("_rank") * F.lit(ROWS_PER_TASK) + F.col("_at"))


def _has_other_id(rows: DataFrame, id_col: str) -> bool:
    return id_col != "id" and "id" in rows.columns


def _plain(rows: DataFrame, name: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast("string")


def _string_or_null(rows: DataFrame, name: str, missing: Column) -> Column:
    if name not in rows.columns:
        return missing
    is_text = rows.schema[name].dataType.typeName() == "string"
    return F.col(name) if is_text else F.lit(None).cast("string")


def _json_rows(spark: SparkSession, path: str) -> DataFrame:
    # As variants, because a key that is missing and a key that is null are not the same here.
    return spark.read.option("singleVariantColumn", "v").json(path)


def _json_scalar(name: str) -> Column:
    return F.try_variant_get("v", json_path(name), "string")


def _json_text(name: str) -> Column:
    value = F.try_variant_get("v", json_path(name), "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
