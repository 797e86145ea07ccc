"""Read the id to row-number lookup from a mapping report or from the mapping table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.operators.lookup import lookup_table


def read_lookup_report(
    spark: SparkSession, path: str, max_bytes: int | None = None
) -> DataFrame:
    """``(key, row)`` from JSON files ``{"mapping": {id: number}}``, one report per file.

    Numbers and texts that hold whole numbers are taken, everything else is left out. Of entries whose
    keys differ only in case the last usable one wins, files in the order of their names.

    A report of this form is one value, so one task reads each file whole; larger lookups are better kept
    as a table. ``max_bytes`` refuses files above a size of the caller's choice.
    """
    if max_bytes is not None:
        listing = spark.read.format("binaryFile").load(path).select("path", "length")
        too_big = listing.where(F.col("length") > max_bytes).select("path").limit(1).collect()
        if too_big:
            raise ValueError(f"{too_big[0]['path']} is too large for a report; use the mapping table")
    blobs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"),
        F.from_json("value", "mapping map<string, variant>")["mapping"].alias("mapping"),
    )
    entries = blobs.select("file", F.posexplode(F.map_entries("mapping")).alias("pos", "entry"))
    return lookup_table(
        entries.select(
            F.col("entry.key").alias("key"),
            F.try_variant_get("entry.value", "$", "bigint").alias("value"),
            F.struct("file", "pos").alias("ord"),
        )
    )


def read_lookup_table(spark: SparkSession, path: str) -> DataFrame:
    """``(key, row)`` from the mapping table ``(id, row)``, which has one row per id."""
    return lookup_from_mapping(spark.read.parquet(path))


def lookup_from_mapping(mapping: DataFrame) -> DataFrame:
    return mapping.select(F.lower("id").alias("key"), "row")
