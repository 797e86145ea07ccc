"""Id to row-number lookup, and the provenance link it serves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.provenance import bank_key, source_url
from notewright.operators.joins import salted_join


def lookup_table(entries: DataFrame) -> DataFrame:
    """``(key, value, ord)`` to one row per lower-case key; of several usable values the last one wins.

    ``value`` is a 64-bit number or null where the entry holds no whole number; such entries are dropped
    before the last one is chosen.
    """
    usable = entries.where(F.col("value").isNotNull()).withColumn("key", F.lower("key"))
    return usable.groupBy("key").agg(F.max_by("value", "ord").alias("row"))


def with_source_url(
    notes: DataFrame, lookup: DataFrame | None, ids: DataFrame | None = None
) -> DataFrame:
    """Add ``source``. Without a lookup, or without a hit, ids of the bank family have none.

    Only notes of the bank family take part in the join. The others get their link from the id where they
    are, and are not shuffled. ``ids`` is where to look for ids on very many rows, as in
    :func:`notewright.operators.resume.without_done`.
    """
    if lookup is None:
        return notes.withColumn("source", source_url(F.col("id"), F.lit(None).cast("bigint")))
    others = notes.where(bank_key(F.col("id")).isNull())
    others = others.withColumn("source", source_url(F.col("id"), F.lit(None).cast("bigint")))
    keyed = notes.withColumn("_key", bank_key(F.col("id"))).where(F.col("_key").isNotNull())
    rows = lookup.select(F.col("key").alias("_key"), F.col("row").alias("_row"))
    keys = None if ids is None else ids.select(bank_key(F.col("id")).alias("_key"))
    found = salted_join(keyed, rows, "_key", "left", spread_by="ord", keys=keys)
    found = found.withColumn("source", source_url(F.col("id"), F.col("_row"))).drop("_key", "_row")
    return found.unionByName(others)
