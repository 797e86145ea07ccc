"""Parquet shards cut by bytes: none is above the cap, whatever the sizes of the rows.

Rows are dealt out by ranges of their order and their bytes summed there; the sums of the ranges, one row each, give every
row the bytes before it in the whole table. Rows are of three classes by size. Those of an eighth of the cap or less
fill bins whose width is the cap less the largest of them, so that a row that begins in a bin ends below the cap.
Those of up to half the cap fill bins of half the cap for the same reason. Larger ones are a shard each; only a row that
is by itself above the cap makes a shard above it. So shards of small rows are at least three quarters full, but for
the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.session import scratch_path, settle, shuffle_partitions
from notewright.sources.shards import MAX_SHARD_BYTES, row_bytes, size_in_bytes

SMALL, MEDIUM, LARGE = "s", "m", "l"


def with_shard(df: DataFrame, order: str, cap: int) -> DataFrame:
    """``df`` with ``shard``, the name of the shard that each row belongs to; in the order of a unique column."""
    spark = df.sparkSession
    size = F.col("_bytes")
    kind = F.when(size * 8 <= cap, SMALL).when(size * 2 <= cap, MEDIUM).otherwise(LARGE)
    parts = df.withColumn("_bytes", row_bytes(df)).repartitionByRange(shuffle_partitions(spark), order)
    rows = parts.sortWithinPartitions(order).select("*", kind.alias("_kind"), F.spark_partition_id().alias("_part"))
    rows = settle(rows, scratch_path(spark, "sized"))
    # Three rows a shuffle partition at most.
    sums = rows.groupBy("_kind", "_part").agg(F.sum("_bytes").alias("_sum"), F.max("_bytes").alias("_max"))
    before = Window.partitionBy("_kind").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_kind", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"),
                       F.max("_max").over(Window.partitionBy("_kind")).alias("_most"))
    inside = Window.partitionBy("_kind", "_part").orderBy(order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begin = F.sum("_bytes").over(inside) - F.col("_bytes")
    rows = rows.withColumn("_begin", begin).join(F.broadcast(sums), ["_kind", "_part"])
    width = F.when(F.col("_kind") == SMALL, F.lit(cap) - F.col("_most")).otherwise(F.lit(cap // 2))
    # Large rows have names by their own place; the others count bins.
    bin_ = F.when(F.col("_kind") == LARGE, F.col("_before") + F.col("_begin")).otherwise(
        F.floor((F.col("_before") + F.col("_begin")) / width)
    ).cast("bigint")
    return rows.select(*df.columns, F.concat("_kind", F.lpad(bin_.cast("string"), 15, "0")).alias("shard"))


def export_capped(
    df: DataFrame, path: str, order: str, max_shard_size: str | int = MAX_SHARD_BYTES, mode: str = "error",
) -> None:
    """Write ``df`` as one Parquet file in each folder ``shard=...``, none above the cap before compression.

    The bytes of a row are those of ``shards.row_bytes``."""
    cap = size_in_bytes(max_shard_size)
    if cap < 2:
        raise ValueError("a shard holds two bytes at least")
    named = with_shard(df, order, cap).repartition(shuffle_partitions(df.sparkSession), "shard")
    named.sortWithinPartitions("shard", order).write.mode(mode).partitionBy("shard").parquet(path)
