"""Shards of nearly equal size by longest-processing-time scheduling, with equal texts kept together.

Scheduling runs in two rounds, each with a heap of loads and the largest item first. In the first round every
task schedules its own groups of equal texts into ``BINS`` bins. In the second the bins and the large groups
are scheduled into the shards. A group is large if it has more than 1 in ``LARGE`` of all bytes or rows, so there
are fewer than ``2 * LARGE`` of them. The second round sees at most that many groups and ``BINS`` bins a task,
whatever the data holds; rows and small groups never meet in one place.

Null and empty texts are equal texts of size 1. Repeated rows, and rows without an id, each get a slot.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.base import ready, texts
from notewright.session import scratch_path, settle, shuffle_partitions

BINS = 256
LARGE = 16_384


def least_loaded(loads: np.ndarray, heap: list[tuple[int, int]]) -> np.ndarray:
    """For each load in turn the place with the least load so far; ``heap`` is kept up to date."""
    chosen = np.empty(len(loads), dtype=np.int64)
    for k, load in enumerate(loads.tolist()):
        total, place = heap[0]
        heapq.heapreplace(heap, (total + load, place))
        chosen[k] = place
    return chosen


def _schedule(places: int, by_task: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = TaskContext.get().partitionId() * places if by_task else 0
        heap = [(0, first + place) for place in range(places)]
        for batch in batches:
            yield batch.assign(place=least_loaded(batch["load"].to_numpy(), heap))

    return run


def group_shards(groups: DataFrame, n_shards: int, bins: int = BINS) -> tuple[DataFrame, DataFrame]:
    """``(key, shard)`` of the small and of the large groups of ``(key, load, rows)``, where a key occurs once."""
    spark = groups.sparkSession
    groups = settle(groups, scratch_path(spark, "groups"))
    total = groups.agg(F.sum("load"), F.sum("rows")).first()
    large = (F.col("load") > F.lit((total[0] or 0) // LARGE)) | (F.col("rows") > F.lit((total[1] or 0) // LARGE))
    small = groups.where(~large).repartition(shuffle_partitions(spark), "key")
    small = small.sortWithinPartitions(F.desc("load"), "key").select("key", "load")
    binned = small.mapInPandas(_schedule(bins, by_task=True), "key binary, load bigint, place bigint")
    binned = settle(binned, scratch_path(spark, "bins"))
    alone = groups.where(large).select("key", "load", F.lit(None).cast("bigint").alias("bin"))
    items = binned.groupBy(F.col("place").alias("bin")).agg(F.sum("load").alias("load"))
    items = items.select(F.lit(None).cast("binary").alias("key"), "load", "bin").unionByName(alone)
    # Bounded by settings: see above.
    placed = items.repartition(1).sortWithinPartitions(F.desc("load"), "key", "bin").mapInPandas(
        _schedule(n_shards, by_task=False), "key binary, load bigint, bin bigint, place bigint"
    )
    placed = settle(placed, scratch_path(spark, "places"))
    bins_to = placed.where(F.col("bin").isNotNull()).select(F.col("bin").alias("place"), F.col("place").alias("s"))
    shards = binned.join(F.broadcast(bins_to), "place").select("key", F.col("s").cast("int").alias("shard"))
    apart = placed.where(F.col("bin").isNull())
    return shards, apart.select("key", F.col("place").cast("int").alias("shard"))


def balanced_shards(docs: DataFrame, n_shards: int = 8, bins: int = BINS) -> DataFrame:
    """``(doc_id, size, text_crc32, key, shard, slot)`` for every row of ``docs``.

    ``size`` is the text's bytes plus one, ``key`` the SHA-256 of the text, ``slot`` the place in the shard.
    """
    spark = ready(docs.sparkSession)
    raw = F.col("text").cast("binary")
    rows = texts(docs).select(
        "doc_id",
        (F.octet_length("text").cast("bigint") + F.lit(1)).alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.unhex(F.sha2(raw, 256)).alias("key"),
    )
    rows = settle(rows, scratch_path(spark, "sizes"))
    groups = rows.groupBy("key").agg(F.sum("size").alias("load"), F.count("*").alias("rows"))
    small, large = group_shards(groups, n_shards, bins)
    # Large groups are few, so they are broadcast and their rows stay where they are; no other key is hot.
    marked = rows.join(F.broadcast(large.withColumnRenamed("shard", "_large")), "key", "left")
    here = marked.where(F.col("_large").isNotNull()).withColumnRenamed("_large", "shard")
    rest = marked.where(F.col("_large").isNull()).drop("_large").join(small, "key")
    return _with_slots(settle(here.unionByName(rest), scratch_path(spark, "shards")))


def _with_slots(rows: DataFrame) -> DataFrame:
    """Numbers the rows of each shard without a gap, from counts of many small pieces of it."""
    pieces = 4 * shuffle_partitions(rows.sparkSession)
    rows = rows.withColumn("_piece", F.pmod(F.xxhash64("doc_id", "key"), F.lit(pieces)).cast("int"))
    counts = rows.groupBy("shard", "_piece").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_piece", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_piece").orderBy("doc_id", "key")
    numbered = rows.withColumn("_place", F.row_number().over(inside))
    placed = numbered.join(F.broadcast(starts), ["shard", "_piece"])  # one row a piece, bounded by settings
    return placed.select(
        "doc_id", "size", "text_crc32", "key", "shard", (F.col("_start") + F.col("_place") - F.lit(1)).alias("slot")
    )
