"""First rows in corpus order, and a seeded pick."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.session import scratch_path, settle

BITS = 16


def first_rows(df: DataFrame, n: int, per_shard: bool = False) -> DataFrame:
    """The first ``n`` rows in corpus order, of the whole table or of each ``shard``. 0 means all.

    The place of the n-th row is found from ``(shard, ord)`` alone, which are stored once: rows are
    counted by the upper 16 bits of ``ord``, a running total tells in which block the n-th row lies, and
    the next 16 bits are looked at within that block, until ``ord`` is known. So no task ever sees more
    than 65,536 counts of a shard, however ``ord`` is spread. The rows themselves are then filtered in
    place, without a sort or a shuffle. The counting runs at once, while the plan is built.
    """
    if n <= 0:
        return df
    shard = F.col("shard") if per_shard else F.lit(0).alias("shard")
    slim = settle(df.select(shard, "ord"), scratch_path(df.sparkSession, "limit"))
    upto = Window.partitionBy("shard").orderBy("_block")
    rows = slim.withColumn("_need", F.lit(n))
    low, high = slim.agg(F.min("ord"), F.max("ord")).first()
    if low is None:
        return df
    # Bits that all rows share tell nothing, so the counting starts below them.
    differing = 64 if low < 0 <= high else (low ^ high).bit_length()
    for shift in range(max(0, -(-differing // BITS) - 1) * BITS, -1, -BITS):
        counts = (
            rows.groupBy("shard", "_need", F.shiftright("ord", shift).alias("_block"))
            .agg(F.count("*").alias("_n"))
            .withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        )
        # One row per shard; the planner broadcasts it where it is small.
        cut = counts.where(
            (F.col("_before") < F.col("_need")) & (F.col("_before") + F.col("_n") >= F.col("_need"))
        ).select("shard", "_block", (F.col("_need") - F.col("_before")).alias("_need"))
        inside = slim.withColumn("_block", F.shiftright("ord", shift))
        rows = inside.join(cut, ["shard", "_block"]).drop("_block")
    cut = cut.select("shard", F.col("_block").alias("_cut"))
    if not per_shard:
        bound = cut.agg(F.max("_cut")).scalar()
        return df.where(F.col("ord") <= F.coalesce(bound, F.lit(2**63 - 1)))
    marked = df.join(cut, "shard", "left")
    return marked.where(F.col("_cut").isNull() | (F.col("ord") <= F.col("_cut"))).select(*df.columns)


def seeded_pick(notes: DataFrame, seed: int) -> DataFrame:
    """One row that depends only on the seed and the ids, not on how the data is laid out."""
    draw = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id"), F.lit(""))))
    return notes.withColumn("_draw", draw).orderBy("_draw", "ord").limit(1).drop("_draw")
