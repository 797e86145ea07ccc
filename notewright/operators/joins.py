"""Equi-joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.session import shuffle_partitions

# Rows without a key go into this many pieces for each shuffle partition, so that they fill the tasks evenly.
LONE_PIECES = 64
# The largest sketch that Spark allows.
MOST_TRACKED = 1_000_000
# The sketches of the tasks are merged in this many groups first, and not all in one place.
SKETCH_GROUPS = 512


def heavy_keys(df: DataFrame, key: str, parts: int) -> list[tuple[int, int]]:
    """Hashes of the keys with more rows than an even share of ``parts``, and into how many pieces to cut each.

    A piece is at most a quarter of an even share, so that two pieces that meet in one task do no harm.
    There are fewer than ``parts`` such keys, whatever the data, and their pieces together are at most
    ``5 * parts``; so this list is bounded by a setting of the session and not by the data. Runs a job.

    The counts come from a frequent-items sketch of fixed size per task; no key is shuffled. A sketch may
    miss a key near the limit. That costs balance and never changes a result.
    """
    kept = parts
    tracked = max(kept, min(max(4096, 16 * kept), MOST_TRACKED))
    hashed = df.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"))
    groups = hashed.groupBy(F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("g")).agg(
        F.expr(f"approx_top_k(h, {kept}, {tracked})").alias("top"), F.count("*").alias("n")
    )
    # The number of all rows travels along as the count of no key, and is the largest of them.
    whole = F.array(F.struct(F.lit(None).cast("bigint").alias("item"), F.col("n").alias("count")))
    counts = groups.select(F.inline(F.concat("top", whole))).groupBy("item").agg(F.sum("count"))
    largest = dict(counts.orderBy(F.desc("sum(count)")).limit(kept + 1).collect())
    total = largest.pop(None, 0)
    return [(h, -(-n * 4 * parts // total)) for h, n in largest.items() if n * parts > total]


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str, spread_by: str,
    keys: DataFrame | None = None, parts: int | None = None, heavy: list[tuple[int, int]] | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` on ``key`` with the heavy keys of ``left`` spread over many tasks.

    Rows of a heavy key get a piece number from ``spread_by``, and the matching rows of ``right`` are
    repeated once per piece; all other rows are joined as usual. Rows without a key match nothing and
    are spread too. For a left or inner join ``right`` should hold few rows per key; for the other two
    only its distinct keys count, and repeats are taken out before they are shuffled. The result is that
    of the plain join.

    ``keys`` are the keys to look for heavy ones in, by default those of ``left``. A column that holds
    them all, and more, serves as well; give it where ``left`` is costly to compute. ``heavy`` is a list
    that :func:`heavy_keys` made before, so that one pass serves several joins. Without it this looks for
    heavy keys at once, which is a job of its own.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(f"join type not supported: {how}")
    if left.schema[key].dataType != right.schema[key].dataType:
        raise TypeError(f"{key} is not of one type on both sides")
    if how in ("left_anti", "left_semi"):
        right = right.select(key).distinct()
    spark = left.sparkSession
    parts = parts or shuffle_partitions(spark)
    if heavy is None:
        heavy = heavy_keys((left if keys is None else keys).select(key), key, parts)
    columns = left.columns
    if how in ("left", "inner"):
        columns = columns + [c for c in right.columns if c != key]
    if not heavy and how in ("inner", "left_semi"):
        return left.join(right, key, how).select(*columns)
    lone = F.lit(parts * LONE_PIECES)
    pieces = F.when(F.col(key).isNull(), lone).otherwise(F.lit(1))
    # Always 0, but computed: a plain 0 would be folded into a condition, the piece would no longer be
    # part of the join key, and all rows without a key would meet in one task.
    spread, repeated = left, right.withColumn("_piece", F.pmod(F.xxhash64(key), F.lit(1)).cast("int"))
    if heavy:
        known = F.broadcast(spark.createDataFrame(heavy, "_hash bigint, _pieces int"))
        hashed = F.xxhash64(key).alias("_hash")
        pieces = F.when(F.col(key).isNotNull(), F.col("_pieces")).otherwise(lone)
        pieces = F.coalesce(pieces, F.lit(1))
        spread = left.select("*", hashed).join(known, "_hash", "left")
        last = F.coalesce(F.col("_pieces"), F.lit(1)) - F.lit(1)
        repeated = right.select("*", hashed).join(known, "_hash", "left").withColumn(
            "_piece", F.explode(F.sequence(F.lit(0), last))
        )
    piece = F.pmod(F.xxhash64(spread_by), pieces.cast("bigint")).cast("int")
    spread = spread.withColumn("_piece", piece).drop("_pieces", "_hash")
    repeated = repeated.drop("_pieces", "_hash")
    return spread.join(repeated, [key, "_piece"], how).select(*columns)
