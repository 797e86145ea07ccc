"""Stable assignment of ids to shards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_SHARDS = 2**31


def shard_of(id_col: Column, num_shards: int) -> Column:
    """The 128-bit MD5 of the id, read as one number, modulo ``num_shards``.

    The number does not fit any Spark type, so the remainder is carried over its four 32-bit words.
    """
    if not 1 <= num_shards <= MAX_SHARDS:
        raise ValueError(f"num_shards must be between 1 and {MAX_SHARDS}")
    digest = F.md5(id_col.cast("string"))
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = F.pmod(rest * F.lit(2**32) + word, F.lit(num_shards).cast("bigint"))
    return rest.cast("int")
