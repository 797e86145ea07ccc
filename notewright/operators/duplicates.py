"""Notes with the same text: find the first of each text, list the groups, name the ids to drop.

A text may be shared by any number of rows. So no group is ever collected or ranked: the first place of
a text comes out of a partial aggregate over fixed-width values, and a row is the first of its text if
that place is its own ``ord``. As ``ord`` is unique, that comparison is a join without skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.text import text_key
from notewright.operators.joins import salted_join
from notewright.session import scratch_path, settle

# Longest list in one row of a result. Longer lists go on in further rows, in order.
PIECE = 1 << 14

# Size of the filter that picks the texts of a report.
HEAD_BITS = 1 << 22


def keyed(notes: DataFrame) -> DataFrame:
    """The rows without their text: ``key`` stands for it from here on."""
    others = [c for c in notes.columns if c != "note"]
    return notes.select(*others, text_key(F.col("note")).alias("key"))


def first_of_each_text(rows: DataFrame) -> DataFrame:
    """``(key, first_ord, n_ids)`` for rows ``(ord, id, key)``; rows without a text are left out."""
    return (
        rows.where(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.min("ord").alias("first_ord"), F.count("*").alias("n_ids"))
    )


def mark_first(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Add the other columns of ``firsts`` to the first row of each text; they are null elsewhere."""
    facts = firsts.where(F.col("first_ord").isNotNull()).drop("key")
    return rows.join(facts, F.col("ord") == F.col("first_ord"), "left")


def later_rows(marked: DataFrame) -> DataFrame:
    """``(ord, id, key)`` of the rows whose text an earlier row already has."""
    later = F.col("key").isNotNull() & F.col("first_ord").isNull()
    return marked.where(later).select("ord", "id", "key")


def keep_first(marked: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """First rows and rows without a text, less those whose id belongs to a later row.

    The test is by id: an id that is dropped once is gone entirely.
    """
    dropped = later_rows(marked)
    rest = marked.where(F.col("key").isNull() | F.col("first_ord").isNotNull())
    return salted_join(rest, dropped, "id", "left_anti", spread_by="ord", keys=keys)


def group_members(marked: DataFrame) -> DataFrame:
    """``(key, ord, id)`` of all rows that share their text with another row."""
    heads = marked.where(F.col("n_ids") > 1).select("key", "ord", "id")
    return heads.unionByName(later_rows(marked).select("key", "ord", "id"))


def in_pieces(rows: DataFrame, group: str, value: str, name: str, piece: int = PIECE) -> DataFrame:
    """Lists of ``value`` in corpus order, one row per ``group`` and stretch of ``piece`` ``ord`` values.

    A group of any size gives lists of at most ``piece`` items; read by ``(group, piece)`` they are the
    whole list in order.
    """
    entry = F.struct("ord", F.col(value).alias("v"))
    return (
        rows.withColumn("piece", F.floor(F.col("ord") / F.lit(piece)).cast("bigint"))
        .groupBy(group, "piece")
        .agg(F.sort_array(F.collect_list(entry)).alias("_list"))
        .select(group, "piece", F.col("_list.v").alias(name))
    )


def with_text(groups: DataFrame, notes: DataFrame) -> DataFrame:
    """Put the note text back, read from the row with the same ``ord``.

    A filter of fixed size over the wanted ``ord`` values is applied where the notes are read, so that few
    other texts are shuffled. It never leaves out a wanted one.
    """
    spark = notes.sparkSession
    groups = settle(groups, scratch_path(spark, "heads"))
    place = F.pmod(F.xxhash64("ord"), F.lit(HEAD_BITS))
    words = groups.groupBy(F.floor(place / F.lit(64)).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))).alias("bits")
    )
    wanted = notes.select("ord", "note", F.floor(place / F.lit(64)).cast("int").alias("word"),
                          F.pmod(place, F.lit(64)).cast("int").alias("_bit"))
    # At most HEAD_BITS / 64 rows, whatever the data.
    near = wanted.join(F.broadcast(words), "word")
    near = near.where(F.call_function("getbit", F.col("bits"), F.col("_bit")) == 1)
    return groups.join(near.select("ord", "note"), "ord")
