"""Facets of records as bitmaps: filters and drill-down counts without a second look at the records.

A record has a dense number, its place. For each facet value there is a bitmap in pieces of 32,768 places, 4 KB each,
built in one pass and counted down before the shuffle. The index can be stored; it grows with the values in use, not with
the size of the records. A filter is an OR over the values of a facet and an AND over facets, piece by piece, so
no task holds more than the pieces of one stretch of places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.operators.facets import _facet_values

PIECE = 32_768


def _piece(place: Column) -> Column:
    return F.bitmap_bucket_number(place)


def facet_index(records: DataFrame, facets: list[str], place: str = "_place") -> DataFrame:
    """``(facet, value, piece, bits)`` of records with a dense number from 0 on, such as ``sources.rolling.numbered`` gives."""
    values = F.explode(F.concat(*[_facet_values(records, facet) for facet in facets])).alias("e")
    # Numbers from 1 on, as those fill pieces evenly.
    each = records.select((F.col(place) + F.lit(1)).alias("at"), values).where("e.value IS NOT NULL")
    return each.groupBy("e.facet", "e.value", _piece(F.col("at")).alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")
    )


def matching_bits(index: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """``(piece, bits)`` of the records that have, for every facet of ``wanted``, at least one of its values."""
    if not wanted:
        raise ValueError("no facet to filter by")
    chosen = F.lit(False)
    for facet, values in wanted.items():
        chosen = chosen | ((F.col("facet") == facet) & F.col("value").isin([str(v) for v in values]))
    any_of = index.where(chosen).groupBy("piece", "facet").agg(F.bitmap_or_agg("bits").alias("bits"))
    all_of = any_of.groupBy("piece").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    return all_of.where(F.col("n") == len(wanted)).drop("n")


def filtered_counts(index: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """``(facet, value, n)``: how many of the matching records have each value, from the index alone."""
    chosen = matching_bits(index, wanted).withColumnRenamed("bits", "chosen")
    # Two bitmaps for each value and piece, and their intersection.
    both = index.join(chosen, "piece").select("facet", "value", "piece", F.explode(F.array("bits", "chosen")).alias("b"))
    each = both.groupBy("facet", "value", "piece").agg(F.bitmap_and_agg("b").alias("bits"))
    counts = each.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    return counts.where("n > 0")


def matching_records(records: DataFrame, bits: DataFrame, place: str = "_place") -> DataFrame:
    """The records whose bit is set. A piece has 32,768 records at most, so no key of this join is hot."""
    at = F.col(place) + F.lit(1)
    met = records.withColumn("piece", _piece(at)).join(bits, "piece")
    position = F.bitmap_bit_position(at)
    byte = F.substring("bits", (F.floor(position / 8) + 1).cast("int"), F.lit(1))
    number = F.conv(F.hex(byte), 16, 10).cast("int")
    is_set = F.call_function("getbit", number, F.pmod(position, F.lit(8)).cast("int")) == 1
    return met.where(is_set).select(*records.columns)
