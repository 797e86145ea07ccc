"""Read side: one row per list item, and counts over closed vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_list(records: DataFrame, field: str, keep: list[str], outer: bool = True) -> DataFrame:
    """One row per item of a typed list, with its position; ``outer`` keeps records without items."""
    explode = F.posexplode_outer if outer else F.posexplode
    items = records.select(*keep, explode(field).alias("pos", "item"))
    if items.schema["item"].dataType.typeName() == "struct":
        return items.select(*keep, "pos", "item.*")
    return items


def facet_counts(records: DataFrame, facets: list[str]) -> DataFrame:
    """How often each value occurs, for facets such as ``sex`` or ``conditions.status``; one pass.

    Every value of a record becomes one small row, counted before the shuffle.
    """
    values = [_facet_values(records, facet) for facet in facets]
    entries = records.select(F.explode(F.concat(*values)).alias("e")).select("e.facet", "e.value")
    return entries.where(F.col("value").isNotNull()).groupBy("facet", "value").agg(
        F.count("*").alias("n")
    )


def facet_filter(records: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """The records that have, for every facet of ``wanted``, at least one of its values."""
    for facet, values in wanted.items():
        values = [str(v) for v in values]
        records = records.where(F.exists(_facet_values(records, facet), lambda pair: pair["value"].isin(values)))
    return records


def _facet_values(records: DataFrame, facet: str):
    is_list = records.schema[facet.split(".")[0]].dataType.typeName() == "array"
    values = F.col(facet) if is_list else F.array(F.col(facet))
    pairs = F.transform(
        values, lambda v: F.struct(F.lit(facet).alias("facet"), v.cast("string").alias("value"))
    )
    return F.coalesce(pairs, F.array().cast("array<struct<facet: string, value: string>>"))
