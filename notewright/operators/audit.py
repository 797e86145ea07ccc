"""How well do the replies keep to the schema? One pass over the replies, one result row per field."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.functions.fields import OBJECT_LIST, Field, RecordSchema, json_path, type_names
from notewright.functions.prompts import MAX_LIST_ITEMS
from notewright.functions.replies import is_record

# What schema_of_variant calls the values of a JSON type.
VALUE_TYPES = {
    "integer": r"BIGINT|DECIMAL\(\d+,0\)",
    "number": r"BIGINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\)",
    "string": r"STRING",
    "boolean": r"BOOLEAN",
    "null": r"VOID",
    "object": r"OBJECT<.*>",
    "array": r"ARRAY<.*>",
}


def conformance_audit(
    replies: DataFrame, schema: RecordSchema, max_items: int = MAX_LIST_ITEMS
) -> DataFrame:
    """Count deviations in ``parsed`` per field, over the replies that are records at all.

    ``n_missing``: key absent. ``n_type_mismatch``: value, or list item, of another type; a null scalar
    is fine. ``n_out_of_enum``: value, item or item attribute outside its closed list. ``n_over_limit``:
    lists with more than ``max_items`` items.
    """
    records = replies.where(is_record(F.col("parsed")))
    sums, rows = [F.count("*").alias("n_records")], []
    for at, field in enumerate(schema.fields):
        counts = _scalar_counts(field) if not field.is_list else _list_counts(field, max_items)
        names = [f"{name}_{at}" for name in counts]
        sums += [
            F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias(name)
            for name, count in zip(names, counts.values())
        ]
        rows.append(
            F.struct(
                F.lit(field.name).alias("field"), F.lit(field.kind).alias("kind"), "n_records",
                *(F.col(name).alias(count) for name, count in zip(names, counts)),
            )
        )
    return records.agg(*sums).select(F.inline(F.array(*rows)))


def _scalar_counts(field: Field) -> dict[str, Column]:
    value = F.try_variant_get(F.col("parsed"), field.path, "variant")
    return {
        "n_missing": value.isNull().cast("int"),
        "n_type_mismatch": _wrong_type(value, field.type).cast("int"),
        "n_out_of_enum": _outside(value, field.allowed).cast("int"),
        "n_over_limit": F.lit(0),
    }


def _list_counts(field: Field, max_items: int) -> dict[str, Column]:
    value = F.try_variant_get(F.col("parsed"), field.path, "variant")
    items = F.try_variant_get(F.col("parsed"), field.path, "array<variant>")
    no_list = (value.isNotNull() & items.isNull()).cast("int")
    bad_type = _how_many(items, lambda item: _wrong_type(item, field.type))
    if field.kind == OBJECT_LIST:
        outside = F.lit(0)
        for name, spec in field.attributes.items():
            outside += _how_many(items, _attribute_outside(name, spec.get("enum")))
    else:
        outside = _how_many(items, lambda item: _outside(item, field.allowed))
    return {
        "n_missing": value.isNull().cast("int"),
        "n_type_mismatch": no_list + bad_type,
        "n_out_of_enum": outside,
        "n_over_limit": F.coalesce(F.size(items) > max_items, F.lit(False)).cast("int"),
    }


def _attribute_outside(name: str, allowed: list | None):
    path = json_path(name)
    return lambda item: _outside(F.try_variant_get(item, path, "variant"), allowed)


def _how_many(items: Column, test) -> Column:
    return F.coalesce(F.size(F.filter(items, test)), F.lit(0))


def _wrong_type(value: Column, declared) -> Column:
    """A value that is there and is neither null nor of one of the declared types."""
    names = type_names(declared)
    if not names:
        return F.lit(False)
    if names == ["object"]:
        return value.isNotNull() & ~is_record(value)
    pattern = "|".join(VALUE_TYPES[n] for n in [*names, "null"] if n in VALUE_TYPES)
    return F.coalesce(~F.schema_of_variant(value).rlike(rf"\A(?:{pattern})\z"), F.lit(False))


def _outside(value: Column, allowed: list | None) -> Column:
    if not allowed:
        return F.lit(False)
    known = [a if isinstance(a, str) else json.dumps(a) for a in allowed if a is not None]
    return F.coalesce(~F.try_variant_get(value, "$", "string").isin(known), F.lit(False))
