"""From a parsed reply to the declared fields, and the pieces of which reading a reply is made."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewright.functions.fields import Field, RecordSchema
from notewright.functions.text import PY_SPACE


def listed_with_mark(text: Column) -> Column:
    """The text parsed as the first item of a list whose second and last item is a hash of the text.

    Spark's parser stops after the first JSON value and ignores whatever follows. In the list, trailing
    content is either an error or moves the hash from its place, and no text holds its own hash.
    """
    mark = F.xxhash64(text).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), text, F.lit(","), mark, F.lit("]")))


def whole_value(listed: Column, text: Column) -> Column:
    """The value in such a list, null where the text was not exactly one JSON value."""
    closed = (F.try_variant_get(listed, "$[1]", "bigint") == F.xxhash64(text)) & F.try_variant_get(
        listed, "$[2]", "variant"
    ).isNull()
    return F.when(closed, F.try_variant_get(listed, "$[0]", "variant"))


def outer_braces(text: Column) -> Column:
    """From the first ``{`` to the last ``}``, empty where there is no such span.

    Anchored at the start, so that a text with many ``{`` and no ``}`` is not tried once for each.
    """
    return F.regexp_extract(text, r"(?s)\A[^{]*(\{.*\})", 1)


def drop_trailing_commas(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?U),({PY_SPACE}*[}}\]])", "$1")


def is_record(parsed: Column) -> Column:
    """True for a JSON object; false for null, a missing reply and every other JSON value."""
    return F.try_variant_get(parsed, "$", "struct<>").isNotNull()


def field_variant(parsed: Column, field: Field) -> Column:
    """A declared field as it came, whatever its type. A list field that holds no list becomes []."""
    if not field.is_list:
        return F.try_variant_get(parsed, field.path, "variant")
    items = F.try_variant_get(parsed, field.path, "array<variant>")
    return F.coalesce(items, F.array().cast("array<variant>"))


def field_typed(parsed: Column, field: Field) -> Column:
    """A declared field in its declared type. A list keeps its length: a bad item becomes null."""
    if not field.is_list:
        return F.try_variant_get(parsed, field.path, field.item_type)
    items = field_variant(parsed, field)
    if field.item_type == "variant":
        return items
    return F.transform(items, lambda item: F.try_variant_get(item, "$", field.item_type))


def conform(parsed: Column, schema: RecordSchema, typed: bool = False) -> list[Column]:
    """One column per declared field and nothing else; extra keys are dropped."""
    read = field_typed if typed else field_variant
    return [read(parsed, f).alias(f.name) for f in schema.fields]

