"""The declared record schema: which fields a record has and what each may hold."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

SCALAR = "scalar"
OBJECT_LIST = "object_list"
SCALAR_LIST = "scalar_list"

# JSON Schema type name -> Spark type. Anything else stays a variant.
SPARK_TYPES = {"integer": "bigint", "number": "double", "boolean": "boolean", "string": "string"}


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    type: Any = None  # of the value, or of one item for a list of scalars
    allowed: list | None = None
    example: Any = None
    description: str = ""
    attributes: dict[str, dict] = field(default_factory=dict)  # of one item of an object list

    @property
    def is_list(self) -> bool:
        return self.kind != SCALAR

    @property
    def item_type(self) -> str:
        """Spark type of the value, or of one item of a list."""
        if self.kind == OBJECT_LIST:
            return _struct_type(self.attributes)
        return _simple_type(self.type)

    @property
    def path(self) -> str:
        return json_path(self.name)


@dataclass(frozen=True)
class RecordSchema:
    """Declared fields, scalars first and lists after them, each in the order of declaration."""

    fields: tuple[Field, ...]

    @property
    def scalars(self) -> list[Field]:
        return [f for f in self.fields if f.kind == SCALAR]

    @property
    def lists(self) -> list[Field]:
        return [f for f in self.fields if f.is_list]

    @property
    def keys(self) -> list[str]:
        return [f.name for f in self.fields]

    def __getitem__(self, name: str) -> Field:
        return next(f for f in self.fields if f.name == name)


def json_path(name: str) -> str:
    if '"' in name or "\\" in name:
        raise ValueError(f"field name not supported: {name!r}")
    return f'$["{name}"]'


def parse_schema(wrapper: dict) -> RecordSchema:
    """Read the field list out of a JSON Schema wrapper ``{"json_schema": {"schema": {...}}}``.

    Only ``type: "array"`` makes a list. A union such as ``["array", "null"]`` is a scalar.
    """
    properties = wrapper["json_schema"]["schema"]["properties"]
    declared = [_field(name, spec) for name, spec in properties.items()]
    return RecordSchema(tuple(sorted(declared, key=lambda f: f.is_list)))


def load_schema(path: str) -> RecordSchema:
    with open(path, encoding="utf-8") as handle:
        return parse_schema(json.load(handle))


def _field(name: str, spec: dict) -> Field:
    text = spec.get("description", "")
    if spec.get("type") != "array":
        return Field(name, SCALAR, spec.get("type"), spec.get("enum"), _first(spec), text)
    items = spec.get("items") or {}
    attributes = items.get("properties") or {}
    if attributes or items.get("type") == "object":
        return Field(name, OBJECT_LIST, "object", description=text, attributes=attributes)
    item_type = items.get("type") or "string"
    return Field(name, SCALAR_LIST, item_type, items.get("enum"), _first(items), text)


def _first(spec: dict) -> Any:
    examples = spec.get("examples")
    return examples[0] if examples else None


def type_names(declared: Any) -> list[str]:
    """A declared type as a list of names; a union already is one."""
    if declared is None:
        return []
    return list(declared) if isinstance(declared, list) else [declared]


def _simple_type(declared: Any) -> str:
    names = [n for n in type_names(declared) if n != "null"]
    return SPARK_TYPES.get(names[0], "variant") if len(names) == 1 else "variant"


def _struct_type(attributes: dict[str, dict]) -> str:
    if not attributes:
        return "variant"
    parts = (f"`{name}`: {_nested_type(spec)}" for name, spec in attributes.items())
    return f"struct<{', '.join(parts)}>"


def _nested_type(spec: dict) -> str:
    if spec.get("type") == "array":
        return f"array<{_nested_type(spec.get('items') or {'type': 'string'})}>"
    if spec.get("properties"):
        return _struct_type(spec["properties"])
    return _simple_type(spec.get("type", "string"))
