"""Prompt text: the instructions built from the schema, and the prompt of each note."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewright.functions.fields import OBJECT_LIST, SCALAR, Field, RecordSchema, type_names

MAX_LIST_ITEMS = 30

# The prompt wording.
SYSTEM_HEAD = """You extract structured fields from a clinical note.

Return ONE valid JSON object and NOTHING ELSE.

Rules:
- Use null if not present/unknown for scalar fields.
- Use [] (empty list) if none for list fields.
- Do not guess. Only extract what is explicitly supported by the note.
- Keep strings concise. No long sentences.
- Limit each list to at most 30 items (choose the most clinically relevant).
"""
USER_HEAD = "Extract the fields from this clinical note.\n\nNOTE:\n"
USER_KEYS = "\n\nJSON KEYS (must match exactly):\n"
USER_TAIL = "\n"
PLAIN_USER = "\n\nUser:\n"
PLAIN_ASSISTANT = "\n\nAssistant:\n"


def system_prompt(schema: RecordSchema) -> str:
    by_kind = [f for kind in _RULES for f in schema.fields if f.kind == kind]
    rules = [_RULES[f.kind](f) for f in by_kind]
    return SYSTEM_HEAD + "\n".join(r for r in rules if r) + "\n"


def user_prompt(note: Column, schema: RecordSchema) -> Column:
    keys = json.dumps(schema.keys, ensure_ascii=False)
    return F.concat(F.lit(USER_HEAD), note, F.lit(USER_KEYS + keys + USER_TAIL))


def plain_prompt(note: Column, schema: RecordSchema) -> Column:
    """Instructions and note in one plain text, for models without a chat layout of their own."""
    head = F.lit(system_prompt(schema) + PLAIN_USER)
    return F.concat(head, user_prompt(note, schema), F.lit(PLAIN_ASSISTANT))


def _shown(declared: Any) -> str:
    return "|".join(str(n) for n in type_names(declared)) or str(declared)


def _scalar_rule(f: Field) -> str:
    return f'- For "{f.name}": one of {f.allowed} or null.' if f.allowed else ""


def _object_list_rule(f: Field) -> str:
    rule = f'- "{f.name}" is a list of objects'
    if not f.attributes:
        return rule
    shown = []
    for name, spec in f.attributes.items():
        choice = f" (one of {spec['enum']})" if spec.get("enum") else ""
        shown.append(f'"{name}": {_shown(spec.get("type", "string"))}{choice}')
    return f"{rule}: {{{', '.join(shown)}}}"


def _scalar_list_rule(f: Field) -> str:
    choice = f" (one of {f.allowed})" if f.allowed else ""
    return f'- "{f.name}" is a list of {_shown(f.type)} values{choice}.'


# The order of the rules in the prompt, which is not the order of the keys.
_RULES = {SCALAR: _scalar_rule, OBJECT_LIST: _object_list_rule, "scalar_list": _scalar_list_rule}
