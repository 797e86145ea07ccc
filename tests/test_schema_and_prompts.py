import json

from pyspark.sql import functions as F

from notewright.catalog.fixtures import EXAMPLE_SCHEMA, example_schema
from notewright.functions.fields import load_schema, parse_schema
from notewright.functions.prompts import plain_prompt, system_prompt
from notewright.operators.generate import chat_prompt, token_counter


def wrap(properties):
    return {"json_schema": {"schema": {"type": "object", "properties": properties}}}


def test_fields_are_classified(tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(
        json.dumps(wrap({
            "wards": {"type": "array", "items": {"type": "string", "enum": ["north", "south", "icu"]}},
            "weight": {"type": "number", "examples": [61.5, 80]},
            "devices": {"type": "array", "items": {"properties": {"serial": {"type": "string"}, "year": {"type": "integer"}}}},
            "bare": {"type": "array"},
            "maybe": {"type": ["array", "null"]},
        }))
    )
    schema = load_schema(str(path))
    assert schema.keys == ["weight", "maybe", "wards", "devices", "bare"]
    assert [f.kind for f in schema.fields] == [
        "scalar", "scalar", "scalar_list", "object_list", "scalar_list"
    ]
    assert schema["wards"].allowed == ["north", "south", "icu"] and schema["wards"].type == "string"
    assert schema["weight"].example == 61.5
    assert schema["bare"].type == "string"


def test_spark_types():
    schema = parse_schema(wrap({
        "i": {"type": ["integer", "null"]}, "u": {"type": ["integer", "string"]}, "n": {},
        "o": {"type": "array", "items": {"properties": {
            "a": {"type": "number"},
            "m": {"type": "array", "items": {"properties": {"v": {"type": "string"}}}},
        }}},
    }))
    assert [f.item_type for f in schema.fields] == [
        "bigint", "variant", "variant", "struct<`a`: double, `m`: array<struct<`v`: string>>>"
    ]


def test_system_prompt_names_allowed_values():
    prompt = system_prompt(example_schema())
    assert "one of ['M', 'F'] or null." in prompt
    assert '"status": string (one of [\'present\', \'negated\', \'uncertain\', \'historical\'])' in prompt
    assert "is a list of string values (one of ['cardiology', 'oncology', 'other'])." in prompt
    assert prompt.endswith(".\n")


def test_system_prompt_of_a_plain_schema():
    prompt = system_prompt(parse_schema(wrap({
        "a": {"type": "string"}, "l": {"type": "array", "items": {"type": "object"}},
        "s": {"type": "array", "items": {"type": ["string", "null"]}},
    })))
    tail = prompt.split("relevant).\n")[1]
    assert tail == '- "l" is a list of objects\n- "s" is a list of string|null values.\n'


def test_prompt_layouts(spark):
    schema = example_schema()
    notes = spark.createDataFrame([("one",), ("boom",)], "note string")

    def layout():
        def lay(system, user):
            if "boom" in user:
                raise ValueError("no")
            return f"<{len(system)}|{user}>"
        return lay

    def broken():
        raise TypeError("no template")

    plain = [r[0] for r in notes.select(plain_prompt(F.col("note"), schema)).collect()]
    made = [r[0] for r in notes.select(chat_prompt(F.col("note"), schema, layout)).collect()]
    none = [r[0] for r in notes.select(chat_prompt(F.col("note"), schema, broken)).collect()]
    assert none == plain
    assert made[1] == plain[1] and made[0].startswith(f"<{len(system_prompt(schema))}|Extract")
    assert json.dumps(list(schema.keys)) in plain[0]
    assert EXAMPLE_SCHEMA["json_schema"]["schema"]["properties"].keys() == set(schema.keys)


def test_token_counter_hook(spark):
    def letters():
        def encode(text):
            if text == "bad":
                raise ValueError
            return list(text)
        return encode

    def missing():
        raise ImportError

    df = spark.createDataFrame([("abcd",), ("bad",), (None,), ("a b",)], "t string")
    count = lambda make: [r[0] for r in df.select(token_counter(make)(F.col("t"))).collect()]
    assert count(letters) == [4, 0, 0, 3]
    assert count(missing) == [0, 0, 0, 0]
    assert count(None) == [1, 1, 0, 2]
