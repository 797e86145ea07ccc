"""Inputs of the registered queries, derived from the given tables.

Each view is a table and one or more select lists in SQL that Spark and DuckDB read alike, so both sides
start from the same rows. No view leaves out a row of its table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notewright.functions.fields import RecordSchema, parse_schema

EXAMPLE_SCHEMA = {
    "json_schema": {
        "name": "note_record",
        "schema": {
            "type": "object",
            "properties": {
                "age": {"type": "integer", "description": "Age in years"},
                "sex": {"type": "string", "enum": ["M", "F"]},
                "chief_complaint": {"type": "string", "examples": ["chest pain"]},
                "conditions": {
                    "type": "array",
                    "description": "Medical problems",
                    "items": {
                        "type": "object",
                        "properties": {
                            "name": {"type": "string"},
                            "status": {
                                "type": "string",
                                "enum": ["present", "negated", "uncertain", "historical"],
                            },
                        },
                    },
                },
                "specialties": {
                    "type": "array",
                    "items": {"type": "string", "enum": ["cardiology", "oncology", "other"]},
                },
            },
        },
    }
}


def example_schema() -> RecordSchema:
    return parse_schema(EXAMPLE_SCHEMA)


NOTE_ID = """
CASE doc_id % 8
  WHEN 0 THEN 'usmle-' || CAST(doc_id AS STRING)
  WHEN 1 THEN 'usmle-' || CAST(doc_id AS STRING)
  WHEN 2 THEN 'pmc-' || CAST(8000000 + doc_id AS STRING) || '-1'
  WHEN 3 THEN 'trec-cds-' || CAST(2014 + doc_id % 3 AS STRING) || '-' || CAST(doc_id AS STRING)
  WHEN 4 THEN 'trec-ct-' || CAST(2021 + doc_id % 3 AS STRING) || '-' || CAST(doc_id AS STRING)
  WHEN 5 THEN '  PMC-' || CAST(8000000 + doc_id AS STRING) || '-2 '
  WHEN 6 THEN 'unknown-' || CAST(doc_id AS STRING)
  ELSE CASE WHEN doc_id % 16 = 7 THEN NULL ELSE '' END
END AS id"""

NOTE_TEXT = """
CASE WHEN doc_id % 50 = 49 THEN NULL WHEN doc_id % 50 = 10 THEN '' ELSE text END AS note"""

# The JSON object of a good reply.
REPLY_OBJECT = """
'{"age":' || CAST(n_chars % 100 AS STRING) || ',"sex":"' || CASE WHEN doc_id % 2 = 0 THEN 'F' ELSE 'M' END
|| '","conditions":[{"name":"' || lang || '","status":"'
|| CASE doc_id % 3 WHEN 0 THEN 'present' WHEN 1 THEN 'negated' ELSE 'maybe' END
|| '"}],"specialties":["other"]}' AS j"""

# Ten classes of replies. Salvage reads 0, 1, 2, 3, 6, 7 and 8; structured reading fails on 6 too.
REPLY_TEXT = """
CASE ord % 10
  WHEN 0 THEN j
  WHEN 1 THEN 'Sure:' || chr(10) || j || chr(10) || 'Done.'
  WHEN 2 THEN '```json' || chr(10) || j || chr(10) || '```'
  WHEN 3 THEN '{"age":5,"conditions":[{"name":"x","status":"present"},],}'
  WHEN 4 THEN j || ' and ' || j
  WHEN 5 THEN 'No fields found.'
  WHEN 6 THEN '[' || j || ']'
  WHEN 7 THEN '{"age":"62","conditions":"none known","extra":1}'
  WHEN 8 THEN '{}'
  ELSE '{"age":5,"conditions":[{"name":"x"'
END AS raw_output"""

VIEWS: dict[str, tuple[str, list[list[str]]]] = {
    "notes": ("documents", [["doc_id AS ord", NOTE_ID, NOTE_TEXT]]),
    "replies": (
        "documents", [["doc_id AS ord", REPLY_OBJECT], ["ord", REPLY_TEXT]],
    ),
    "answered_notes": (
        "documents",
        [
            ["doc_id AS ord", NOTE_ID, NOTE_TEXT, REPLY_OBJECT],
            ["ord", "id", "note", REPLY_TEXT],
        ],
    ),
    "qbank": (
        "documents",
        [[
            "doc_id AS ord",
            "CASE WHEN doc_id % 40 = 3 THEN 'n/a' ELSE CAST(doc_id + 7 AS STRING) END AS idx_raw",
            "CASE WHEN doc_id % 30 = 4 THEN NULL WHEN doc_id % 8 = 1 AND doc_id % 3 <> 0"
            " THEN text || ' [reworded]' ELSE text END AS question",
        ]],
    ),
    "lookup_entries": (
        "documents",
        [[
            "doc_id AS ord",
            "'USMLE-' || CAST(doc_id - doc_id % 2 AS STRING) AS raw_key",
            "CASE WHEN doc_id % 7 = 5 THEN 'n/a' ELSE CAST(doc_id + 7 AS STRING) END AS raw_value",
        ]],
    ),
    "resume_log": (
        "documents",
        [[
            "CASE WHEN doc_id % 3 <> 0 THEN ''"
            " WHEN doc_id % 9 = 0 THEN ' usmle-' || CAST(doc_id AS STRING) || ' '"
            " WHEN doc_id % 9 = 3 THEN '   '"
            " ELSE 'usmle-' || CAST(doc_id - doc_id % 2 AS STRING) END AS line",
        ]],
    ),
    "batch_log": (
        "events",
        [[
            "event_id AS batch_id",
            "'r' || CAST(user_id % 4 AS STRING) AS run_tag",
            "CAST(ts AS TIMESTAMP) AS start_ts",
            "CAST(ts + INTERVAL 2 SECOND AS TIMESTAMP) AS end_ts",
            "event_id % 40 + 5 AS seen",
            "event_id % 32 + 1 AS written",
            "CASE WHEN event_type = 'signup' THEN 3 ELSE 0 END AS skipped",
            "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS failed",
            "CAST(floor(value) AS BIGINT) AS input_tokens",
            "event_id % 700 AS output_tokens",
            "CAST(floor(value) AS BIGINT) * 3 AS gen_ms",
        ]],
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of a table as a stream, whether it is one file or a folder of files."""
    # A pattern, as a stream takes a plain path for a folder.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}.parque[t]")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, stages = VIEWS[name]
    return apply_stages(table(spark, sf_dir, source), stages)


def apply_stages(df: DataFrame, stages: list[list[str]]) -> DataFrame:
    for exprs in stages:
        df = df.selectExpr(*exprs)
    return df


def view_sql(name: str) -> str:
    source, stages = VIEWS[name]
    for exprs in stages:
        source = f"SELECT {', '.join(e.strip() for e in exprs)} FROM {source}"
        if exprs is not stages[-1]:
            source = f"({source}) AS s"
    return source
