"""Run metrics as JSON files, one object per worker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

WORKER_SCHEMA = """
    run_tag string, start_time timestamp, end_time timestamp, duration_s double, gen_time_s double,
    notes_seen bigint, notes_written bigint, notes_skipped bigint, notes_failed bigint,
    input_tokens bigint, output_tokens bigint, total_tokens bigint, notes_per_s double,
    input_toks_per_s double, output_toks_per_s double, total_toks_per_s double,
    avg_input_toks_per_note double, avg_output_toks_per_note double
"""
# What run_enrichment adds: which run it was, and with what.
RUN_SCHEMA = WORKER_SCHEMA + ", run_id string, resume boolean, out string, schema_keys string, options string"
BENCH_SCHEMA = """
    run_tag string, start_time timestamp, end_time timestamp, total_time_s double, gen_time_s double,
    notes bigint, batches bigint, input_tokens bigint, output_tokens bigint, total_tokens bigint,
    notes_per_s double, input_toks_per_s double, output_toks_per_s double, total_toks_per_s double,
    avg_input_toks_per_note double, avg_output_toks_per_note double
"""
STAMP = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Append one file per worker row."""
    one_each = metrics.write.mode("append").option("maxRecordsPerFile", 1)
    one_each.option("ignoreNullFields", "false").option("timestampFormat", STAMP).json(path)


def read_metrics(spark: SparkSession, path: str, schema: str = WORKER_SCHEMA) -> DataFrame:
    """The metrics of all workers under ``path``; files that are not valid JSON are passed over."""
    reader = spark.read.schema(schema).option("mode", "DROPMALFORMED").option("multiLine", True)
    return reader.option("pathGlobFilter", "*.json").json(path)
