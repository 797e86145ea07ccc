"""Measure a generator: prompts of some notes go through it, and the counters come back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from notewright.functions.fields import RecordSchema
from notewright.operators.filters import shard_only, valid_bench_notes
from notewright.operators.generate import token_counter, with_replies
from notewright.operators.limits import first_rows
from notewright.operators.metrics import bench_metrics
from notewright.plans.enrich import EnrichOptions, with_prompt

BENCH_NOTES = 500


def run_bench(
    notes: DataFrame, schema: RecordSchema, make_generator: Callable, run_tag: str = "all",
    options: EnrichOptions = EnrichOptions(max_notes=BENCH_NOTES), make_layout: Callable | None = None,
    count_tokens: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """The one-row bench metrics of ``options.max_notes`` notes; nothing is parsed or kept.

    To measure several workers run one shard each with a tag of its own and merge the rows with
    :func:`notewright.operators.metrics.bench_replica_metrics`.
    """
    rows = valid_bench_notes(notes, options.num_shards)
    if options.shard is not None:
        rows = shard_only(rows, options.num_shards, options.shard)
    rows = first_rows(rows, options.max_notes)
    if options.generator_tasks:
        rows = rows.repartition(options.generator_tasks, "ord")
    count = count_tokens or token_counter()
    called = with_replies(
        with_prompt(rows, schema, make_layout), make_generator, batch_size=options.batch_size
    )
    counted = called.select(
        "call",
        count(F.col("prompt")).alias("input"),
        F.coalesce("call.tokens", count(F.coalesce("call.text", F.lit("")))).alias("output"),
    )
    seen = Observation()
    begin = dt.datetime.now(dt.timezone.utc)
    counted.observe(
        seen,
        F.count("*").alias("notes"), F.sum("call.head").alias("batches"),
        F.sum("input").alias("input"), F.sum("output").alias("output"),
        F.sum("call.gen_ms").alias("gen_ms"),
    ).write.format("noop").mode("overwrite").save()
    end = dt.datetime.now(dt.timezone.utc)
    got = {name: value or 0 for name, value in seen.get.items()}
    log = notes.sparkSession.createDataFrame(
        [(run_tag, begin, end, got["notes"], got["batches"], got["input"], got["output"],
          round(got["gen_ms"]))],
        "run_tag string, start_ts timestamp, end_ts timestamp, written bigint, batches bigint, "
        "input_tokens bigint, output_tokens bigint, gen_ms bigint",
    )
    return bench_metrics(log)
