"""The enrichment job: notes in, structured records out.

The steps up to the prompt are narrow apart from the two joins (resume and provenance), which come
before generation so that nothing after it can make a note be generated twice.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from notewright.functions.fields import RecordSchema
from notewright.functions.hashing import shard_of
from notewright.functions.replies import conform, is_record
from notewright.operators.filters import shard_only, valid_notes, with_shard
from notewright.operators.generate import BATCH_SIZE, chat_prompt, token_counter, with_replies
from notewright.operators.joins import salted_join
from notewright.operators.limits import first_rows
from notewright.operators.lookup import with_source_url
from notewright.operators.metrics import worker_metrics
from notewright.operators.replies import with_parsed
from notewright.operators.resume import without_done
from notewright.session import path_exists, scratch_path, settle
from notewright.sources.shards import SHARD_SIZE, write_record_lines


@dataclass(frozen=True)
class EnrichOptions:
    """What to run. ``shard`` picks one shard; with ``num_shards`` alone all shards run in this job."""

    structured: bool = True
    typed: bool = False
    num_shards: int = 1
    shard: int | None = None
    max_notes: int = 0  # of each shard; 0 means all
    batch_size: int = BATCH_SIZE
    generator_tasks: int = 0  # tasks to spread generation over; 0 leaves the partitions as they are


def select_notes(
    notes: DataFrame, options: EnrichOptions = EnrichOptions(), done: DataFrame | None = None
) -> DataFrame:
    """Validity, then shard, then what is done already, then the limit."""
    rows = valid_notes(notes)
    if options.num_shards > 1:
        if options.shard is not None:
            rows = shard_only(rows, options.num_shards, options.shard)
        rows = with_shard(rows, options.num_shards)
    if done is not None:
        rows = without_done(rows, done, notes.select("id"))
    return first_rows(rows, options.max_notes, per_shard="shard" in rows.columns)


def with_prompt(
    notes: DataFrame, schema: RecordSchema, make_layout: Callable | None = None, extra: dict | None = None
) -> DataFrame:
    return notes.withColumn("prompt", chat_prompt(F.col("note"), schema, make_layout, extra))


def records(
    replies: DataFrame, schema: RecordSchema, structured: bool = True, typed: bool = False,
    created_at: Column | None = None, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One record per reply, good or failed, from ``(id, note, source, raw_output)``.

    A failed record keeps the raw reply and has null in every schema field. ``typed`` gives the fields
    their declared types; without it they stay variants, exactly as the model wrote them.
    """
    parsed = with_parsed(replies, structured).withColumn("_ok", is_record(F.col("parsed")))
    fields = [
        F.when(F.col("_ok"), column).alias(name)
        for name, column in zip(schema.keys, conform(F.col("parsed"), schema, typed))
    ]
    created = [] if created_at is None else [created_at.alias("created_at")]
    return parsed.select(
        *keep, "id", F.col("note").alias("patient_note"), "source", *fields,
        F.col("_ok").alias("extraction_ok"),
        F.when(~F.col("_ok"), F.col("raw_output")).alias("model_output_raw"), *created,
    )


def enrich(
    notes: DataFrame, schema: RecordSchema, make_generator: Callable,
    options: EnrichOptions = EnrichOptions(), lookup: DataFrame | None = None,
    done: DataFrame | None = None, make_layout: Callable | None = None, layout_extra: dict | None = None,
    count_tokens: Callable[[Column], Column] | None = None, observation: Observation | None = None,
) -> DataFrame:
    """Records for all selected notes. ``observation`` collects the counters of the run."""
    chosen = with_source_url(select_notes(notes, options, done), lookup, notes.select("id"))
    if options.generator_tasks:
        # By size alone, few large partitions would be left, and generation takes far longer than this.
        chosen = chosen.repartition(options.generator_tasks, "ord")
    called = with_replies(
        with_prompt(chosen, schema, make_layout, layout_extra), make_generator, batch_size=options.batch_size
    )
    replies = called.withColumn("raw_output", F.coalesce("call.text", F.lit("")))
    keep = ("shard",) if "shard" in replies.columns else ()
    if observation is None:
        return records(
            replies, schema, options.structured, options.typed, F.current_timestamp(), keep
        )
    count = count_tokens or token_counter()
    counted = replies.withColumn("_input", count(F.col("prompt"))).withColumn(
        "_output", F.coalesce("call.tokens", count(F.col("raw_output")))
    )
    counters = ("_input", "_output", "call")
    full = records(
        counted, schema, options.structured, options.typed, F.current_timestamp(), keep + counters
    )
    return full.observe(
        observation,
        F.count("*").alias("written"),
        F.count_if(~F.col("extraction_ok")).alias("failed"),
        F.sum("_input").alias("input_tokens"),
        F.sum("_output").alias("output_tokens"),
        F.sum("call.gen_ms").alias("gen_ms"),
    ).drop(*counters)


def run_enrichment(
    notes: DataFrame, schema: RecordSchema, make_generator: Callable, out: str, run_tag: str = "all",
    options: EnrichOptions = EnrichOptions(), done: DataFrame | None = None,
    write: Callable[[DataFrame, str], None] | None = None, shard_size: int = SHARD_SIZE,
    resume: bool = False, run_id: str | None = None, **more,
) -> DataFrame:
    """Write the records under ``out`` and return the one-row metrics of the run, with what the run was.

    Records are JSON lines of two shapes unless ``write`` says otherwise. ``resume`` leaves out the ids that are
    in ``out`` already, be it in JSON lines or Parquet; ``done`` names them from elsewhere.

    The counters of the written rows come from the writing stage itself, where each task counts once
    however often it was tried. A lost executor costs only its unfinished tasks: what a task generated
    and wrote stays. What was seen and skipped is counted in a pass of its own, as a stage before a
    shuffle may run twice and would then count twice.
    """
    write = write or (lambda df, path: write_record_lines(df, path, shard_size))
    if resume and done is None:
        done = done_before(notes.sparkSession, out)
    counted = Observation()
    seen, skipped = _seen_and_skipped(notes, options, done)
    begin = dt.datetime.now(dt.timezone.utc)
    write(enrich(notes, schema, make_generator, options, done=done, observation=counted, **more), out)
    end = dt.datetime.now(dt.timezone.utc)
    got = counted.get
    row = (
        run_tag, begin, end, seen, got["written"], skipped, got["failed"],
        got["input_tokens"] or 0, got["output_tokens"] or 0, round(got["gen_ms"] or 0),
    )
    log = notes.sparkSession.createDataFrame(
        [row],
        "run_tag string, start_ts timestamp, end_ts timestamp, seen bigint, written bigint, "
        "skipped bigint, failed bigint, input_tokens bigint, output_tokens bigint, gen_ms bigint",
    )
    described = {
        "run_id": run_id or uuid.uuid4().hex, "resume": resume, "out": out, "schema_keys": ",".join(schema.keys),
        "options": json.dumps(asdict(options), sort_keys=True),
    }
    return worker_metrics(log).withColumns({name: F.lit(value) for name, value in described.items()})


def done_before(spark: SparkSession, out: str) -> DataFrame:
    """``(id)`` of the records under ``out``, copied to shared storage, as ``out`` is about to change."""
    ids = spark.createDataFrame([], "id string")
    if path_exists(spark, out):
        for fmt, files in (("parquet", "*.parquet"), ("json", "*.{json,jsonl,txt}")):
            stored = spark.read.schema("id string").option("pathGlobFilter", files).format(fmt).load(out).select("id")
            ids = ids.unionByName(stored)
    return settle(ids.dropna(), scratch_path(spark, "done"))


def _seen_and_skipped(
    notes: DataFrame, options: EnrichOptions, done: DataFrame | None
) -> tuple[int, int]:
    """Valid notes, and those of this run that were done before; up to where a limit stops the run."""
    valid = valid_notes(notes).select("ord", "id")
    if options.max_notes:
        chosen = select_notes(notes, options, done)
        stop = chosen.agg(F.max("ord").alias("ord"), F.count("*").alias("n")).first()
        shards = options.num_shards if options.shard is None else 1
        if stop["n"] >= options.max_notes * shards:
            valid = valid.where(F.col("ord") <= stop["ord"])
    if done is None:
        return valid.count(), 0
    known = done.select("id").distinct().withColumn("_done", F.lit(True))
    marked = salted_join(valid, known, "id", "left", spread_by="ord", keys=notes.select("id"))
    skipped = F.col("_done")
    if options.num_shards > 1 and options.shard is not None:
        skipped = skipped & (shard_of(F.col("id"), options.num_shards) == options.shard)
    return tuple(marked.agg(F.count("*"), F.count_if(skipped)).first())
