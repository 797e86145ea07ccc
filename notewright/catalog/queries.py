"""The registered queries: every operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from notewright.catalog import fixtures
from notewright.catalog.fixtures import example_schema, stream_table, table, view
from notewright.functions.prompts import plain_prompt
from notewright.functions.replies import conform, is_record
from notewright.functions.text import line_count, text_key_hex, to_whole_number, word_count
from notewright.operators import audit, duplicates, facet_index, facets, filters, limits, matching, metrics, sketches
from notewright.operators.generate import token_counter, with_replies
from notewright.operators.lookup import lookup_table, with_source_url
from notewright.operators.prompts import prompt_variants
from notewright.operators.replies import with_parsed
from notewright.operators.resume import clean_ids, without_done
from notewright.plans import enrich, mapping
from notewright.session import configure, scratch_path, settle, shuffle_partitions
from notewright.sources import notes as note_sources
from notewright.sources import run_log, shards
from notewright.sources.capped import export_capped
from notewright.sources.clustered import append_clustered, without_done_clustered
from notewright.sources.lookup import read_lookup_report
from notewright.sources.rolling import numbered, read_rolled_ids, write_rolled
from notewright.streaming.incremental import start_incremental
from notewright.streaming.stateful import read_log, start_stateful

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

NUM_SHARDS = 7
RATE_COLUMNS = (
    "notes_per_s", "input_toks_per_s", "output_toks_per_s", "total_toks_per_s",
    "avg_input_toks_per_note", "avg_output_toks_per_note",
)


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(configure(spark), sf_dir)

    QUERIES[fn.__name__.rstrip("_")] = run
    return run


# Sources and sinks


@query
def scan_notes(spark, sf_dir):
    return note_sources.read_notes(
        spark, f"{sf_dir}/documents.parquet", id_col="doc_id", note_col="text", order_by="doc_id"
    )


def _as_files(spark, sf_dir, fmt, names):
    """``documents`` under ``names`` in five folders of very different size whose names give the order of ids."""
    path = scratch_path(spark, f"files-{fmt}")
    rows = table(spark, sf_dir, "documents").select(*names)
    ident = F.col("_id").cast("bigint")
    for name, where in (("a", ident % 97 == 0), ("b", (ident % 97 > 1) & (ident % 2 == 0)),
                        ("c", ident % 97 == 1), ("d", (ident % 97 > 1) & (ident % 2 == 1)), ("e", ident.isNull())):
        # The names of a folder's files rise with the ranges.
        spread = rows.where(where).repartitionByRange(shuffle_partitions(spark), ident).sortWithinPartitions(ident)
        spread.write.format(fmt).save(f"{path}/part={name}")
    return path


@query
def scan_notes_files(spark, sf_dir):
    names = [F.col("doc_id").alias("_id"), F.col("text").alias("description")]
    ranks = []
    for fmt in ("parquet", "json"):
        notes = note_sources.read_notes(spark, _as_files(spark, sf_dir, fmt, names), fmt)
        ranks.append(note_sources.ranked(notes.select("ord", "id")).select(F.lit(fmt).alias("fmt"), "_rank", "id"))
    return ranks[0].unionByName(ranks[1]).withColumnRenamed("_rank", "place")


@query
def scan_bank_files(spark, sf_dir):
    names = [F.col("doc_id").alias("_id"), F.col("doc_id").alias("index"), F.col("text").alias("question")]
    ranks = []
    for fmt in ("parquet", "json"):
        bank = note_sources.read_bank(spark, _as_files(spark, sf_dir, fmt, names), fmt)
        ranks.append(note_sources.ranked(bank.select("ord", "idx_raw")).select(F.lit(fmt).alias("fmt"), "_rank", "idx_raw"))
    return ranks[0].unionByName(ranks[1]).withColumnRenamed("_rank", "place")


@query
def qbank_scan_counts(spark, sf_dir):
    return matching.bank_counts(view(spark, sf_dir, "qbank"))


def _lookup(spark, sf_dir):
    entries = view(spark, sf_dir, "lookup_entries").select(
        "ord", F.col("raw_key").alias("key"), to_whole_number(F.col("raw_value")).alias("value")
    )
    return lookup_table(entries)


@query
def lookup_table_(spark, sf_dir):
    return _lookup(spark, sf_dir).withColumnRenamed("row", "bank_row")


@query
def lookup_report(spark, sf_dir):
    path = scratch_path(spark, "report")
    entries = view(spark, sf_dir, "lookup_entries").select(
        "ord", F.lit("all").alias("report"), F.format_string('"%s": "%s"', "raw_key", "raw_value").alias("entry")
    )
    pieces = duplicates.in_pieces(entries, "report", "entry", "entries")
    blob = F.concat(F.lit('{"mapping": {'), F.array_join("entries", ", "), F.lit("}}"))
    pieces.select(blob).write.option("maxRecordsPerFile", 1).text(path)
    return read_lookup_report(spark, path).withColumnRenamed("row", "bank_row")


@query
def record_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    shards.write_record_lines(_records(spark, sf_dir).drop("ord"), path)
    return spark.read.text(path).select(
        F.get_json_object("value", "$.id").alias("id"),
        F.array_join(F.json_object_keys("value"), ",").alias("keys"),
    )


@query
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    shards.write_jsonl(view(spark, sf_dir, "notes"), path, shard_size=1000)
    return shards.read_jsonl(spark, path, "ord bigint, id string, note string")


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    shards.export_parquet(view(spark, sf_dir, "notes"), path, max_shard_size="5MB")
    return spark.read.parquet(path)


@query
def processed_ids_distinct(spark, sf_dir):
    path = scratch_path(spark, "ids")
    shards.write_ids(view(spark, sf_dir, "resume_log").withColumnRenamed("line", "id"), path)
    return shards.read_ids(spark, path)


@query
def union_shards(spark, sf_dir):
    full = _records(spark, sf_dir)
    good = full.where("extraction_ok").select("ord", "id", "age", "extraction_ok")
    failed = full.where(~F.col("extraction_ok")).select(
        "ord", "id", "extraction_ok", "model_output_raw"
    )
    return shards.union_shards(good, failed)


# Filters


@query
def valid_notes(spark, sf_dir):
    return filters.valid_notes(view(spark, sf_dir, "notes"))


@query
def valid_notes_bench(spark, sf_dir):
    notes = view(spark, sf_dir, "notes").withColumn(
        "other_id", F.concat(F.lit("row-"), F.col("ord").cast("string"))
    )
    return filters.valid_bench_notes(notes).select("ord", "id")


@query
def shard_filter(spark, sf_dir):
    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    return filters.shard_only(valid, NUM_SHARDS, 3).select("ord", "id")


@query
def shard_counts(spark, sf_dir):
    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    return filters.with_shard(valid, NUM_SHARDS).groupBy("shard").agg(F.count("*").alias("n"))


@query
def id_family_filter(spark, sf_dir):
    rows = filters.family_notes(view(spark, sf_dir, "notes"), "usmle")
    return rows.select("ord", "id", F.col("num").cast("bigint").alias("num"))


@query
def note_by_id(spark, sf_dir):
    return filters.note_by_id(view(spark, sf_dir, "notes"), "usmle-16")


@query
def nonblank_notes(spark, sf_dir):
    return filters.nonblank_notes(view(spark, sf_dir, "notes")).select("ord", "id")


@query
def failed_extractions(spark, sf_dir):
    parsed = with_parsed(view(spark, sf_dir, "replies"), structured=True)
    return parsed.where(~is_record(F.col("parsed"))).select("ord", "raw_output")


# Joins


@query
def text_match_first(spark, sf_dir):
    notes = filters.family_notes(view(spark, sf_dir, "notes"), "usmle")
    questions = matching.usable_questions(view(spark, sf_dir, "qbank"))
    found = matching.match_first(duplicates.keyed(notes), questions)
    return found.select("ord", "id", F.col("first_idx").alias("bank_row"), "n_candidates")


@query
def resume_anti_join(spark, sf_dir):
    notes = view(spark, sf_dir, "notes")
    done = clean_ids(view(spark, sf_dir, "resume_log"))
    return without_done(filters.valid_notes(notes), done, notes.select("id"))


def _clustered(spark, label, rows, buckets=16):
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    append_clustered(rows, name, path, buckets)
    return name, path


@query
def resume_clustered(spark, sf_dir):
    """Two appended runs of records and the notes, all clustered by id."""
    notes = filters.valid_notes(view(spark, sf_dir, "notes"))
    done = clean_ids(view(spark, sf_dir, "resume_log"))
    record = lambda rows: rows.select("id", F.length("id").cast("bigint").alias("size"))
    table_name, path = _clustered(spark, "records", record(done.where("length(id) % 2 = 0")))
    append_clustered(record(done.where("length(id) % 2 = 1")), table_name, path, 16)
    corpus, _ = _clustered(spark, "corpus", notes)
    return without_done_clustered(spark.table(corpus), table_name)


@query
def source_url(spark, sf_dir):
    notes = view(spark, sf_dir, "notes")
    valid = filters.valid_notes(notes).select("ord", "id")
    return with_source_url(valid, _lookup(spark, sf_dir), notes.select("id"))


@query
def dedup_keep_first(spark, sf_dir):
    rows = settle(_family_rows(spark, sf_dir), scratch_path(spark, "rows"))
    marked = duplicates.mark_first(rows, duplicates.first_of_each_text(rows))
    marked = settle(marked, scratch_path(spark, "marked"))
    return duplicates.keep_first(marked, keys=rows).select("ord", "id")


@query
def prompt_variants_(spark, sf_dir):
    notes = filters.valid_notes(view(spark, sf_dir, "notes"))
    counters = {
        "words": token_counter(),
        "four_chars": lambda text: F.ceil(F.length(text) / F.lit(4)).cast("bigint"),
    }
    return prompt_variants(notes, example_schema(), counters)


# Aggregates and the mapping job


def _family_rows(spark, sf_dir):
    return duplicates.keyed(filters.family_notes(view(spark, sf_dir, "notes"), "usmle"))


def _mapping(spark, sf_dir):
    return mapping.map_notes(view(spark, sf_dir, "notes"), view(spark, sf_dir, "qbank"))


@query
def duplicate_groups(spark, sf_dir):
    groups = _mapping(spark, sf_dir).duplicate_groups
    return groups.select(
        text_key_hex(F.col("key")).alias("text_key"), F.col("id").alias("first_id"), "n_ids", "note"
    )


@query
def duplicate_members(spark, sf_dir):
    members = _mapping(spark, sf_dir).duplicate_members
    return members.select(
        text_key_hex(F.col("key")).alias("text_key"), "piece", F.array_join("ids", ",").alias("ids")
    )


@query
def dropped_duplicates(spark, sf_dir):
    return _mapping(spark, sf_dir).dropped_ids


@query
def qbank_candidates(spark, sf_dir):
    questions = matching.usable_questions(view(spark, sf_dir, "qbank"))
    lists = duplicates.in_pieces(questions, "key", "idx", "candidates")
    return lists.select(
        text_key_hex(F.col("key")).alias("text_key"), "piece",
        F.array_join("candidates", ",").alias("candidates"),
    )


@query
def shift_histogram(spark, sf_dir):
    return _mapping(spark, sf_dir).shift_histogram.withColumn("shift", F.col("shift").cast("bigint"))


@query
def constant_shift(spark, sf_dir):
    found = matching.constant_shift(_mapping(spark, sf_dir).shift_histogram)
    return found.select(F.col("shift").cast("bigint").alias("shift"))


@query
def mapping_summary(spark, sf_dir):
    return _mapping(spark, sf_dir).summary.withColumn("shift", F.col("shift").cast("bigint"))


@query
def mapping_rows(spark, sf_dir):
    return _mapping(spark, sf_dir).mapping.withColumnRenamed("row", "bank_row")


@query
def ambiguous_mappings(spark, sf_dir):
    tables = _mapping(spark, sf_dir)
    return tables.ambiguous.withColumn("candidates", F.array_join("candidates", ","))


@query
def missing_samples(spark, sf_dir):
    return _mapping(spark, sf_dir).missing_samples


# Metrics


def _presented(df):
    """Stamps as microseconds and rates with six places, so that both sides print them alike."""
    for name in ("start_time", "end_time"):
        df = df.withColumn(name.replace("_time", "_us"), F.unix_micros(name)).drop(name)
    for name in df.columns:
        if df.schema[name].dataType.typeName() == "double":
            df = df.withColumn(name, F.round(name, 6))
    return df


@query
def worker_metrics(spark, sf_dir):
    return _presented(metrics.worker_metrics(view(spark, sf_dir, "batch_log")))


@query
def replica_metrics(spark, sf_dir):
    workers = metrics.worker_metrics(view(spark, sf_dir, "batch_log"))
    return _presented(metrics.replica_metrics(workers))


@query
def bench_metrics(spark, sf_dir):
    return _presented(metrics.bench_metrics(view(spark, sf_dir, "batch_log")))


@query
def bench_replica_metrics(spark, sf_dir):
    workers = metrics.bench_metrics(view(spark, sf_dir, "batch_log"))
    return _presented(metrics.bench_replica_metrics(workers))


@query
def metrics_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "metrics")
    run_log.write_metrics(metrics.worker_metrics(view(spark, sf_dir, "batch_log")), path)
    return _presented(metrics.replica_metrics(run_log.read_metrics(spark, path)))


# Limits and picks


@query
def limit_notes(spark, sf_dir):
    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    return limits.first_rows(valid, 500).select("ord", "id")


@query
def limit_per_shard(spark, sf_dir):
    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    first = limits.first_rows(filters.with_shard(valid, NUM_SHARDS), 40, per_shard=True)
    return first.select("shard", "ord", "id")


@query
def sample_note(spark, sf_dir):
    notes = filters.nonblank_notes(view(spark, sf_dir, "notes"))
    return limits.seeded_pick(notes, seed=17)


# Replies to records


def _parsed_fields(replies, structured):
    parsed = with_parsed(replies, structured)
    get = lambda path, kind: F.try_variant_get("parsed", path, kind)
    return parsed.select(
        "ord",
        is_record(F.col("parsed")).alias("ok"),
        get("$.age", "bigint").alias("age"),
        get("$.sex", "string").alias("sex"),
        get("$.conditions[0].name", "string").alias("condition"),
        get("$.conditions[0].status", "string").alias("status"),
        get("$.conditions[1]", "string").alias("second"),
        get("$.extra", "bigint").alias("extra"),
    )


@query
def json_salvage(spark, sf_dir):
    return _parsed_fields(view(spark, sf_dir, "replies"), structured=False)


@query
def structured_parse(spark, sf_dir):
    return _parsed_fields(view(spark, sf_dir, "replies"), structured=True)


@query
def conform_record(spark, sf_dir):
    parsed = with_parsed(view(spark, sf_dir, "replies"), structured=False)
    good = parsed.where(is_record(F.col("parsed")))
    return _flat(good.select("ord", *conform(F.col("parsed"), example_schema(), typed=True)))


def _flat(df):
    return df.withColumns({name: F.to_json(name) for name in ("conditions", "specialties")})


def _records(spark, sf_dir, notes=None):
    notes = view(spark, sf_dir, "answered_notes") if notes is None else notes
    sourced = with_source_url(
        filters.valid_notes(notes), _lookup(spark, sf_dir), notes.select("id")
    )
    return enrich.records(sourced, example_schema(), typed=True, keep=("ord",))


@query
def enriched_records(spark, sf_dir):
    return _flat(_records(spark, sf_dir)).drop("ord")


# Prompts and generation


@query
def render_prompt(spark, sf_dir):
    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    return enrich.with_prompt(valid, example_schema()).select("ord", "prompt")


@query
def prompt_stats(spark, sf_dir):
    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    prompt = plain_prompt(F.col("note"), example_schema())
    return valid.select("ord", prompt.alias("prompt")).select(
        "ord",
        F.length("prompt").cast("bigint").alias("n_chars"),
        line_count(F.col("prompt")).cast("bigint").alias("n_lines"),
        word_count(F.col("prompt")).cast("bigint").alias("n_tokens"),
    )


@query
def token_counts(spark, sf_dir):
    count = token_counter()
    answered = filters.valid_notes(view(spark, sf_dir, "answered_notes"))
    return answered.select(
        "ord",
        count(F.col("note")).alias("input_tokens"),
        count(F.col("raw_output")).alias("output_tokens"),
    )


@query
def batch_generate(spark, sf_dir):
    def echo():
        return lambda prompts: [(f'{{"age":{len(p)}}}', len(p)) for p in prompts]

    valid = filters.valid_notes(view(spark, sf_dir, "notes"))
    replied = with_replies(valid, echo, prompt="note")
    return replied.select(
        "ord", F.col("call.text").alias("raw_output"), F.col("call.tokens").alias("output_tokens")
    )


# Incremental run


@query
def resume_two_runs(spark, sf_dir):
    out = scratch_path(spark, "records")
    stages = fixtures.VIEWS["answered_notes"][1]
    for _ in range(2):
        run = start_incremental(
            filters.valid_notes(fixtures.apply_stages(stream_table(spark, sf_dir, "documents"), stages)),
            lambda notes: _records(spark, sf_dir, notes),
            out,
            scratch_path(spark, "stream"),
        )
        run.awaitTermination()
    written = spark.read.parquet(out)
    return written.select("ord", "id", "source", "age", "extraction_ok")


def _rolled(spark, sf_dir):
    """Two workers' shards of 150 records; the first worker comes twice and leaves out what is there."""
    out, notes = scratch_path(spark, "rolled"), view(spark, sf_dir, "notes")
    write_rolled(notes.where("ord % 4 = 0"), out, "part_w0", "ord", shard_size=150)
    write_rolled(notes.where("ord % 2 = 1"), out, "part_w1", "ord", shard_size=150)
    rest = without_done(notes.where("ord % 2 = 0 AND id IS NOT NULL"), settle(
        read_rolled_ids(spark, out), scratch_path(spark, "ids")))
    write_rolled(rest, out, "part_w0", "ord", shard_size=150)
    return out


@query
def rolled_shards(spark, sf_dir):
    out = _rolled(spark, sf_dir)
    rows = shards.read_jsonl(spark, out, "ord bigint, id string, note string")
    rows = rows.select("*", F.regexp_replace("_metadata.file_name", r"\.jsonl$", "").alias("shard"))
    ids = spark.read.text(f"{out}/_ids").select(
        F.regexp_replace("_metadata.file_name", r"\.ids$", "").alias("shard"), "value"
    )
    ids = ids.groupBy("shard").agg(F.count("*").alias("n_ids"))
    found = rows.groupBy("shard").agg(
        F.count("*").alias("n_records"), F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"),
        F.sum(F.coalesce(F.length("note"), F.lit(0))).alias("n_chars"),
    )
    return found.join(ids, "shard", "left").withColumn("n_ids", F.coalesce("n_ids", F.lit(0)))


@query
def capped_parquet(spark, sf_dir):
    """Sizes of the files of an export whose rows differ in size a thousandfold."""
    path, notes = scratch_path(spark, "capped"), view(spark, sf_dir, "notes")
    export_capped(notes, path, "ord", 64_000)
    rows = spark.read.parquet(path)
    sized = rows.select("shard", F.col("_metadata.file_name").alias("file"), "ord", shards.row_bytes(notes).alias("bytes"))
    return sized.groupBy("shard").agg(
        F.count_distinct("file").alias("n_files"), F.count("*").alias("n_records"), F.sum("bytes").alias("n_bytes"),
        F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord"),
    ).withColumn("above_cap", (F.col("n_bytes") > 64_000) & (F.col("n_records") > 1))


def _json_arrivals(spark, sf_dir):
    """All notes as JSON lines that arrive in two folders, a third of them in both. A note of every eleventh row is
    left out of its line altogether, and a null note is spelled out."""
    path = scratch_path(spark, "arrivals")
    notes = view(spark, sf_dir, "notes")
    line = F.to_json(F.struct(F.col("id").alias("_id"), F.col("note").alias("description")), {"ignoreNullFields": "false"})
    bare = F.to_json(F.struct(F.col("id").alias("_id")), {"ignoreNullFields": "false"})
    lines = notes.select("ord", F.when(F.col("ord") % 11 == 0, bare).otherwise(line).alias("value"))
    lines.where("ord % 3 = 0").select("value").write.text(f"{path}/first")
    lines.select("value").write.text(f"{path}/second")
    return path


def _stateful_runs(spark, sf_dir):
    """The two folders taken up by one run each, with checkpoints of their own."""
    arrivals, out, log = _json_arrivals(spark, sf_dir), scratch_path(spark, "records"), scratch_path(spark, "log")
    for folder in ("first", "second"):
        notes = note_sources.stream_json_notes(spark, f"{arrivals}/{folder}")
        records = lambda fresh: fresh.select(
            "id", F.length("note").cast("bigint").alias("n_chars"), (F.length("note") % 7 > 0).alias("extraction_ok"),
            word_count(F.col("note")).cast("bigint").alias("input_tokens"), F.lit(1).alias("output_tokens"),
        )
        start_stateful(
            filters.valid_notes(notes), records, out, scratch_path(spark, "stream"), log, folder
        ).awaitTermination()
    return out, log


@query
def stateful_json_runs(spark, sf_dir):
    out, _ = _stateful_runs(spark, sf_dir)
    return spark.read.parquet(out).select("id", "n_chars", "extraction_ok")


@query
def stream_metrics(spark, sf_dir):
    _, log = _stateful_runs(spark, sf_dir)
    found = metrics.worker_metrics(read_log(spark, log))
    return found.select(
        "run_tag", "notes_seen", "notes_written", "notes_skipped", "notes_failed", "input_tokens", "output_tokens"
    )


# Audit and read side


@query
def conformance_audit(spark, sf_dir):
    parsed = with_parsed(view(spark, sf_dir, "replies"), structured=False)
    return audit.conformance_audit(parsed, example_schema())


@query
def explode_conditions(spark, sf_dir):
    parsed = with_parsed(view(spark, sf_dir, "replies"), structured=False)
    good = parsed.where(is_record(F.col("parsed")))
    typed = good.select("ord", *conform(F.col("parsed"), example_schema(), typed=True))
    return facets.explode_list(typed, "conditions", ["ord"])


@query
def facet_counts(spark, sf_dir):
    parsed = with_parsed(view(spark, sf_dir, "replies"), structured=False)
    typed = parsed.where(is_record(F.col("parsed"))).select(
        *conform(F.col("parsed"), example_schema(), typed=True)
    )
    return facets.facet_counts(typed, ["sex", "conditions.status", "specialties"])


FACETS = ["sex", "conditions.status", "specialties"]
WANTED = {"sex": ["F"], "conditions.status": ["present", "maybe"]}


def _typed_records(spark, sf_dir):
    parsed = with_parsed(view(spark, sf_dir, "replies"), structured=False)
    return parsed.where(is_record(F.col("parsed"))).select(
        "ord", *conform(F.col("parsed"), example_schema(), typed=True)
    )


@query
def facet_filter(spark, sf_dir):
    return facets.facet_filter(_typed_records(spark, sf_dir), WANTED).select("ord")


def _indexed(spark, sf_dir):
    typed, _ = numbered(_typed_records(spark, sf_dir), "ord")
    return typed, settle(facet_index.facet_index(typed, FACETS), scratch_path(spark, "facets"))


@query
def facet_bitmap_filter(spark, sf_dir):
    typed, index = _indexed(spark, sf_dir)
    return facet_index.matching_records(typed, facet_index.matching_bits(index, WANTED)).select("ord")


@query
def facet_drill_down(spark, sf_dir):
    return facet_index.filtered_counts(_indexed(spark, sf_dir)[1], WANTED)


def _run_sketches(spark, sf_dir):
    """The sketches of five runs, stored; each read only its own notes."""
    path, notes = scratch_path(spark, "sketches"), view(spark, sf_dir, "notes")
    for k in range(5):
        rows = notes.where(F.col("ord") % 5 == k)
        run = sketches.sketch_run(rows, f"r{k}", {"chars": F.length("note")}, F.col("id"))
        run.write.mode("append").parquet(path)
    return spark.read.parquet(path), notes


@query
def sketched_quantiles(spark, sf_dir):
    """Quantiles of note lengths over five runs, and whether the rank of each is within the stated error."""
    runs, notes = _run_sketches(spark, sf_dir)
    found = sketches.quantiles(sketches.merge_runs(runs), "chars", [0.1, 0.5, 0.9])
    sizes = notes.select(F.length("note").alias("size")).where("size IS NOT NULL")
    # One row a share against all sizes, for the comparison only.
    ranks = sizes.join(F.broadcast(found)).groupBy("share", "n").agg(
        (F.count_if(F.col("size") < F.col("value")) / F.col("n")).alias("low"),
        (F.count_if(F.col("size") <= F.col("value")) / F.col("n")).alias("high"),
    )
    error = F.lit(sketches.QUANTILE_ERROR)
    return ranks.select("share", "n", (
        (F.col("low") - error <= F.col("share")) & (F.col("share") <= F.col("high") + error)
    ).alias("within_error"))


@query
def sketched_ids(spark, sf_dir):
    runs, notes = _run_sketches(spark, sf_dir)
    exact = notes.agg(F.count_distinct("id").alias("n_distinct"))
    error = F.abs(F.col("n_ids") - F.col("n_distinct")) <= sketches.DISTINCT_ERROR * F.col("n_distinct") + 1
    return sketches.distinct_ids(sketches.merge_runs(runs)).join(exact).select("n_distinct", error.alias("within_error"))


@query
def sketched_values(spark, sf_dir):
    """The most common statuses outside the closed vocabulary, over four runs."""
    allowed = ["present", "negated", "uncertain", "historical"]
    typed = facets.explode_list(_typed_records(spark, sf_dir), "conditions", ["ord"], outer=False)
    path = scratch_path(spark, "values")
    for k in range(4):
        rows = typed.where((F.col("ord") % 4 == k) & ~F.col("status").isin(allowed))
        sketches.value_sketch(rows, f"r{k}", F.col("status")).write.mode("append").parquet(path)
    return sketches.common_values(spark.read.parquet(path))
