import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from notewright.catalog.fixtures import EXAMPLE_SCHEMA, example_schema
from notewright.operators import audit, facets
from notewright.operators.generate import with_replies
from notewright.operators.replies import with_parsed
from notewright.operators.prompts import prompt_variants
from notewright.operators.generate import token_counter
from notewright.operators.filters import valid_notes
from notewright.operators.metrics import bench_replica_metrics
from notewright.plans.bench import run_bench
from notewright.plans.enrich import EnrichOptions, enrich, records, run_enrichment, select_notes
from notewright.sources.notes import stream_notes
from notewright.sources.shards import read_jsonl, write_table
from notewright.streaming.incremental import done_ids, start_incremental

# Python workers cannot import a test file, so its functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOTES = "ord bigint, id string, note string"


def notes(spark, n, bad=()):
    rows = [(i, f"pmc-{i}-1", f"note {i}") for i in range(n)]
    return spark.createDataFrame(rows + list(bad), NOTES)


def answers():
    """Says the number of the note; every tenth note gets no JSON."""
    def generate(prompts):
        out = []
        for p in prompts:
            n = int(p.split("NOTE:\nnote ")[1].split("\n")[0])
            out.append("sorry" if n % 10 == 9 else (json.dumps({"age": n, "batch": len(prompts)}), 3))
        return out
    return generate


def test_batches_are_cut_across_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        def sizes():
            return lambda prompts: [f"{p}:{len(prompts)}" for p in prompts]
        df = spark.range(75).selectExpr("id", "concat('p', id) AS prompt").coalesce(1)
        out = with_replies(df, sizes, batch_size=32).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    want = [32] * 64 + [11] * 11
    assert [r["call"]["text"] for r in out] == [f"p{i}:{n}" for i, n in enumerate(want)]
    assert sum(r["call"]["head"] for r in out) == 3
    assert all(r["call"]["tokens"] is None for r in out)


def test_short_answers_raise(spark):
    df = spark.range(3).selectExpr("'p' AS prompt")
    with pytest.raises(Exception, match="2 answers for"):
        with_replies(df.coalesce(1), lambda: lambda prompts: ["x", "y"]).collect()


def test_select_notes(spark):
    base = notes(spark, 100, [(200, "", "x"), (201, None, "x"), (202, "z", None)])
    assert select_notes(base).count() == 100
    done = spark.createDataFrame([("pmc-0-1",), ("pmc-1-1",)], "id string")
    assert [r["ord"] for r in select_notes(base, EnrichOptions(max_notes=3), done).orderBy("ord").collect()] == [2, 3, 4]
    per = [select_notes(base, EnrichOptions(num_shards=4, shard=s)).count() for s in range(4)]
    assert sum(per) == 100 and min(per) > 10
    every = select_notes(base, EnrichOptions(num_shards=4, max_notes=5)).groupBy("shard").count().collect()
    assert sorted((r["shard"], r["count"]) for r in every) == [(s, 5) for s in range(4)]


def test_enrich_end_to_end(spark):
    df = enrich(notes(spark, 30), example_schema(), answers, EnrichOptions(typed=True))
    rows = {r["id"]: r for r in df.collect()}
    assert len(rows) == 30
    assert rows["pmc-3-1"]["age"] == 3 and rows["pmc-3-1"]["extraction_ok"]
    assert rows["pmc-3-1"]["source"].endswith("PMC3/") and rows["pmc-3-1"]["created_at"] is not None
    assert rows["pmc-9-1"]["model_output_raw"] == "sorry" and not rows["pmc-9-1"]["extraction_ok"]


def test_run_and_resume(spark, tmp_path):
    out = str(tmp_path / "out")
    schema = "id string, age int, extraction_ok boolean"
    first = run_enrichment(
        notes(spark, 40, [(900, "", "x")]), example_schema(), answers, out, "r0", EnrichOptions(max_notes=25)
    ).first()
    assert (first["notes_seen"], first["notes_written"], first["notes_skipped"], first["notes_failed"]) == (25, 25, 0, 2)
    assert first["output_tokens"] == 23 * 3 + 2 and first["input_tokens"] > 0
    done = read_jsonl(spark, out, schema).select("id")
    second = run_enrichment(
        notes(spark, 40), example_schema(), answers, out, "r0", EnrichOptions(generator_tasks=3), done=done
    ).first()
    assert (second["notes_seen"], second["notes_written"], second["notes_skipped"], second["notes_failed"]) == (40, 15, 25, 2)
    everything = read_jsonl(spark, out, schema)
    assert everything.count() == 40 and everything.select("id").distinct().count() == 40
    assert everything.where("not extraction_ok").count() == 4


def test_resume_from_a_table(spark, tmp_path):
    out = str(tmp_path / "out")
    for n, written in ((10, 10), (25, 15)):
        done = spark.read.parquet(out).select("id") if n > 10 else None
        row = run_enrichment(notes(spark, n), example_schema(), answers, out, done=done, write=write_table).first()
        assert row["notes_written"] == written
    assert spark.read.parquet(out).select(F.to_json("age")).count() == 25


def test_runs_with_nothing_to_do(spark, tmp_path):
    base = notes(spark, 5)
    out = str(tmp_path / "out")
    row = run_enrichment(base, example_schema(), answers, out, done=base.select("id")).first()
    assert (row["notes_seen"], row["notes_skipped"], row["notes_written"], row["input_tokens"]) == (5, 5, 0, 0)
    row = run_enrichment(base.limit(0), example_schema(), answers, out, done=base.select("id")).first()
    assert (row["notes_seen"], row["notes_per_s"]) == (0, 0.0)
    assert run_bench(base.limit(0), example_schema(), answers).first()["notes"] == 0


def test_metrics_of_one_shard(spark, tmp_path):
    base, out = notes(spark, 60), str(tmp_path / "out")
    mine = {r["id"] for r in select_notes(base, EnrichOptions(num_shards=3, shard=1)).collect()}
    done = spark.createDataFrame([(i,) for i in sorted(mine)[:4] * 2 + ["pmc-x"]], "id string")
    row = run_enrichment(
        base, example_schema(), answers, out, "r1", EnrichOptions(num_shards=3, shard=1), done
    ).first()
    assert (row["notes_seen"], row["notes_skipped"], row["notes_written"]) == (60, 4, len(mine) - 4)


def test_each_note_is_generated_once(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    folder = str(calls)

    def counting():
        import uuid

        def generate(prompts):
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(str(len(prompts)))
            return ['{"age": 1}' for _ in prompts]
        return generate

    lookup = spark.createDataFrame([("usmle-1", 1)], "key string, row bigint")
    done = spark.createDataFrame([("pmc-0-1",)], "id string")
    run_enrichment(
        notes(spark, 50), example_schema(), counting, str(tmp_path / "out"), done=done, lookup=lookup
    )
    assert sum(int(p.read_text()) for p in calls.iterdir()) == 49


def test_incremental_runs(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def add(ids):
        spark.createDataFrame([(i, f"n{i}", f"note {i}", f'{{"age":{i}}}') for i in ids], NOTES + ", raw_output string") \
            .coalesce(1).write.mode("append").parquet(source)

    def run(checkpoint):
        stream = spark.readStream.schema(NOTES + ", raw_output string").option("maxFilesPerTrigger", 1).parquet(source)
        make = lambda df: records(df.withColumn("source", F.lit(None).cast("string")), example_schema(), typed=True)
        query = start_incremental(stream, make, out, str(tmp_path / checkpoint))
        query.awaitTermination()
        return sorted(r["id"] for r in spark.read.parquet(out).collect())

    assert done_ids(spark, out).count() == 0
    (tmp_path / "out" / "query=q" / "batch=0" / "_temporary").mkdir(parents=True)
    assert done_ids(spark, out, "q", 0).count() == 0
    add(range(0, 5))
    assert run("c1") == [f"n{i}" for i in range(5)]
    add(range(3, 8))
    assert run("c1") == [f"n{i}" for i in range(8)]
    assert run("c1") == [f"n{i}" for i in range(8)]
    assert run("c2") == [f"n{i}" for i in range(8)]
    add([8, 8])
    assert run("c2") == sorted([f"n{i}" for i in range(8)] + ["n8", "n8"])


def test_incremental_enrichment(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "_id string, description string"
    for start in (0, 10):
        notes(spark, 20).where(f"ord >= {start} and ord < {start + 10}").selectExpr(
            "id AS _id", "note AS description"
        ).coalesce(1).write.mode("append").parquet(source)
    for checkpoint in ("c1", "c2"):
        stream = valid_notes(stream_notes(spark, source, schema, files_per_batch=1))
        make = lambda df: enrich(df, example_schema(), answers, EnrichOptions(typed=True))
        start_incremental(stream, make, out, str(tmp_path / checkpoint)).awaitTermination()
        written = spark.read.parquet(out)
        assert written.count() == 20 and written.where("not extraction_ok").count() == 2
    assert written.select("query", "batch").distinct().count() >= 2
    assert {r["age"] for r in written.where("extraction_ok").collect()} == {n for n in range(20) if n % 10 != 9}


def test_bench_run(spark):
    base = notes(spark, 90, [(200, None, "note 7"), (201, "x", None)])
    row = run_bench(base.coalesce(1), example_schema(), answers, "r0", EnrichOptions(max_notes=70)).first()
    assert (row["notes"], row["batches"], row["run_tag"]) == (70, 3, "r0")
    assert row["output_tokens"] == 63 * 3 + 7 and row["notes_per_s"] > 0
    shards = [
        run_bench(base, example_schema(), answers, f"r{s}", EnrichOptions(num_shards=2, shard=s)) for s in range(2)
    ]
    merged = bench_replica_metrics(shards[0].unionByName(shards[1])).first()
    assert merged["replicas"] == 2 and merged["notes"] == 90
    assert run_bench(base, example_schema(), answers).first()["notes"] == 91


def test_a_batch_that_is_tried_again_replaces_itself(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.createDataFrame([(i, f"n{i}", "x") for i in range(6)], NOTES).write.parquet(source)
    state = {"fail": True}

    def make(df):
        if state["fail"]:
            # Half of the batch reaches the folder, then the batch dies.
            df.where("ord < 3").write.mode("append").parquet(state["folder"])
            raise RuntimeError("executor lost")
        return df

    def run():
        stream = spark.readStream.schema(NOTES).parquet(source)
        query = start_incremental(stream, make, out, str(tmp_path / "c"))
        state["folder"] = f"{out}/query={query.id}/batch=0"
        query.awaitTermination()

    import time
    original = make

    def slow(df):
        time.sleep(2)
        return original(df)

    make = slow
    with pytest.raises(Exception, match="executor lost"):
        run()
    assert spark.read.parquet(out).count() == 3
    state["fail"] = False
    run()
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == [f"n{i}" for i in range(6)]


def test_prompt_variants(spark):
    counters = {"words": token_counter(), "letters": lambda c: F.length(c).cast("bigint")}
    rows = prompt_variants(notes(spark, 3), example_schema(), counters).collect()
    assert len(rows) == 6
    assert all(r["n_tokens"] == r["n_chars"] for r in rows if r["tokenizer"] == "letters")
    assert len({r["n_lines"] for r in rows}) == 1


def test_audit(spark):
    replies = [
        '{"age":5,"sex":"F","chief_complaint":null,"conditions":[],"specialties":["other"]}',
        '{"age":"5","sex":"X","conditions":{},"specialties":["other","surgery",3]}',
        '{"age":1.0,"conditions":[{"name":"a","status":"maybe"},{"name":"b","status":null},4],"specialties":null}',
        json.dumps({"age": 1.5, "conditions": [{"name": "a"}] * 31}),
        "no json",
    ]
    df = with_parsed(spark.createDataFrame([(r,) for r in replies], "raw_output string"), False)
    got = {r["field"]: tuple(r)[1:] for r in audit.conformance_audit(df, example_schema()).collect()}
    # kind, records, missing, wrong type, outside the closed list, over the limit
    assert got == {
        "age": ("scalar", 4, 0, 2, 0, 0),
        "sex": ("scalar", 4, 2, 0, 1, 0),
        "chief_complaint": ("scalar", 4, 3, 0, 0, 0),
        "conditions": ("object_list", 4, 0, 2, 1, 1),
        "specialties": ("scalar_list", 4, 1, 2, 2, 0),
    }
    assert EXAMPLE_SCHEMA["json_schema"]["name"] == "note_record"


def test_explode_and_facets(spark):
    replies = [
        ("a", "n", None, '{"sex":"F","conditions":[{"name":"x","status":"present"},{"name":"y","status":"negated"}]}'),
        ("b", "n", None, '{"sex":"F","conditions":[{"name":"z","status":"present"}],"specialties":["other"]}'),
        ("c", "n", None, "{}"),
    ]
    df = spark.createDataFrame(replies, "id string, note string, source string, raw_output string")
    full = records(df, example_schema(), typed=True)
    items = facets.explode_list(full, "conditions", ["id"]).collect()
    assert sorted((r["id"], r["pos"], r["name"]) for r in items if r["name"]) == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")]
    assert sum(r["id"] == "c" for r in items) == 1
    assert facets.explode_list(full, "conditions", ["id"], outer=False).count() == 3
    assert facets.explode_list(full, "specialties", ["id"], outer=False).first()["item"] == "other"
    counts = {(r["facet"], r["value"]): r["n"] for r in facets.facet_counts(full, ["sex", "conditions.status", "specialties"]).collect()}
    assert counts == {
        ("sex", "F"): 2, ("conditions.status", "present"): 2, ("conditions.status", "negated"): 1, ("specialties", "other"): 1
    }


def test_resume_as_one_option(spark, tmp_path):
    for name, write in (("lines", None), ("table", write_table)):
        out = str(tmp_path / name)
        for n, written in ((10, 10), (25, 15), (25, 0)):
            row = run_enrichment(notes(spark, n), example_schema(), answers, out, write=write, resume=True).first()
            assert (row["notes_written"], row["notes_skipped"], row["resume"]) == (written, n - written, True)
        assert row["out"] == out and row["run_id"] and '"num_shards": 1' in row["options"]


def test_default_lines_have_two_shapes_and_no_shard(spark, tmp_path):
    out = str(tmp_path / "out")
    run_enrichment(notes(spark, 20), example_schema(), answers, out, options=EnrichOptions(num_shards=2))
    lines = [json.loads(r["value"]) for r in spark.read.text(out).collect()]
    assert len(lines) == 20 and all("shard" not in line for line in lines)
    assert all(("model_output_raw" in line) != line["extraction_ok"] for line in lines)
    assert all(("age" in line) == line["extraction_ok"] for line in lines)


def test_layout_is_tried_without_extra_arguments(spark):
    from notewright.operators.generate import chat_prompt

    def knows():
        return lambda system, user, thinking=True: f"{thinking} {user[:0]}"

    def plain():
        return lambda system, user: "plain"

    df = spark.range(1).selectExpr("'n' AS note")
    for make, want in ((knows, "False "), (plain, "plain")):
        column = chat_prompt(F.col("note"), example_schema(), make, {"thinking": False})
        assert df.select(column.alias("p")).first()["p"] == want


def test_facet_filter(spark):
    rows = [(1, "f", ["a", "b"]), (2, "m", ["b"]), (3, None, None), (4, "f", [])]
    df = spark.createDataFrame(rows, "id bigint, sex string, tags array<string>")
    ids = lambda wanted: sorted(r["id"] for r in facets.facet_filter(df, wanted).collect())
    assert ids({"sex": ["f"]}) == [1, 4] and ids({"tags": ["b", "c"]}) == [1, 2]
    assert ids({"sex": ["f"], "tags": ["b"]}) == [1] and ids({"sex": []}) == [] and ids({}) == [1, 2, 3, 4]
