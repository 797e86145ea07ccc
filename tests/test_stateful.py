import json
import os
import time

import pytest
from pyspark.sql import functions as F

from notewright.operators.filters import valid_notes
from notewright.operators.metrics import worker_metrics
from notewright.sources.notes import stream_json_notes
from notewright.streaming.stateful import read_log, start_stateful


def arrive(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.jsonl", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)
    # Files are taken up by age.
    stamp = time.time() - 1000 + len(os.listdir(folder))
    os.utime(f"{folder}/{name}.jsonl", (stamp, stamp))


def run(spark, tmp, checkpoint, records=None, tag="all", files=1000):
    notes = valid_notes(stream_json_notes(spark, f"{tmp}/in", files_per_batch=files))
    records = records or (lambda fresh: fresh.select("id", "note", (F.col("note") != "bad").alias("extraction_ok")))
    start_stateful(notes, records, f"{tmp}/out", f"{tmp}/{checkpoint}", f"{tmp}/log", tag).awaitTermination()
    return sorted((r["id"], r["note"]) for r in spark.read.parquet(f"{tmp}/out").collect())


def counts(spark, tmp):
    found = worker_metrics(read_log(spark, f"{tmp}/log"))
    return {r["run_tag"]: (r["notes_seen"], r["notes_written"], r["notes_skipped"], r["notes_failed"])
            for r in found.collect()}


def test_json_rules_and_three_starts(spark, tmp_path):
    tmp = str(tmp_path)
    arrive(f"{tmp}/in", "a", [{"_id": "x", "description": "one"}, {"_id": "x", "description": "two"}, {"_id": "y"},
                              {"_id": "z", "description": None}, {"_id": "", "description": "no id"},
                              {"_id": "n", "description": 5}])
    with open(f"{tmp}/in/a.jsonl", "a") as f:
        f.write("{broken\n\n")
    want = [("x", "one"), ("x", "two"), ("y", "")]
    assert run(spark, tmp, "c1", tag="r1") == want
    arrive(f"{tmp}/in", "b", [{"_id": "x", "description": "three"}, {"_id": "q", "description": "bad"}])
    want = sorted([*want, ("q", "bad")])
    assert run(spark, tmp, "c1", tag="r2") == want  # goes on from its checkpoint
    assert run(spark, tmp, "c1", tag="r2") == want
    arrive(f"{tmp}/in", "c", [{"_id": "w", "description": "new"}])
    want = sorted([*want, ("w", "new")])
    assert run(spark, tmp, "c2", tag="r3") == want  # begins anew from the records
    assert counts(spark, tmp) == {"r1": (3, 3, 0, 0), "r2": (2, 1, 1, 1), "r3": (6, 1, 5, 0)}


def test_a_lost_batch_is_written_and_counted_once(spark, tmp_path):
    tmp = str(tmp_path)
    for k in range(4):
        arrive(f"{tmp}/in", f"f{k}", [{"_id": f"i{k}", "description": "a"}, {"_id": "every", "description": f"n{k}"}])
    done = []

    def records(fresh):
        done.append(1)
        if len(done) == 3:
            fresh.select("id", "note").write.mode("overwrite").parquet(f"{tmp}/out/query=lost/batch=0")
            raise RuntimeError("lost")
        return fresh.select("id", "note")

    with pytest.raises(Exception, match="lost"):
        run(spark, tmp, "c", records, files=1)
    # What the lost batch may have left behind of its own folder is replaced; here it is another one.
    import shutil
    shutil.rmtree(f"{tmp}/out/query=lost")
    want = sorted([("every", "n0")] + [(f"i{k}", "a") for k in range(4)])
    assert run(spark, tmp, "c", records, files=1) == want
    assert counts(spark, tmp) == {"all": (8, 5, 3, 0)}


def test_the_records_are_read_once_a_start_and_not_once_a_batch(spark, tmp_path, monkeypatch):
    from notewright.streaming import stateful
    tmp, calls = str(tmp_path), []
    real = stateful.done_ids
    monkeypatch.setattr(stateful, "done_ids", lambda *a: calls.append(a) or real(*a))
    for k in range(6):
        arrive(f"{tmp}/in", f"f{k}", [{"_id": f"i{k % 4}", "description": "a"}])
    assert len(run(spark, tmp, "c", files=1)) == 4
    assert len(calls) == 1


def test_ids_are_looked_up_without_a_python_call_each(spark, tmp_path):
    from notewright.streaming.stateful import fresh_rows, with_firsts
    tmp = str(tmp_path)
    arrive(f"{tmp}/in", "a", [{"_id": i, "description": f"n{k}"} for k, i in enumerate("xxyz")])
    arrive(f"{tmp}/in", "b", [{"_id": i, "description": f"m{k}"} for k, i in enumerate("xwwq")])
    spark.createDataFrame([("z",), ("q",)], "id string").coalesce(1).write.parquet(f"{tmp}/seeds")
    notes = stream_json_notes(spark, f"{tmp}/in", files_per_batch=1)
    plans, found = [], {}

    def look(batch, number):
        plans.append(batch._jdf.queryExecution().toString())
        batch.write.parquet(f"{tmp}/batch{number}")
        rows = fresh_rows(spark.read.parquet(f"{tmp}/batch{number}"))
        found[number] = sorted((r["id"], r["note"]) for r in rows.collect())

    marked = with_firsts(notes, spark.readStream.schema("id string").parquet(f"{tmp}/seeds"))
    query = marked.writeStream.foreachBatch(look).option("checkpointLocation", f"{tmp}/c").trigger(availableNow=True).start()
    query.awaitTermination()
    assert found == {0: [("x", "n0"), ("x", "n1"), ("y", "n2")], 1: [("w", "m1"), ("w", "m2")]}
    assert all("Pandas" not in plan for plan in plans)
