import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from notewright.sources import rolling


def files(path):
    return sorted(f"{os.path.relpath(d, path)}/{f}".removeprefix("./") for d, _, names in os.walk(path) for f in names)


def lines(path):
    with open(path) as f:
        return f.read().splitlines()


def batch(rows):
    shard, ident, line = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(ident), pa.array(line)], ["shard", "id", "line"])


def test_shards_are_exact_and_go_on(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(0, 1003, 1, 7).select(
        (F.lit(5000) - F.col("id")).alias("ord"), F.concat(F.lit("n"), "id").alias("id"), F.lit(None).cast("string").alias("note")
    )
    assert rolling.write_rolled(df, out, "w", "ord", shard_size=100) == 11
    names = [f"w_{k:05d}.jsonl" for k in range(11)]
    assert sorted(n for n in os.listdir(out) if n.endswith(".jsonl")) == names
    assert [len(lines(f"{out}/{n}")) for n in names] == [100] * 10 + [3]
    first = lines(f"{out}/w_00000.jsonl")
    assert first[0] == '{"ord":3998,"id":"n1002","note":null}' and lines(f"{out}/_ids/w_00000.ids")[0] == "n1002"
    assert not [f for f in files(out) if "_staging" in f]
    assert rolling.write_rolled(df.limit(1), out, "w", "ord", shard_size=100) == 1
    assert rolling.write_rolled(df.limit(1), out, "v", "ord", shard_size=100) == 1
    assert rolling.write_rolled(df.limit(0), out, "w", "ord", shard_size=100) == 0
    assert len(lines(f"{out}/w_00011.jsonl")) == 1 and rolling.next_shard(out, "v") == 1
    assert rolling.read_rolled_ids(spark, out).count() == 1003
    assert rolling.read_rolled_ids(spark, str(tmp_path / "none")).count() == 0


def test_a_failed_task_leaves_nothing(tmp_path):
    out = str(tmp_path / "out")
    writer = rolling.ShardWriter(out, "w", "run1")

    def breaks():
        yield batch([(0, "a", "{}"), (1, "b", "{}")])
        raise OSError("lost")

    with pytest.raises(OSError, match="lost"):
        writer.write(breaks())
    assert files(out) == []


def test_only_the_attempt_that_ended_is_named(tmp_path):
    out = str(tmp_path / "out")
    writer = rolling.ShardWriter(out, "w", "run1")
    writer.write(iter([batch([(0, "x", '{"of": "a killed attempt"}')])]))
    good = writer.write(iter([batch([(0, "a", '{"k": 1}'), (0, None, '{"k": 2}')])]))
    writer.commit([good, None])
    assert files(out) == ["_ids/w_00000.ids", "_log/run1.json", "w_00000.jsonl"]
    assert lines(f"{out}/w_00000.jsonl") == ['{"k": 1}', '{"k": 2}'] and lines(f"{out}/_ids/w_00000.ids") == ["a"]
    writer = rolling.ShardWriter(out, "w", "run2")
    writer.abort([writer.write(iter([batch([(1, "b", "{}")])]))])
    assert files(out) == ["_ids/w_00000.ids", "_log/run1.json", "w_00000.jsonl"]


def test_a_driver_lost_in_the_middle(spark, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    writer = rolling.ShardWriter(out, "w", "early")
    writer.write(iter([batch([(0, "never", "{}")])]))  # lost before the log entry: not done
    writer = rolling.ShardWriter(out, "w", "late")
    made = writer.write(iter([batch([(0, "a", "{}"), (1, "b", "{}")])]))
    monkeypatch.setattr(rolling, "_settle_run", lambda *a: None)  # lost right after it: done
    writer.commit([made])
    monkeypatch.undo()
    assert rolling.next_shard(out, "w") == 0
    assert sorted(r["id"] for r in rolling.read_rolled_ids(spark, out).collect()) == ["a", "b"]
    assert rolling.next_shard(out, "w") == 2
    rolling.recover(out)
    assert sorted(n for n in os.listdir(out) if n.endswith(".jsonl")) == ["w_00000.jsonl", "w_00001.jsonl"]
