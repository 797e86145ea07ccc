import datetime as dt

import pytest

from notewright.operators.metrics import (
    bench_metrics, bench_replica_metrics, replica_metrics, worker_metrics,
)
from notewright.sources import run_log

LOG = (
    "run_tag string, start_ts timestamp, end_ts timestamp, seen bigint, written bigint, skipped bigint, "
    "failed bigint, input_tokens bigint, output_tokens bigint, gen_ms bigint"
)


def at(second):
    return dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=second)


@pytest.fixture
def log(spark):
    return spark.createDataFrame(
        [
            ("r0", at(0), at(4), 40, 10, 5, 1, 100, 50, 2000),
            ("r0", at(4), at(10), 10, 10, 0, 2, 100, 30, 3000),
            ("r1", at(2), at(22), 50, 30, 0, 0, 300, 90, 15000),
        ],
        LOG,
    )


def test_worker(log):
    row = {r["run_tag"]: r for r in worker_metrics(log).collect()}["r0"]
    assert (row["notes_seen"], row["notes_written"], row["notes_skipped"], row["notes_failed"]) == (50, 20, 5, 3)
    assert (row["duration_s"], row["gen_time_s"], row["total_tokens"]) == (10.0, 5.0, 280)
    assert (row["notes_per_s"], row["input_toks_per_s"], row["output_toks_per_s"]) == (5.0, 40.0, 16.0)
    assert (row["total_toks_per_s"], row["avg_input_toks_per_note"]) == (56.0, 4.0)
    assert row["avg_output_toks_per_note"] == pytest.approx(1.6)


def test_replicas_mix_wall_and_generation_time(log):
    row = replica_metrics(worker_metrics(log)).first()
    assert (row["replicas"], row["wall_time_s"], row["gen_time_s"]) == (2, 22.0, 20.0)
    assert (row["notes_written"], row["total_tokens"]) == (50, 670)
    assert row["notes_per_s"] == pytest.approx(50 / 22) and row["total_toks_per_s"] == pytest.approx(670 / 22)
    assert row["input_toks_per_s"] == 25.0 and row["output_toks_per_s"] == 8.5


def test_bench(log):
    rows = {r["run_tag"]: r for r in bench_metrics(log).collect()}
    assert (rows["r0"]["notes"], rows["r0"]["batches"], rows["r0"]["notes_per_s"]) == (20, 2, 2.0)
    assert rows["r0"]["avg_input_toks_per_note"] == 10.0
    merged = bench_replica_metrics(bench_metrics(log)).first()
    assert (merged["notes"], merged["batches"], merged["wall_time_s"]) == (50, 3, 22.0)


def test_bench_without_stamps_takes_the_longest_worker(spark):
    rows = [("r0", None, None, 7.0, 1.0, 5, 1, 10, 20), ("r1", None, None, 9.0, 2.0, 4, 1, 10, 20)]
    workers = spark.createDataFrame(
        rows, "run_tag string, start_time timestamp, end_time timestamp, total_time_s double, "
        "gen_time_s double, notes bigint, batches bigint, input_tokens bigint, output_tokens bigint"
    )
    row = bench_replica_metrics(workers).first()
    assert row["wall_time_s"] == 9.0 and row["notes_per_s"] == 1.0
    assert bench_replica_metrics(workers.limit(0)).first()["wall_time_s"] == 0.0


def test_nothing_to_divide_by(spark):
    log = spark.createDataFrame([("r0", at(0), at(0), 0, 0, 0, 0, 5, 5, 0)], LOG)
    row = worker_metrics(log).first()
    assert row["notes_per_s"] == row["total_toks_per_s"] == row["avg_input_toks_per_note"] == 0.0
    merged = replica_metrics(worker_metrics(log)).first()
    assert merged["notes_per_s"] == merged["input_toks_per_s"] == 0.0
    empty = replica_metrics(worker_metrics(log.limit(0))).first()
    assert empty["wall_time_s"] is None and empty["notes_written"] == 0 and empty["notes_per_s"] == 0.0


def test_metrics_files_and_a_corrupt_one(spark, log, tmp_path):
    path = tmp_path / "runs"
    run_log.write_metrics(worker_metrics(log), str(path))
    assert len(list(path.glob("*.json"))) == 2
    (path / "run_metadata_r9.json").write_text('{"run_tag": "r9", "notes_')
    (path / "run_metadata_r2.json").write_text(
        '{\n  "run_tag": "r2",\n  "start_time": "2024-01-01T00:00:01.500000+00:00",\n'
        '  "end_time": "2024-01-01T00:00:03+00:00", "notes_written": 1, "args": {"x": 1}\n}'
    )
    got = {r["run_tag"]: r for r in run_log.read_metrics(spark, str(path)).collect()}
    assert sorted(got) == ["r0", "r1", "r2"]
    want = {r["run_tag"]: r for r in worker_metrics(log).collect()}
    assert {k: v for k, v in got["r0"].asDict().items()} == {k: want["r0"][k] for k in got["r0"].asDict()}
    merged = replica_metrics(run_log.read_metrics(spark, str(path))).first()
    assert merged["wall_time_s"] == 22.0 and merged["notes_written"] == 51
