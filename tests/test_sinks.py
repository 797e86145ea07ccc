import json

import pytest
from pyspark.sql import functions as F

from notewright.catalog.fixtures import example_schema
from notewright.plans.enrich import records
from notewright.sources import shards

NOTES = "ord bigint, id string, note string"


def test_jsonl_rolls_over_and_appends(spark, tmp_path):
    path = tmp_path / "out"
    one = spark.createDataFrame([("a", None), ("b", "ü x")], "id string, v string").coalesce(1)
    shards.write_jsonl(one, str(path), shard_size=1)
    files = sorted(path.glob("*.json"))
    assert len(files) == 2
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert sorted(lines) == ['{"id":"a","v":null}', '{"id":"b","v":"ü x"}']
    shards.write_jsonl(one, str(path))
    (path / "w0_00000.jsonl").write_text('{"id": "c", "v": "x", "more": 1}\n')
    back = shards.read_jsonl(spark, str(path), "id string, v string")
    assert sorted(r["id"] for r in back.collect()) == ["a", "a", "b", "b", "c"]
    assert shards.describe_shards(back).first().asDict() == {"n_records": 5, "columns": "id,v"}


def test_jsonl_by_shard(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "id % 2 AS shard")
    shards.write_jsonl(df, str(tmp_path / "out"), partition_by="shard")
    assert sorted(p.name for p in (tmp_path / "out").glob("shard=*")) == ["shard=0", "shard=1"]
    assert shards.read_jsonl(spark, str(tmp_path / "out"), "id bigint, shard int").count() == 10


def test_missing_shards_raise(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        shards.read_jsonl(spark, str(tmp_path / "none"), "id string").count()
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "notes.csv").write_text("x")
    with pytest.raises(FileNotFoundError):
        shards.read_jsonl(spark, str(tmp_path / "empty"), "id string")


def test_record_lines_have_only_their_keys(spark, tmp_path):
    replies = spark.createDataFrame(
        [("a", "n", None, '{"age":"50","conditions":[7]}'), ("b", "m", "u", "oops")],
        "id string, note string, source string, raw_output string",
    )
    full = records(replies, example_schema(), created_at=F.lit("2024-01-01T00:00:00+00:00"))
    shards.write_record_lines(full.coalesce(1), str(tmp_path / "out"))
    texts = [f.read_text() for f in (tmp_path / "out").glob("*.txt")]
    good, failed = (json.loads(line) for line in "".join(texts).splitlines())
    assert good == {
        "id": "a", "patient_note": "n", "source": None, "age": "50", "sex": None, "chief_complaint": None,
        "conditions": [7], "specialties": [], "extraction_ok": True, "created_at": "2024-01-01T00:00:00+00:00",
    }
    assert list(failed) == ["id", "patient_note", "source", "extraction_ok", "model_output_raw", "created_at"]
    assert failed["model_output_raw"] == "oops" and failed["extraction_ok"] is False


@pytest.mark.parametrize("size, want", [("500MB", 500_000_000), ("1GiB", 2**30), ("2kb", 2000), (7, 7)])
def test_sizes(size, want):
    assert shards.size_in_bytes(size) == want


def test_bad_size():
    with pytest.raises(ValueError):
        shards.size_in_bytes("lots")


def test_parquet_export_caps_the_shards(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "repeat('x', 92) AS t", "array(id) AS a").coalesce(1)
    rows = shards.export_parquet(df, str(tmp_path / "out"), max_shard_size="10KB")
    files = list((tmp_path / "out").glob("*.parquet"))
    assert len(files) == -(-1000 // rows) and 80 <= rows <= 100
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1000
    assert shards.export_parquet(df, str(tmp_path / "two"), "10KB", avg_row_bytes=100.0, compact=True) == 100


def test_variant_records_round_trip(spark, tmp_path):
    replies = spark.createDataFrame(
        [("a", "n", None, '{"age":"50","conditions":[7]}')],
        "id string, note string, source string, raw_output string",
    )
    full = records(replies, example_schema())
    shards.export_parquet(full, str(tmp_path / "p"))
    row = spark.read.parquet(str(tmp_path / "p")).select(F.to_json("age"), F.to_json("conditions")).first()
    assert tuple(row) == ('"50"', "[7]")
    shards.write_jsonl(full, str(tmp_path / "j"))
    text = shards.read_jsonl(spark, str(tmp_path / "j"), "age variant, conditions array<variant>")
    assert tuple(text.select(F.to_json("age"), F.to_json("conditions")).first()) == ('"50"', "[7]")


def test_ids_round_trip(spark, tmp_path):
    path = str(tmp_path / "ids")
    assert shards.read_ids(spark, path).count() == 0
    for batch in (["a", "b"], ["b", "c"]):
        shards.write_ids(spark.createDataFrame([(i,) for i in batch], "id string"), path)
    assert sorted(r["id"] for r in shards.read_ids(spark, path).collect()) == ["a", "b", "c"]


def test_union_of_workers(spark):
    one = spark.createDataFrame([("a", 1)], "id string, age int")
    two = spark.createDataFrame([("b", "raw")], "id string, model_output_raw string")
    got = shards.union_shards(one, two, one)
    assert got.columns == ["id", "age", "model_output_raw"] and got.count() == 3
