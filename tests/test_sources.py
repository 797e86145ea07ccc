import json

from notewright.operators.matching import bank_counts, usable_questions
from notewright.sources.notes import read_bank, read_notes


def test_parquet_order_is_file_and_row(spark, tmp_path):
    for name, start in (("b", 10), ("a", 0), ("c", 20)):
        df = spark.range(start, start + 5).selectExpr("concat('n', id) AS _id", "concat('t', id) AS description", "1 AS x")
        df.coalesce(1).write.parquet(str(tmp_path / "my corpus" / f"part={name} ü"))
    notes = read_notes(spark, str(tmp_path / "my corpus"))
    assert notes.columns == ["ord", "id", "note"]
    got = [r["id"] for r in notes.orderBy("ord").collect()]
    assert got == [f"n{s + i}" for s in (0, 10, 20) for i in range(5)]
    assert notes.select("ord").distinct().count() == 15


def test_parquet_scan_reads_two_columns(spark, tmp_path):
    df = spark.range(5).selectExpr("concat('n', id) AS _id", "'t' AS description", "repeat('x', 10) AS unused")
    df.coalesce(1).write.parquet(str(tmp_path / "c"))
    plan = read_notes(spark, str(tmp_path / "c")).where("id = 'n1'")._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan and "PushedFilters: [IsNotNull(_id), EqualTo(_id,n1)]" in plan


def test_notes_without_a_note_column(spark, tmp_path):
    spark.range(2).selectExpr("concat('n', id) AS _id", "id").write.parquet(str(tmp_path / "c"))
    rows = read_notes(spark, str(tmp_path / "c"), order_by="id").orderBy("ord").collect()
    assert [tuple(r) for r in rows] == [(0, "n0", "", "0"), (1, "n1", "", "1")]


def test_notes_that_are_no_strings(spark, tmp_path):
    spark.range(2).selectExpr("concat('n', id) AS _id", "id AS description").write.parquet(str(tmp_path / "c"))
    assert [r["note"] for r in read_notes(spark, str(tmp_path / "c")).collect()] == [None, None]


def test_json_tells_missing_from_null(spark, tmp_path):
    lines = [
        {"_id": "a", "description": "x"}, {"_id": "b"}, {"_id": "c", "description": None},
        {"_id": "d", "description": 5}, {"id": "e", "description": ""}, {"_id": None, "id": "f"},
    ]
    path = tmp_path / "notes.jsonl"
    path.write_text("".join(json.dumps(x) + "\n" for x in lines))
    rows = read_notes(spark, str(path), fmt="json").orderBy("ord").collect()
    assert [(r["id"], r["note"], r["other_id"]) for r in rows] == [
        ("a", "x", None), ("b", "", None), ("c", None, None), ("d", None, None), (None, "", "e"), (None, "", "f")
    ]


def test_bank_from_json(spark, tmp_path):
    lines = [
        {"index": 4, "question": "q"}, {"index": "5", "question": "q"}, {"index": "n/a", "question": "q"},
        {"index": 6}, {"question": "q"}, {"index": 7, "question": 3}, {"index": 8.7, "question": "r"},
        {"index": "8.7", "question": "r"}, {"index": True, "question": "t"},
    ]
    path = tmp_path / "bank.jsonl"
    path.write_text("".join(json.dumps(x) + "\n" for x in lines))
    bank = read_bank(spark, str(path), fmt="json")
    assert bank_counts(bank).first().asDict() == {"bank_total": 9, "bank_missing_fields": 5}
    assert sorted(r["idx"] for r in usable_questions(bank).collect()) == [1, 4, 5, 8]


def test_bank_from_parquet(spark, tmp_path):
    spark.sql("SELECT 3.7D AS index, 'q' AS question UNION ALL SELECT NULL, 'q'").write.parquet(str(tmp_path / "b"))
    bank = read_bank(spark, str(tmp_path / "b"))
    assert sorted((r["idx_raw"] for r in bank.collect()), key=str) == ["3", None]
    other = read_bank(spark, str(tmp_path / "b"), question_col="absent")
    assert bank_counts(other).first()["bank_missing_fields"] == 2


def test_json_order_is_file_and_line(spark, tmp_path):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        sizes = {"b": 3, "a": 400, "c": 5, "d": 900}
        for name, n in sizes.items():
            lines = [json.dumps({"_id": f"{name}{k}", "description": "x" * (k % 90)}) for k in range(n)]
            (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")
        notes = read_notes(spark, str(tmp_path), fmt="json")
        got = [r["id"] for r in notes.orderBy("ord").collect()]
        assert got == [f"{name}{k}" for name in sorted(sizes) for k in range(sizes[name])]
        assert notes.select("ord").distinct().count() == len(got)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
