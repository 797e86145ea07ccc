import re
import uuid

from pyspark.sql import functions as F

from notewright.sources.clustered import append_clustered, register_clustered, without_done_clustered


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"\bExchange\b", plan))


def test_records_are_never_shuffled(spark, tmp_path):
    name = f"records_{uuid.uuid4().hex}"
    path = str(tmp_path / "records")
    ids = lambda lo, hi: spark.range(lo, hi).select(F.col("id").cast("string").alias("id"), F.lit("x" * 50).alias("body"))
    append_clustered(ids(0, 500), name, path, 5)
    append_clustered(ids(500, 800), name, path, 5)
    notes = spark.range(0, 1200).select((F.col("id") * 3).alias("ord"), F.col("id").cast("string").alias("id"), F.lit("n").alias("note"))
    fresh = without_done_clustered(notes, name)
    assert sorted(int(r["id"]) for r in fresh.collect()) == list(range(800, 1200))
    assert exchanges(without_done_clustered(notes, name)) == 1  # of the notes
    corpus = f"corpus_{uuid.uuid4().hex}"
    append_clustered(notes, corpus, str(tmp_path / "corpus"), 5)
    fresh = without_done_clustered(spark.table(corpus), name)
    assert exchanges(fresh) == 0
    assert sorted(int(r["id"]) for r in fresh.collect()) == list(range(800, 1200))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "body" not in re.findall(r"ReadSchema: (.*)", plan)[-1]


def test_another_session_registers_the_folder_again(spark, tmp_path):
    path = str(tmp_path / "records")
    ids = spark.range(100).select(F.col("id").cast("string").alias("id"))
    append_clustered(ids, f"a_{uuid.uuid4().hex}", path, 4)
    again = f"b_{uuid.uuid4().hex}"
    register_clustered(spark, again, path, "id string", 4)
    notes = spark.range(90, 110).select("id", F.lit("n").alias("note")).withColumn("id", F.col("id").cast("string"))
    fresh = without_done_clustered(notes, again)
    assert exchanges(fresh) == 1
    assert sorted(int(r["id"]) for r in fresh.collect()) == list(range(100, 110))
    append_clustered(notes.select("id").where("id >= '105'"), f"c_{uuid.uuid4().hex}", path, 4)
    spark.catalog.refreshTable(again)
    assert without_done_clustered(notes, again).where("length(id) = 3").count() == 5
