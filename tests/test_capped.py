import random

import pytest
from pyspark.sql import functions as F

from notewright.sources import shards
from notewright.sources.capped import export_capped


def sizes(spark, path, columns):
    rows = spark.read.parquet(path)
    sized = rows.select(F.col("_metadata.file_path").alias("file"), shards.row_bytes(rows.select(*columns)).alias("b"))
    return [tuple(r) for r in sized.groupBy("file").agg(F.sum("b"), F.count("*"), F.max("b")).collect()]


@pytest.mark.parametrize("cap", [500, 4000, 100_000])
def test_no_file_is_above_the_cap(spark, tmp_path, cap):
    rng = random.Random(cap)
    # A stretch of long texts, which an average would not see.
    long = [(k, "x" * rng.randint(1000, 9000)) for k in range(300, 340)]
    rows = [(k, "y" * rng.randint(0, 40)) for k in range(300)] + long + [(k, None) for k in range(340, 900)]
    df = spark.createDataFrame(rows, "ord bigint, note string").repartition(6)
    path = str(tmp_path / "out")
    export_capped(df, path, "ord", cap)
    found = sizes(spark, path, df.columns)
    assert sum(n for _, _, n, _ in found) == 900
    assert sorted(spark.read.parquet(path).drop("shard").collect()) == sorted(df.collect())
    for _, total, n, most in found:
        assert total <= cap or n == 1
    small = sorted(total for _, total, _, most in found if most * 8 <= cap)
    assert all(total >= 0.75 * cap for total in small[1:])


def test_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "ord bigint, note string")
    export_capped(df, str(tmp_path / "out"), "ord", "1KB")
    with pytest.raises(ValueError, match="two bytes"):
        export_capped(df, str(tmp_path / "out2"), "ord", 1)


def test_many_shards_are_listed_by_few_tasks(spark, tmp_path):
    df = spark.range(300).selectExpr("id AS ord", "repeat('x', 90) AS note")
    path = str(tmp_path / "out")
    export_capped(df, path, "ord", 100)
    context, tracker = spark.sparkContext, spark.sparkContext.statusTracker()
    context.setJobGroup("listing", "listing")
    try:
        assert spark.read.parquet(path).select("shard").distinct().count() == 300
        jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("listing")]
        stages = [tracker.getStageInfo(s) for job in jobs for s in job.stageIds]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert max(stage.numTasks for stage in stages if stage) <= 256
