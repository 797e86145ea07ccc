import bisect
import random

from pyspark.sql import functions as F

from notewright.operators import sketches


def test_merged_runs_keep_the_error(spark, tmp_path):
    rng = random.Random(1)
    values, path = [], str(tmp_path / "runs")
    for run in range(4):
        mine = [int(rng.expovariate(0.001) * (run + 1)) for _ in range(20_000)]
        values += mine
        rows = spark.createDataFrame([(k % 9000, v) for k, v in enumerate(mine)], "id bigint, ms bigint")
        sketches.sketch_run(rows, f"r{run}", {"ms": F.col("ms")}, F.col("id")).write.mode("append").parquet(path)
    values.sort()
    runs = spark.read.parquet(path)
    shares = [0.01, 0.25, 0.5, 0.75, 0.99]
    halves = runs.where("run_tag < 'r2'"), runs.where("run_tag >= 'r2'")
    twice = sketches.merge_runs(halves[0]).unionByName(sketches.merge_runs(halves[1]))
    for merged in (sketches.merge_runs(runs), sketches.merge_runs(twice)):
        for r in sketches.quantiles(merged, "ms", shares).collect():
            low, high = (side(values, r["value"]) / len(values) for side in (bisect.bisect_left, bisect.bisect_right))
            assert r["n"] == 80_000
            assert low - sketches.QUANTILE_ERROR <= r["share"] <= high + sketches.QUANTILE_ERROR
        assert sketches.distinct_ids(merged).first()["n_ids"] == 9000


def test_common_values_and_empty_runs(spark):
    rows = lambda items: spark.createDataFrame([(i,) for i in items], "v string")
    runs = sketches.value_sketch(rows(["a"] * 5 + ["b"] * 3 + [None]), "r0", F.col("v"))
    runs = runs.unionByName(sketches.value_sketch(rows(["b"] * 4 + ["c"]), "r1", F.col("v")))
    runs = runs.unionByName(sketches.value_sketch(rows([None]), "r2", F.col("v")))
    assert sorted(map(tuple, sketches.common_values(runs).collect())) == [("a", 5), ("b", 7), ("c", 1)]
    none = spark.createDataFrame([], "id string, ms bigint")
    run = sketches.sketch_run(none, "r", {"ms": F.col("ms")}, F.col("id"))
    assert sketches.distinct_ids(run).first()["n_ids"] == 0
