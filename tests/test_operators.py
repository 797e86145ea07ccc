import hashlib
import random

import pytest
from pyspark.sql import functions as F

from notewright.operators import filters, limits
from notewright.operators.duplicates import in_pieces
from notewright.operators.joins import heavy_keys, salted_join
from notewright.operators.resume import clean_ids, without_done

NOTES = "ord bigint, id string, note string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_valid_notes(spark):
    data = [(0, "a", "x"), (1, "", "x"), (2, None, "x"), (3, "b", ""), (4, "c", None), (5, " ", "x")]
    notes = spark.createDataFrame(data, NOTES)
    assert [r[0] for r in rows(filters.valid_notes(notes))] == [0, 3, 5]


def test_valid_bench_notes(spark):
    data = [(0, "a", "x", "o"), (1, "", "x", "o1"), (2, None, "x", None), (3, "b", None, "o"), (4, "", "", "")]
    notes = spark.createDataFrame(data, NOTES + ", other_id string")
    assert rows(filters.valid_bench_notes(notes)) == [(0, "a", "x"), (1, "o1", "x"), (2, None, "x"), (4, None, "")]
    assert rows(filters.valid_bench_notes(notes, 4)) == [(0, "a", "x"), (1, "o1", "x")]
    plain = notes.drop("other_id")
    assert rows(filters.valid_bench_notes(plain, 4)) == [(0, "a", "x")]


def test_shards_partition_the_notes(spark):
    data = [(i, f"id-{i}", "x") for i in range(200)]
    notes = spark.createDataFrame(data, NOTES)
    parts = [rows(filters.shard_only(notes, 5, s)) for s in range(5)]
    assert sorted(sum(parts, [])) == data
    for shard, part in enumerate(parts):
        assert all(int(hashlib.md5(i.encode()).hexdigest(), 16) % 5 == shard for _, i, _ in part)
    assert rows(filters.shard_only(notes, 1, 0)) == sorted(data, key=repr)


def test_id_family_is_strict(spark):
    ids = ["usmle-1", "usmle-007", "USMLE-1", " usmle-1", "usmle-1\n", "usmle-", "xusmle-1", "usmle-1-2", None, "usmle-٣"]
    notes = spark.createDataFrame([(i, v, "x") for i, v in enumerate(ids)], NOTES)
    got = {r["id"]: r["num"] for r in filters.family_notes(notes, "usmle").collect()}
    assert got == {"usmle-1": 1, "usmle-007": 7, "usmle-٣": None}


def test_note_by_id_takes_the_first(spark):
    notes = spark.createDataFrame([(5, "a", "late"), (2, "a", "early"), (1, "b", "x")], NOTES)
    assert rows(filters.note_by_id(notes, "a")) == [(2, "a", "early")]
    other = notes.withColumn("other_id", F.lit("z")).withColumn("id", F.lit(""))
    assert filters.note_by_id(other, "z").first()["ord"] == 1
    with pytest.raises(LookupError):
        filters.require_row(filters.note_by_id(notes, "z"), "id z")


def test_nonblank(spark):
    data = [(0, "a", " \t\n"), (1, "b", ""), (2, "c", None), (3, "d", " "), (4, "e", " x ")]
    assert [r[0] for r in rows(filters.nonblank_notes(spark.createDataFrame(data, NOTES)))] == [4]


@pytest.mark.parametrize("how", ["left", "inner", "left_anti", "left_semi"])
@pytest.mark.parametrize("kind", ["string", "binary"])
def test_salted_join_is_the_plain_join(spark, how, kind):
    rng = random.Random(3)
    keys = ["hot"] * 400 + [None] * 200 + [f"k{rng.randrange(300)}" for _ in range(400)]
    left = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "ord bigint, k string")
    right = spark.createDataFrame(
        [("hot", 1), ("hot", 2)] + [(f"k{i}", i) for i in range(0, 300, 2)], "k string, v int"
    )
    left, right = (d.withColumn("k", F.col("k").cast(kind)) for d in (left, right))
    hot = left.where("ord = 0").select(F.xxhash64("k")).first()[0]
    assert heavy_keys(left, "k", 4) == [(hot, 8)]
    salted = salted_join(left, right, "k", how, spread_by="ord")
    plain = left.join(right, "k", how)
    assert salted.columns == ["ord", "k"] + (["v"] if how in ("left", "inner") else [])
    plain = plain.select(*salted.columns)
    assert rows(salted) == rows(plain)
    superset = left.unionByName(left).select("k")
    assert rows(salted_join(left, right, "k", how, "ord", keys=superset)) == rows(plain)


def test_salted_join_wants_one_type(spark):
    left = spark.range(3).selectExpr("id AS ord", "cast(id AS int) AS k")
    with pytest.raises(TypeError):
        salted_join(left, spark.range(3).selectExpr("id AS k"), "k", "inner", "ord")


def test_heavy_keys_are_bounded(spark):
    df = spark.range(10_000).select((F.col("id") % 7).alias("k"))
    for parts in (1, 3, 7, 8, 50):
        heavy = heavy_keys(df, "k", parts)
        assert len(heavy) <= parts
        assert sum(n for _, n in heavy) <= 5 * parts
    assert heavy_keys(df.limit(0), "k", 8) == []
    assert len(heavy_keys(df.select(F.lit("one").alias("k")), "k", 8)) == 1


def test_hot_key_is_spread(spark):
    left = spark.range(40_000).select(F.col("id").alias("ord"), F.lit("hot").alias("k"))
    right = spark.createDataFrame([("hot", 1)], "k string, v int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, "k", "inner", "ord")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 40_000 and len(sizes) == 4 and max(sizes) < 25_000


def test_resume_keeps_repeats_of_new_ids(spark):
    notes = spark.createDataFrame([(0, "a", "x"), (1, "a", "y"), (2, "b", "z"), (3, "b", "z")], NOTES)
    done = spark.createDataFrame([("b",)], "id string")
    assert [r[0] for r in rows(without_done(notes, done))] == [0, 1]
    assert without_done(notes, done.limit(0)).count() == 4


def test_clean_ids(spark):
    lines = spark.createDataFrame([(" a ",), ("a",), ("",), ("\t",), ("b\x1f",), (None,)], "line string")
    assert rows(clean_ids(lines)) == [("a",), ("b",)]


@pytest.mark.parametrize("n", [0, 1, 50, 200, 500])
@pytest.mark.parametrize("spread", [1, 65_537, 2**40 + 3])
def test_first_rows(spark, n, spread):
    rng = random.Random(n)
    ords = [spread * o for o in rng.sample(range(-1000, 3000), 200)]
    df = spark.createDataFrame([(o, o % 3, "x") for o in ords], "ord bigint, shard int, note string")
    want = sorted(ords)[:n] if n else sorted(ords)
    assert sorted(r["ord"] for r in limits.first_rows(df, n).collect()) == want
    each = [sorted(o for o in ords if o % 3 == s) for s in range(3)]
    got = limits.first_rows(df, n, per_shard=True)
    assert sorted(r["ord"] for r in got.collect()) == sorted(o for part in each for o in part[:n or None])
    assert got.columns == df.columns


def test_first_rows_neither_sorts_nor_moves_the_notes(spark):
    df = spark.range(100).selectExpr("id AS ord", "cast(id % 3 AS int) AS shard", "repeat('x', 50) AS note")
    for per_shard in (False, True):
        plan = limits.first_rows(df, 5, per_shard)._jdf.queryExecution().executedPlan().toString()
        assert not any("note" in line for line in plan.splitlines() if "Exchange hash" in line or "Sort [" in line)


def test_seeded_pick_does_not_depend_on_layout(spark):
    notes = spark.createDataFrame([(i, f"id-{i}", "x") for i in range(100)], NOTES)
    first = rows(limits.seeded_pick(notes, 5))
    assert rows(limits.seeded_pick(notes.repartition(7), 5)) == first
    picks = {rows(limits.seeded_pick(notes, seed))[0][0] for seed in range(8)}
    assert len(picks) > 3


def test_long_lists_go_on_in_further_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("ord"), F.lit("g").alias("g"), (F.col("id") * 2).alias("v"))
    pieces = in_pieces(df.repartition(5), "g", "v", "vs", piece=64).orderBy("piece").collect()
    assert all(len(r["vs"]) <= 64 for r in pieces)
    assert [v for r in pieces for v in r["vs"]] == [2 * i for i in range(1000)]


@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_rows_without_a_key_are_spread_without_any_heavy_key(spark, how):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        left = spark.range(40_000).selectExpr("id AS ord", "IF(id % 10 = 0, concat('k', id), NULL) AS key")
        right = spark.range(0, 40_000, 20).selectExpr("concat('k', id) AS key", "id AS value")
        if how == "left_anti":
            right = right.select("key")
        joined = salted_join(left, right, "key", how, spread_by="ord")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == (40_000 if how == "left" else 38_000)
        assert max(sizes) < 2 * sum(sizes) / 16
    finally:
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
