import random

import pytest
from pyspark.sql import functions as F

from notewright.operators import facet_index, facets

DDL = "_place bigint, sex string, tags array<string>, parts array<struct<kind: string, n: int>>"


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(5)
    rows = []
    for k in range(200):
        # Places on both sides of the ends of pieces.
        place = [k, 32_700 + k, 65_500 + k][k % 3]
        rows.append((place, rng.choice(["F", "M", None]), rng.choices(["a", "b", "c"], k=rng.randint(0, 3)) or None,
                     [(rng.choice("xyz"), 1) for _ in range(rng.randint(0, 2))]))
    return spark.createDataFrame(rows, DDL)


@pytest.mark.parametrize("wanted", [
    {"sex": ["F"]}, {"sex": ["F", "M"], "tags": ["a"]}, {"tags": ["a", "c"], "parts.kind": ["x"], "sex": ["M"]},
    {"sex": ["none"]}, {"tags": ["b"], "sex": ["none"]},
])
def test_against_the_plain_filter(spark, records, wanted):
    names = ["sex", "tags", "parts.kind"]
    index = facet_index.facet_index(records, names)
    want = facets.facet_filter(records, wanted)
    found = facet_index.matching_records(records, facet_index.matching_bits(index, wanted))
    assert sorted(r["_place"] for r in found.collect()) == sorted(r["_place"] for r in want.collect())
    # A value that a record has twice counts once here.
    values = want.select("_place", F.explode(F.concat(*[facets._facet_values(want, n) for n in names])).alias("e"))
    counts = values.select("_place", "e.*").where("value IS NOT NULL").distinct().groupBy("facet", "value").count()
    drilled = facet_index.filtered_counts(index, wanted)
    assert sorted(map(tuple, drilled.collect())) == sorted(map(tuple, counts.collect()))


def test_no_facet_is_an_error(spark, records):
    with pytest.raises(ValueError, match="no facet"):
        facet_index.matching_bits(facet_index.facet_index(records, ["sex"]), {})
