import heapq
import zlib
from collections import Counter

import numpy as np

from notewright.llm import sharding
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.01"


def check_shards(rows, n):
    slots = Counter((r["shard"], r["slot"]) for r in rows)
    assert set(slots.values()) <= {1}
    by_shard = Counter(r["shard"] for r in rows)
    assert all(slots[(s, k)] for s, size in by_shard.items() for k in range(size))
    assert set(by_shard) <= set(range(n))
    assert len({(r["key"], r["shard"]) for r in rows}) == len({r["key"] for r in rows})


def test_least_loaded_goes_by_a_heap():
    heap = [(0, k) for k in range(3)]
    assert sharding.least_loaded(np.array([9, 7, 5, 4, 3]), heap).tolist() == [0, 1, 2, 2, 1]
    assert heapq.nsmallest(3, heap) == [(9, 0), (9, 2), (10, 1)]


def test_sizes_are_nearly_equal(spark):
    docs = table(spark, SF_DIR, "documents")
    rows = sharding.balanced_shards(docs, 8).collect()
    check_shards(rows, 8)
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    assert all(r["size"] == len(texts[r["doc_id"]]) + 1 for r in rows)
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]]) for r in rows)
    loads = Counter()
    for r in rows:
        loads[r["shard"]] += r["size"]
    assert max(loads.values()) - min(loads.values()) < 0.01 * sum(loads.values()) / 8


def test_a_large_group_stays_together(spark):
    rows = [(k, "the same text") for k in range(300)] + [(1000 + k, f"text {k}" * 3) for k in range(600)]
    got = sharding.balanced_shards(spark.createDataFrame(rows, "doc_id bigint, text string"), 4).collect()
    check_shards(got, 4)
    assert len({r["shard"] for r in got if r["doc_id"] < 1000}) == 1


def test_odd_rows(odd_documents, no_documents):
    rows = sharding.balanced_shards(odd_documents, 3).collect()
    check_shards(rows, 3)
    assert len(rows) == 11
    assert sorted(r["size"] for r in rows)[:3] == [1, 1, 1]
    assert len({r["shard"] for r in rows if r["size"] == 1}) == 1
    assert sharding.balanced_shards(no_documents, 3).count() == 0
