import numpy as np
import pytest

from notewright.llm import suffix
from notewright.llm.base import table


def plain_cut(rows):
    """Every string of every text looked up in those of documents with smaller ids."""
    seen = set()
    order = lambda r: (r[0] is None, r[0] or 0)
    rows = sorted(rows, key=order)
    waiting, last = set(), None
    out = []
    for doc_id, text in rows:
        if order((doc_id, None)) != last:
            seen |= waiting
            waiting, last = set(), order((doc_id, None))
        data = (text or "").encode()
        change = np.zeros(len(data) + 1, dtype=int)
        for p in range(len(data) - 49):
            part = data[p:p + 50]
            if part in seen:
                change[p] += 1
                change[p + 50] -= 1
            waiting.add(part)
        gone = np.cumsum(change[:-1]) > 0
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((doc_id, kept, len(data), len(data) - len(kept), spans))
    return sorted(out, key=repr)


def cut(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    return sorted((tuple(r) for r in suffix.without_repeats(df).collect()), key=repr)


def as_rows(got):
    return [(i, bytes(kept), *rest) for i, kept, *rest in got]


def test_ranks_are_those_of_sorted_strings():
    rng = np.random.default_rng(1)
    around = rng.integers(97, 99, (60, suffix.WIDTH + 2), dtype=np.uint8)
    around[30:] = around[:30]
    around[40:, 55:] = 98
    order, rank = suffix.suffix_array(around)
    strings = [bytes(around[k // suffix.STARTS, k % suffix.STARTS:k % suffix.STARTS + 50]) for k in order]
    assert strings == sorted(strings)
    common = suffix.common_prefixes(around, order)
    for k in range(1, len(order)):
        same = [a == b for a, b in zip(strings[k - 1], strings[k])]
        assert common[k] == (same.index(False) if False in same else 50)
    assert common[0] == 0 and rank.shape == (60, suffix.STARTS)


def test_equal_strings_have_equal_anchors():
    rng = np.random.default_rng(2)
    shared = rng.integers(0, 4, 50, dtype=np.uint8)
    for _ in range(50):
        texts = [np.concatenate([rng.integers(0, 4, 80, dtype=np.uint8), shared, rng.integers(0, 4, 70, dtype=np.uint8)])
                 for _ in range(2)]
        inside = []
        for text in texts:
            at, hashes = suffix.anchors(text)
            here = (at >= 80) & (at <= 80 + 50 - suffix.GRAM)
            inside.append(set(zip((at[here] - 80).tolist(), hashes[here].tolist())))
        assert inside[0] & inside[1]


def test_small_cases(spark):
    a = "".join(chr(97 + (k * k + k // 7) % 26) for k in range(200))
    rows = [
        (5, a), (3, "start " + a[20:90] + " end"), (4, a[20:69]), (9, a[20:70]), (7, a), (7, a), (None, a[:60]),
        (None, a[:60]), (1, "x" * 120), (2, "x" * 60), (6, "é" * 40 + a[100:150]), (8, ""), (10, None),
        (11, "ü" + "é" * 30 + a[100:150] + a[:50]),
    ]
    assert as_rows(cut(spark, rows)) == plain_cut(rows)


@pytest.mark.parametrize("seed", range(3))
def test_random_pieces(spark, seed):
    rng = np.random.default_rng(seed)
    pieces = ["".join(map(chr, rng.integers(97, 100, n))) for n in (30, 49, 50, 51, 75, 76, 77, 120, 300)]
    rows = []
    for k in range(150):
        parts = [pieces[i] if rng.random() < 0.6 else "".join(map(chr, rng.integers(97, 123, 40)))
                 for i in rng.integers(0, len(pieces), rng.integers(1, 6))]
        rows.append((int(rng.integers(0, 140)), "".join(parts)))
    assert as_rows(cut(spark, rows)) == plain_cut(rows)


def test_whole_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    assert as_rows(cut(spark, [tuple(r) for r in docs.collect()])) == plain_cut([tuple(r) for r in docs.collect()])


def test_several_chunks(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    monkeypatch.setattr(suffix, "SORTED_AT_ONCE", 64)
    df = spark.createDataFrame(rows + rows[:40], "doc_id bigint, text string").repartition(7)
    got = sorted((tuple(r) for r in suffix.without_repeats(df).collect()), key=repr)
    assert as_rows(got) == plain_cut(rows + rows[:40])


def test_odd_rows(odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    got = sorted((tuple(r) for r in suffix.without_repeats(odd_documents).collect()), key=repr)
    assert as_rows(got) == plain_cut(rows)
    assert suffix.without_repeats(no_documents).count() == 0
