import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from notewright.llm import lm
from notewright.llm.base import fold, table
from notewright.llm.eliasfano import EliasFano, encode
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=80), st.lists(st.integers(0, 2**64 - 1), max_size=20), st.integers(0, 63))
def test_elias_fano_against_a_sorted_list(values, asked, shift):
    values = np.sort(np.array([v >> shift for v in values], dtype=np.uint64))
    some = EliasFano(b"12345678" + encode(values), 8)
    assert (some.values(np.arange(len(values))) == values).all()
    asked = np.array([a >> shift for a in asked] + values[:20].tolist(), dtype=np.uint64)
    assert (some.successor(asked) == np.searchsorted(values, asked, "left")).all()


def plain_scores(rows, trained, concentration):
    tokens = lambda text: (text or "").encode().lower().split() + [None]
    words, pairs, n_docs = Counter(), Counter(), 0
    for text in trained:
        t = tokens(text)
        words.update(t)
        pairs.update(zip(["<s>"] + t[:-1], t))
        n_docs += 1
    n, v = sum(words.values()), len(words)
    once = sum(c == 1 for c in words.values())
    unknown = min(0.5, max(once / n, 1 / (n + 1))) if n else 1.0
    result = []
    for doc_id, text in rows:
        t = tokens(text)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in t)
        score = 0.0
        for before, w in zip(["<s>"] + t[:-1], t):
            p = (1 - unknown) * words[w] / n if words[w] else unknown
            c = n_docs if before == "<s>" else words[before]
            score += math.log10((pairs[(before, w)] + concentration * p) / (c + concentration))
        result.append((doc_id, len(t), sum(words[w] > 0 for w in t), n, base, score))
    return sorted(result, key=repr)


def check_scores(got, want):
    got = sorted((tuple(r) for r in got), key=repr)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4] == pytest.approx(w[4], rel=1e-9, abs=1e-9)
        # A byte a child: within a hundredth a token, and single precision sums.
        assert abs(g[5] - w[5]) <= 0.02 * g[1] + 1e-4


@pytest.mark.parametrize("shards, chunk", [(60, 20_000), (40, 2_000_000)])
def test_scores_against_plain_counts(spark, shards, chunk):
    docs = table(spark, SF_DIR, "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    model = lm.train(docs.where(~held_out), shards=shards, most=chunk)
    trained = [r["text"] for r in docs.where(~held_out).collect()]
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_scores(model.score(docs, most=chunk).collect(), plain_scores(rows, trained, lm.CONCENTRATION))
    assert model.known.heavy  # the commonest words were dealt over several shards


def test_better_than_the_base_on_held_out_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    held_out = fold(F.col("doc_id"), 7) == 2
    rows = lm.train(docs.where(~held_out)).score(docs.where(held_out)).collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)
    assert all(r["score"] <= 0 for r in rows)


def test_probabilities_of_a_context_sum_to_one(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, "a b b"), (3, "c")], "doc_id bigint, text string")
    model = lm.train(df, concentration=2.0, shards=2)
    asked = spark.createDataFrame([(k, f"a {w}") for k, w in enumerate(["a", "b", "c", "zzz"])], "doc_id bigint, text string")
    alone = {r["doc_id"]: r["score"] for r in model.score(asked).collect()}
    words = ["a", "b", "c"]
    plain = plain_scores([(k, f"a {w}") for k, w in enumerate(words + ["zzz"])], ["a b a c", "a b b", "c"], 2.0)
    for k, *_, score in plain:
        assert alone[k] == pytest.approx(score, abs=1e-5)


def test_odd_rows(spark, odd_documents, no_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    model = lm.train(odd_documents)
    check_scores(model.score(odd_documents).collect(), plain_scores(rows, [t for _, t in rows], lm.CONCENTRATION))
    assert model.score(no_documents).count() == 0
    empty = lm.train(no_documents).score(odd_documents).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in empty} == {(0, 0, 0.0)}
    assert all(abs(r["score"]) < 1e-2 for r in empty)
