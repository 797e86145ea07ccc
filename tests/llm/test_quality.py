import math
import re
from collections import Counter

import pytest

from notewright.llm import quality
from notewright.llm.base import table

SF_DIR = "/root/testdata/sf0.001"
FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    windows = [tuple(words[k:k + 8]) for k in range(len(words) - 7)]
    often = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), n < 20 or 100 * len(covered) > 30 * n)


def found(df):
    return [(r["row"], tuple(r["quality"][f] for f in FIELDS), r["quality"]) for r in df.collect()]


def test_base_rules_against_plain_counts(spark):
    docs = table(spark, SF_DIR, "documents")
    got = found(quality.quality_rules(docs, table(spark, SF_DIR, "labels")))
    assert len(got) == docs.count()
    for row, base, _ in got:
        assert base == plain_base(row["text"])


@pytest.mark.parametrize("text", [
    "a b c d e f g h " * 3, "a b c d e f g h i a b c d e f g h j", "x\n\nx\n \nx y\nx", "|".join("abc"),
    "a a a a a a a a a a", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8", "    a\x0bb\x0cc", "🙂 é\x00ü",
])
def test_base_rules_of_small_texts(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    assert found(quality.judged(df, [0] * quality.BUCKETS))[0][1] == plain_base(text)


def test_scores_against_plain_ratios(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    rows = docs.collect()
    hashed = {
        r["doc_id"]: [b % quality.BUCKETS for b in (*r["_h1"], *r["_h2"])]
        for r in quality.with_hashes(docs.select("doc_id", "text")).collect()
    }
    raw, trusted = Counter(), Counter()
    for doc_id, buckets in hashed.items():
        raw.update(buckets)
        if doc_id in good:
            trusted.update(buckets)
    ratio = lambda b: (
        math.log((trusted[b] + 1) / (sum(trusted.values()) + quality.BUCKETS))
        - math.log((raw[b] + 1) / (sum(raw.values()) + quality.BUCKETS))
    )
    for row, _, got in found(quality.quality_rules(docs, labels)):
        buckets = hashed[row["doc_id"]]
        assert got["score"] == pytest.approx(sum(map(ratio, buckets)) / len(buckets), abs=1e-3)
        assert got["kept"] == (not got["base_failed"] and got["score"] >= quality.THRESHOLD)
    assert len(rows) == len(hashed)


def test_good_documents_stay_and_bad_ones_go(spark):
    docs, labels = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "labels")
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    judged = [(marks.get(row["doc_id"]), q) for row, _, q in found(quality.quality_rules(docs, labels))]
    good = [q["kept"] for mark, q in judged if mark == 1 and not q["base_failed"]]
    bad = [q["kept"] for mark, q in judged if mark == 0]
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_no_python_on_the_way(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    plan = quality.quality_rules(docs, labels)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_a_filter_on_the_verdict_does_not_repeat_the_work(spark):
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    plan = quality.good_documents(docs, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 3 and plan.count("xxhash64(") <= 4


def test_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (5, None)], "doc_id bigint, quality int")
    got = found(quality.quality_rules(odd_documents, labels))
    assert len(got) == 11 and all(base == plain_base(row["text"]) for row, base, _ in got)
    assert all(q["score"] == 0 for row, _, q in got if not (row["text"] or "").split())
    kept = quality.good_documents(odd_documents, labels)
    assert kept.schema == odd_documents.schema
    assert quality.good_documents(no_documents, labels).count() == 0
    unlabelled = found(quality.quality_rules(odd_documents, labels.limit(0)))
    assert all(q["score"] == 0 for _, _, q in unlabelled)
