"""Quality rules: fixed base rules, and a hashed n-gram log-likelihood ratio of trusted to raw text.

Everything here is DataFrame functions. Words and pairs of words are hashed to a fixed number of buckets. The raw
multinomial counts every document, the trusted one the documents
of a bounded sample of ids. A document's score is the mean over its words and pairs of
log(p_trusted / p_raw), so it does not depend on length; it is kept at or above a fixed threshold.

Null text counts as empty. A text without words has score 0 and fails the base rules. Repeated rows are each
counted and each judged by themselves; without trusted documents every score is 0.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.llm.base import whole_row, whole_text, word_array

# Fixed values of the base rules.
SYMBOLS = "[#*$%&|<>]"
REPEAT_WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

BUCKETS = 1 << 14
TRUSTED_IDS = 20_000
THRESHOLD = -0.1
# Weights travel in the plan as whole thousandths.
SCALE = 1000


def _shifted(array: Column, step: int, size: Column) -> tuple[Column, Column]:
    """The array without its last ``step`` elements, and without its first."""
    length = F.greatest(size - F.lit(step), F.lit(0))
    return F.slice(array, 1, length), F.slice(array, 1 + step, length)


def with_hashes(rows: DataFrame) -> DataFrame:
    """Adds ``_words``, ``_n``, and the hashes of words ``_h1`` and of pairs of words ``_h2``."""
    pair = lambda a, b: F.xxhash64(a, b)
    return (
        rows.withColumn("_words", word_array(whole_text()))
        .withColumn("_n", F.size("_words"))
        .withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
        .withColumn("_h2", F.zip_with(*_shifted(F.col("_h1"), 1, F.col("_n")), pair))
    )


def with_repeats(rows: DataFrame) -> DataFrame:
    """Adds ``_repeat``: the words that lie in windows of eight words found twice or more in the text."""
    pair = lambda a, b: F.xxhash64(a, b)
    rows = rows.withColumn("_h4", F.zip_with(*_shifted(F.col("_h2"), 2, F.size("_h2")), pair))
    # A window of eight words that comes twice holds a run of four that comes twice.
    maybe = F.size(F.array_distinct("_h4")) < F.size("_h4")
    rows = rows.withColumn("_h8", F.when(maybe, F.zip_with(*_shifted(F.col("_h4"), 4, F.size("_h4")), pair)))
    twice = F.size(F.array_distinct("_h8")) < F.size("_h8")
    placed = F.sort_array(F.transform("_h8", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(twice, placed))
    equal = lambda a, b: F.when(
        a["h"] == b["h"], F.array(a["i"], b["i"])
    ).otherwise(F.array().cast("array<int>"))
    found = F.flatten(F.zip_with(*_shifted(F.col("_sorted"), 1, F.size("_sorted")), equal))
    rows = rows.withColumn("_at", F.sort_array(F.array_distinct(found)))
    # Each window adds its words up to the start of the next one; ``least`` skips the null after the last.
    fresh = F.zip_with("_at", F.slice("_at", 2, F.greatest(F.size("_at"), F.lit(1))),
                       lambda a, b: F.least(b - a, F.lit(REPEAT_WINDOW)))
    covered = F.aggregate(fresh, F.lit(0).cast("bigint"), lambda total, n: total + n)
    return rows.withColumn("_repeat", F.coalesce(covered, F.lit(0).cast("bigint")))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def trusted_ids(labels: DataFrame, most: int = TRUSTED_IDS) -> DataFrame:
    """At most ``most`` ids of documents labelled good, picked by a hash; bounded, so it may be broadcast."""
    good = labels.where(F.col("quality") == 1).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return good.dropna().distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def train_weights(docs: DataFrame, trusted: DataFrame) -> list[int]:
    """The weight of each bucket, in thousandths: ``BUCKETS`` numbers, whatever the corpus holds."""
    known = F.broadcast(trusted.select("doc_id", F.lit(1).alias("_good")))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    rows = with_hashes(rows.join(known, "doc_id", "left"))
    each = rows.select("_good", F.explode(F.concat("_h1", "_h2")).alias("_h"))
    counted = each.groupBy(_bucket(F.col("_h")).alias("bucket")).agg(F.count("_good"), F.count("*")).collect()
    counts = {bucket: (good, raw) for bucket, good, raw in counted}
    good = sum(g for g, _ in counts.values())
    raw = sum(r for _, r in counts.values())
    if not good:
        return [0] * BUCKETS
    pairs = [counts.get(b, (0, 0)) for b in range(BUCKETS)]
    level = math.log((raw + BUCKETS) / (good + BUCKETS))
    return [round(SCALE * (math.log((g + 1) / (r + 1)) + level)) for g, r in pairs]


def judged(docs: DataFrame, weights: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """``(row, quality)``: every row of ``docs`` as it is, and what was found out about it.

    The fields of ``quality`` are ``n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed score kept``.
    A row is judged where it stands; nothing is shuffled.
    """
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    rows = with_repeats(with_hashes(docs.select(whole_row(docs), whole_text().alias("text"))))
    text = whole_text()
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    every = F.concat("_h1", "_h2")
    total = F.aggregate(every, F.lit(0).cast("bigint"), lambda s, h: s + F.get(table, _bucket(h)))
    rows = rows.withColumn("_lines", lines).withColumn("_total", total)
    count = lambda c: c.cast("bigint")
    n, repeat = count(F.col("_n")), F.col("_repeat")
    failed = (n < LEAST_WORDS) | (F.lit(100) * repeat > F.lit(MOST_REPEATED_PERCENT) * n)
    score = F.col("_total") / (F.lit(SCALE) * F.greatest(2 * n - 1, F.lit(1)))
    # Always true, but not for the optimizer to know: a filter on the verdict would else be moved below all these
    # columns, with each of them written out in it as often as the next one uses it.
    once = F.monotonically_increasing_id() >= 0
    return rows.select("row", F.struct(
        n.alias("n_words"),
        count(F.char_length(F.array_join("_words", ""))).alias("word_chars"),
        count(F.regexp_count(text, F.lit(SYMBOLS))).alias("n_symbols"),
        count(F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        repeat.alias("n_repeat_words"),
        failed.alias("base_failed"),
        score.alias("score"),
        (~failed & (score >= F.lit(threshold)) & once).alias("kept"),
    ).alias("quality"))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``judged`` with weights trained on ``docs`` itself and the bounded trusted sample of ``labels``."""
    return judged(docs, train_weights(docs, trusted_ids(labels)), threshold)


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that the rules keep."""
    return quality_rules(docs, labels, threshold).where("quality.kept").select("row.*")
