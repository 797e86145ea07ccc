"""Match notes to a question bank by their exact text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.text import text_key, to_whole_number
from notewright.operators.joins import salted_join
from notewright.session import scratch_path, settle


def usable_questions(bank: DataFrame) -> DataFrame:
    """Bank rows ``(ord, idx, key)`` with a question and a whole-number index."""
    rows = bank.select(
        "ord", to_whole_number(F.col("idx_raw")).alias("idx"), text_key(F.col("question")).alias("key")
    )
    return rows.where(F.col("idx").isNotNull() & F.col("key").isNotNull())


def bank_counts(bank: DataFrame) -> DataFrame:
    """Bank rows in all, and those left out for a missing question or a bad index."""
    bad = F.col("question").isNull() | to_whole_number(F.col("idx_raw")).isNull()
    return bank.agg(
        F.count("*").alias("bank_total"), F.count_if(bad).alias("bank_missing_fields")
    )


def candidates(questions: DataFrame) -> DataFrame:
    """One row per question text: its first index in bank order, and how many there are."""
    return questions.groupBy("key").agg(
        F.min_by("idx", "ord").alias("first_idx"), F.count("*").alias("n_candidates")
    )


def match_first(rows: DataFrame, questions: DataFrame) -> DataFrame:
    """Add ``first_idx`` and ``n_candidates`` to rows ``(ord, id, key)``; null and 0 without a match.

    The keys are written to shared storage first, so that the texts behind them are read once, and not
    again to look for heavy ones.
    """
    rows = settle(rows, scratch_path(rows.sparkSession, "keyed"))
    found = salted_join(rows, candidates(questions), "key", "left", spread_by="ord")
    return found.withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))


def shift_histogram(matched: DataFrame) -> DataFrame:
    """How often each distance between the number in the id and the matched index occurs.

    Numbers of up to 37 digits are exact. Ids with longer numbers have no shift; they are counted together,
    in the row whose ``shift`` is null.
    """
    shift = F.try_subtract(F.col("num").cast("decimal(38,0)"), F.col("first_idx").cast("decimal(38,0)"))
    return (
        matched.where(F.col("first_idx").isNotNull())
        .groupBy(shift.cast("decimal(38,0)").alias("shift"))
        .agg(F.count("*").alias("n"))
    )


def constant_shift(histogram: DataFrame) -> DataFrame:
    """One row: the distance if all matches share it, else null."""
    return histogram.agg(
        F.when(F.count("*") == 1, F.min("shift")).alias("shift"),
    )
