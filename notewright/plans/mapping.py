"""The mapping job: which bank row does each note of one id family come from?

Notes and bank are brought together by text in one aggregate over their union, so a text that a third
of all rows share, on either side, is counted down before anything is shuffled. What that finds out
about a text goes back to its first row only, by ``ord``. Of the texts themselves only the first of each
group of duplicates is shuffled, to be shown in the report.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.operators.duplicates import (
    PIECE, group_members, in_pieces, keep_first, keyed, later_rows, mark_first, with_text,
)
from notewright.operators.filters import family_notes
from notewright.operators.joins import salted_join
from notewright.operators.matching import constant_shift, shift_histogram, usable_questions
from notewright.session import path_exists, remove_path, scratch_path, settle

MISSING_SAMPLES = 5


@dataclass(frozen=True)
class MappingReport:
    """The parts of the report, each a table that is planned when it is asked for.

    Lists longer than ``piece`` go on in further rows.
    """

    notes: DataFrame  # ord, id, note
    bank: DataFrame  # ord, idx_raw, question
    questions: DataFrame  # ord, idx, key: the usable bank rows
    marked: DataFrame  # rows of the family; the first of each text carries what is known about it
    kept: DataFrame  # those that are left without duplicates, with their match
    family: str
    piece: int = PIECE
    max_missing: int = MISSING_SAMPLES

    @property
    def matched(self) -> DataFrame:
        return self.kept.where(F.col("n_candidates") > 0)

    @property
    def summary(self) -> DataFrame:
        """One row of counts, and the shift where it is constant."""
        return summary(
            self.notes, self.bank, self.questions, self.kept, self.shift_histogram
        )

    @property
    def dropped_ids(self) -> DataFrame:
        """``ord, id`` of every row whose text an earlier row has."""
        return later_rows(self.marked).select("ord", "id")

    @property
    def duplicate_groups(self) -> DataFrame:
        """``key, ord, id, n_ids, note``: one row per text that several rows share, from the first."""
        shared = self.marked.where(F.col("n_ids") > 1).select("key", "ord", "id", "n_ids")
        return with_text(shared, family_notes(self.notes, self.family))

    @property
    def duplicate_members(self) -> DataFrame:
        """``key, piece, ids[]`` for the same texts."""
        return in_pieces(group_members(self.marked), "key", "id", "ids", self.piece)

    @property
    def ambiguous(self) -> DataFrame:
        """``id, piece, candidates[]`` for ids with more than one bank row."""
        return ambiguous_candidates(self.kept, self.questions, self.piece)

    @property
    def missing_samples(self) -> DataFrame:
        """``id, reason`` of the first rows without a match."""
        return first_missing(self.kept, self.max_missing)

    @property
    def shift_histogram(self) -> DataFrame:
        """``shift, n``."""
        return shift_histogram(self.matched)

    @property
    def mapping(self) -> DataFrame:
        """``id, row``: what the provenance lookup reads."""
        return id_rows(self.matched)


REPORT_PARTS = (
    "dropped_ids", "duplicate_groups", "duplicate_members", "ambiguous", "missing_samples",
    "shift_histogram", "mapping", "summary",
)


def shared_texts(rows: DataFrame, questions: DataFrame) -> DataFrame:
    """One row per text: its first note and its first bank row, and how many of each there are."""
    left = rows.where(F.col("key").isNotNull()).select("key", "ord")
    right = questions.select("key", F.col("ord").alias("bank_ord"), "idx")
    return (
        left.unionByName(right, allowMissingColumns=True)
        .groupBy("key")
        .agg(
            F.min("ord").alias("first_ord"),
            F.count("ord").alias("n_ids"),
            F.min_by("idx", "bank_ord").alias("first_idx"),
            F.count("bank_ord").alias("n_candidates"),
        )
    )


def map_notes(
    notes: DataFrame, bank: DataFrame, family: str = "usmle", piece: int = PIECE,
    missing_samples: int = MISSING_SAMPLES, work_dir: str | None = None,
) -> MappingReport:
    """Run the job and return the report for ``notes (ord, id, note)`` and ``bank (ord, idx_raw, question)``.

    The steps that several tables share are written to ``work_dir``, by default a new folder in the
    shared scratch folder, and read back: each runs once, the texts are read once, and later stages do
    not depend on the executors that ran the earlier ones.
    """
    work_dir = work_dir or scratch_path(notes.sparkSession, "mapping")
    family_rows = family_notes(notes.select("ord", F.col("id").cast("string"), "note"), family)
    rows = settle(keyed(family_rows), f"{work_dir}/rows")
    questions = settle(usable_questions(bank), f"{work_dir}/questions")
    marked = settle(mark_first(rows, shared_texts(rows, questions)), f"{work_dir}/marked")
    kept = settle(keep_first(marked, keys=rows.select("id")), f"{work_dir}/kept")
    kept = kept.withColumn("n_candidates", F.coalesce("n_candidates", F.lit(0)))
    return MappingReport(
        notes, bank, questions, marked, kept, family, piece, missing_samples
    )


def id_rows(matched: DataFrame) -> DataFrame:
    """One row per id; where an id was matched with several texts, the last match stays."""
    return matched.groupBy("id").agg(F.max_by("first_idx", "ord").alias("row"))


def ambiguous_candidates(kept: DataFrame, questions: DataFrame, piece: int = PIECE) -> DataFrame:
    """All bank rows of each ambiguous id: of its last such text, should it have several.

    Each text is left with one row in ``kept``, so this is at most one line per bank row.
    """
    last = (
        kept.where(F.col("n_candidates") > 1).groupBy("id").agg(F.max_by("key", "ord").alias("key"))
    )
    listed = salted_join(questions, last, "key", "inner", spread_by="ord")
    return in_pieces(listed, "id", "idx", "candidates", piece)


def first_missing(kept: DataFrame, n: int = MISSING_SAMPLES) -> DataFrame:
    """The first ``n`` rows without a match, and why."""
    reason = F.when(F.col("key").isNull(), "missing description").otherwise("no matching question")
    missing = kept.where(F.col("n_candidates") == 0).withColumn("reason", reason)
    return missing.orderBy("ord").limit(n).select("id", "reason")


def summary(
    notes: DataFrame, bank: DataFrame, questions: DataFrame, kept: DataFrame, histogram: DataFrame
) -> DataFrame:
    """All counts of the job in one row, from five one-row aggregates side by side.

    Bank rows that are left out are all rows less the usable ones, so no text is read again for this.
    """
    parts = [
        notes.agg(F.count("*").alias("notes_total")),
        bank.agg(F.count("*").alias("bank_total")),
        questions.agg(F.count("*").alias("usable")),
        kept.agg(
            F.count("*").alias("family_rows"),
            F.count_if(F.col("n_candidates") > 0).alias("matched"),
            F.count_if(F.col("n_candidates") > 1).alias("ambiguous"),
            F.count_if(F.col("n_candidates") == 0).alias("missing"),
        ),
        constant_shift(histogram),
    ]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    row = stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
    bad = (F.col("bank_total") - F.col("usable")).alias("bank_missing_fields")
    return row.select(
        "notes_total", "bank_total", bad, "family_rows", "matched", "ambiguous", "missing", "shift"
    )


def run_mapping(
    notes: DataFrame, bank: DataFrame, path: str, force: bool = False, **options
) -> bool:
    """Write the report under ``path``, unless a whole one is there already and ``force`` is not set.

    The summary is written last and so tells that the report is whole; a forced run takes the old one away
    first, so a run that fails half way leaves no report that looks whole. Returns whether the job ran.
    """
    if not force and path_exists(notes.sparkSession, f"{path}/summary/_SUCCESS"):
        return False
    remove_path(notes.sparkSession, f"{path}/summary")
    report = map_notes(notes, bank, **options)
    for part in REPORT_PARTS:
        getattr(report, part).write.mode("overwrite").parquet(f"{path}/{part}")
    return True
