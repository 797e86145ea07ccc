"""From raw documents to packed training sequences: five stages, each written as Parquet before the next reads it.

Every stage works on all that its predecessor kept. The first three drop rows, the fourth redacts texts, the last
packs. Columns that ``documents`` has beside its own pass through to the last stage.

What a stage does with odd rows is the rule of its operator: null texts are empty and fail the quality rules, rows
without an id are documents like others, equal rows are near copies of which one stays, and an empty table gives
empty results throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notewright.llm import decontaminate, packing, quality, secrets, simhash
from notewright.llm.base import ready, table
from notewright.session import scratch_path, settle


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, with the labelled good ones as trusted text."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints of three-word shingles link at two differing bits."""
    ready(spark)
    return simhash.first_of_linked(docs, shingle=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts replaced by a mark."""
    ready(spark)
    return secrets.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    ready(spark)
    return packing.pack_documents(docs, packing.vocabulary(), capacity=2048)


STAGES = [
    ("quality_rules", keep_good),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]

# Hashes of 64 bits, tokens and compression have no SQL; the stages are tested against plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from ``documents``; what each stage returns is written to shared storage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), scratch_path(spark, f"stage-{name}"))
    return docs
