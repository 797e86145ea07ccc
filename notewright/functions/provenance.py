"""Where a note comes from, told by its id."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from notewright.functions.text import strip

# Id patterns and the addresses they stand for.
BANK_ID = r"(?iU)\Ausmle-(\d+)\z"
ARTICLE_ID = r"(?iU)\Apmc-(\d+)-\d+\z"
TRACK_ID = r"(?iU)\Atrec-(?:cds|ct)-(\d{4})-\d+\z"
BANK_URL = "https://huggingface.co/datasets/mkieffer/MedQA-USMLE/viewer/default/us_qbank?row="
ARTICLE_URL = "https://pmc.ncbi.nlm.nih.gov/articles/PMC"
TRACK_URL = "https://www.trec-cds.org/"


def normal_id(id_col: Column) -> Column:
    return F.lower(strip(id_col))


def bank_key(id_col: Column) -> Column:
    """The key to look up a bank row with; null for ids of every other family."""
    key = normal_id(id_col)
    return F.when(key.rlike(BANK_ID), key)


def source_url(id_col: Column, bank_row: Column) -> Column:
    """``bank_row`` is the looked-up row number, null where there is none."""
    key = normal_id(id_col)
    return (
        F.when(key.rlike(BANK_ID), F.concat(F.lit(BANK_URL), bank_row.cast("string")))
        .when(
            key.rlike(ARTICLE_ID),
            F.concat(F.lit(ARTICLE_URL), F.regexp_extract(key, ARTICLE_ID, 1), F.lit("/")),
        )
        .when(
            key.rlike(TRACK_ID),
            F.concat(F.lit(TRACK_URL), F.regexp_extract(key, TRACK_ID, 1), F.lit(".html")),
        )
    )
