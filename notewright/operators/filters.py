"""Row filters over the notes corpus ``(ord, id, note)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.functions.hashing import shard_of
from notewright.functions.text import is_blank


def valid_notes(notes: DataFrame) -> DataFrame:
    """Notes to enrich: a non-empty id and a note. An empty note is a note."""
    return notes.where(F.col("id").isNotNull() & (F.col("id") != "") & F.col("note").isNotNull())


def any_id(notes: DataFrame) -> Column:
    """The id, or where it is empty the ``other_id`` of a corpus that has one; null where both are empty."""
    own = F.when(F.col("id") != "", F.col("id"))
    if "other_id" in notes.columns:
        own = F.coalesce(own, F.when(F.col("other_id") != "", F.col("other_id")))
    return own


def valid_bench_notes(notes: DataFrame, num_shards: int = 1) -> DataFrame:
    """Notes to measure with: only the note must be there; an id is needed only to pick a shard."""
    kept = notes.where(F.col("note").isNotNull()).withColumn("id", any_id(notes)).drop("other_id")
    return kept.where(F.col("id").isNotNull()) if num_shards > 1 else kept


def with_shard(notes: DataFrame, num_shards: int) -> DataFrame:
    return notes.withColumn("shard", shard_of(F.col("id"), num_shards))


def shard_only(notes: DataFrame, num_shards: int, shard: int) -> DataFrame:
    """The rows of one shard. To run all shards use :func:`with_shard` and one job instead."""
    if num_shards <= 1:
        return notes
    return notes.where(shard_of(F.col("id"), num_shards) == shard)


def id_family(family: str) -> str:
    """Pattern of the ids ``<family>-<number>``, in full and in this case only."""
    if not family.isalnum():
        raise ValueError(f"family must be a plain word: {family!r}")
    return rf"(?U)\A{family}-(\d+)\z"


def in_family(id_col: Column, family: str) -> Column:
    return id_col.rlike(id_family(family))


def family_number(id_col: Column, family: str) -> Column:
    """The number in the id, null beyond 37 digits."""
    digits = F.regexp_extract(id_col, id_family(family), 1)
    return F.when(digits.rlike(r"\A0*[0-9]{1,37}\z"), digits.try_cast("decimal(38,0)"))


def family_notes(notes: DataFrame, family: str) -> DataFrame:
    return notes.where(in_family(F.col("id"), family)).withColumn(
        "num", family_number(F.col("id"), family)
    )


def note_by_id(notes: DataFrame, wanted: str) -> DataFrame:
    """The first row with this id, in corpus order."""
    return notes.where(any_id(notes) == wanted).orderBy("ord").limit(1)


def nonblank_notes(notes: DataFrame) -> DataFrame:
    return notes.where(F.col("note").isNotNull() & ~is_blank(F.col("note")))


def require_row(df: DataFrame, what: str) -> DataFrame:
    """Raise where a lookup or a pick found nothing."""
    if df.isEmpty():
        raise LookupError(f"no row found: {what}")
    return df
