"""Leave out what an earlier run already did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.functions.text import strip
from notewright.operators.joins import salted_join


def clean_ids(lines: DataFrame, column: str = "line") -> DataFrame:
    """Ids out of the lines of a log: outer blanks off, empty lines out, each id once."""
    ids = lines.select(strip(F.col(column)).alias("id"))
    return ids.where(F.col("id") != "").distinct()


def without_done(notes: DataFrame, done: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Notes whose id is not in ``done (id)``. Rows that share a new id all stay.

    No broadcast is asked for: the list of done ids grows with the corpus, and the planner broadcasts
    it by itself where its size allows. An id on very many rows is spread over the tasks; such ids are
    looked for in ``ids``, which may be the plain corpus where ``notes`` has been filtered by its text.
    """
    return salted_join(notes, done, "id", "left_anti", spread_by="ord", keys=ids)
