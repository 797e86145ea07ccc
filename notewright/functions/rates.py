"""Divisions and time spans of the run metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rate(num: Column, den: Column) -> Column:
    """``num / den``, and 0.0 where there is nothing to divide by."""
    return F.when(den > 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)).cast("double") / F.lit(1e6)
