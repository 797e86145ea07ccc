"""What many runs have in common, from sketches that each run leaves: no record is read again.

A run's sketches are one small row of binaries for each measured name: quantiles of a number (KLL), distinct ids (theta) and
the most common values (frequent items). They are bounded by their parameters, not by the run. Rows of any runs merge
into one of the same kind, and what they tell keeps the stated errors however often they were merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Of a KLL sketch, the size that bounds its rank error; of a theta sketch, the log of its entries, up to which it is exact.
QUANTILE_K = 400
QUANTILE_ERROR = 0.02  # of the rank, at this k, with 99 % confidence for each quantile
DISTINCT_LOG_K = 16
DISTINCT_ERROR = 0.02
TOP, TRACKED = 20, 1000


def number_sketch(number: Column) -> Column:
    return F.kll_sketch_agg_bigint(number.cast("bigint"), QUANTILE_K)


def id_sketch(ident: Column) -> Column:
    return F.theta_sketch_agg(ident.cast("string"), DISTINCT_LOG_K)


def sketch_run(rows: DataFrame, run_tag: str, numbers: dict[str, Column], ident: Column | None = None) -> DataFrame:
    """One row for a run: ``run_tag``, a sketch ``q_<name>`` for each number, and ``ids`` for the distinct ids."""
    columns = [number_sketch(column).alias(f"q_{name}") for name, column in numbers.items()]
    if ident is not None:
        columns.append(id_sketch(ident).alias("ids"))
    return rows.agg(*columns).select(F.lit(run_tag).alias("run_tag"), "*")


def merge_runs(sketches: DataFrame) -> DataFrame:
    """One row with the sketches of all runs together."""
    merged = [F.kll_merge_agg_bigint(name, QUANTILE_K).alias(name) for name in sketches.columns if name.startswith("q_")]
    if "ids" in sketches.columns:
        merged.append(F.theta_union_agg("ids", DISTINCT_LOG_K).alias("ids"))
    return sketches.agg(*merged)


def quantiles(sketches: DataFrame, name: str, shares: list[float]) -> DataFrame:
    """``(share, n, value)``: how many numbers were sketched, and the one at each share of their order."""
    sketch = F.col(f"q_{name}")
    each = sketches.select(
        F.kll_sketch_get_n_bigint(sketch).alias("n"),
        F.explode(F.array(*[
            F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_bigint(sketch, F.lit(float(s))).alias("value"))
            for s in shares
        ])).alias("q"),
    )
    return each.select("q.share", "n", "q.value")


def distinct_ids(sketches: DataFrame) -> DataFrame:
    return sketches.select(F.theta_sketch_estimate("ids").cast("bigint").alias("n_ids"))


def value_sketch(rows: DataFrame, run_tag: str, value: Column) -> DataFrame:
    """One row for a run: the most common values, such as those outside a field's closed vocabulary."""
    return rows.select(value.cast("string").alias("value")).where("value IS NOT NULL").agg(
        F.expr(f"approx_top_k_accumulate(value, {TRACKED})").alias("top")
    ).select(F.lit(run_tag).alias("run_tag"), "top")


def common_values(sketches: DataFrame, most: int = TOP) -> DataFrame:
    """``(value, n)``: the most common values of all runs; exact while there are fewer values than are tracked."""
    merged = sketches.agg(F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"))
    found = merged.select(F.explode(F.expr(f"approx_top_k_estimate(top, {most})")).alias("e"))
    return found.select(F.col("e.item").alias("value"), F.col("e.count").alias("n"))
