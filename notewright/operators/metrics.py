"""Run metrics: one row per worker, and the merged row of all workers.

A log has one row per batch: ``run_tag, start_ts, end_ts, seen, written, skipped, failed, input_tokens,
output_tokens, gen_ms``. A row that stands for several batches says how many in a column ``batches``. All
of it adds up, so the aggregates are partial sums whatever the batch size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from notewright.functions.rates import rate, seconds_between


def _total(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def _with_token_rates(df: DataFrame, notes: str) -> DataFrame:
    c = F.col
    tokens = c("input_tokens") + c("output_tokens")
    return df.select(
        "*",
        tokens.alias("total_tokens"),
        rate(c("input_tokens"), c("gen_time_s")).alias("input_toks_per_s"),
        rate(c("output_tokens"), c("gen_time_s")).alias("output_toks_per_s"),
        rate(tokens, c("gen_time_s")).alias("total_toks_per_s"),
        rate(c("input_tokens"), c(notes)).alias("avg_input_toks_per_note"),
        rate(c("output_tokens"), c(notes)).alias("avg_output_toks_per_note"),
    )


def worker_metrics(log: DataFrame) -> DataFrame:
    """One row per ``run_tag``.

    ``notes_seen`` counts notes before the shard and resume filters, and the rate and the averages are
    per note seen. ``notes_written`` includes the failed ones.
    """
    sums = log.groupBy("run_tag").agg(
        F.min("start_ts").alias("start_time"),
        F.max("end_ts").alias("end_time"),
        (_total("gen_ms") / F.lit(1000.0)).alias("gen_time_s"),
        _total("seen").alias("notes_seen"),
        _total("written").alias("notes_written"),
        _total("skipped").alias("notes_skipped"),
        _total("failed").alias("notes_failed"),
        _total("input_tokens").alias("input_tokens"),
        _total("output_tokens").alias("output_tokens"),
    )
    span = seconds_between(F.col("start_time"), F.col("end_time"))
    timed = sums.withColumn("duration_s", span)
    timed = timed.withColumn("notes_per_s", rate(F.col("notes_seen"), F.col("duration_s")))
    return _with_token_rates(timed, "notes_seen")


def bench_metrics(log: DataFrame) -> DataFrame:
    """One row per ``run_tag``: as for a worker, but with batches, and per note of the own shard."""
    sums = log.groupBy("run_tag").agg(
        F.min("start_ts").alias("start_time"),
        F.max("end_ts").alias("end_time"),
        (_total("gen_ms") / F.lit(1000.0)).alias("gen_time_s"),
        _total("written").alias("notes"),
        (_total("batches") if "batches" in log.columns else F.count("*")).alias("batches"),
        _total("input_tokens").alias("input_tokens"),
        _total("output_tokens").alias("output_tokens"),
    )
    span = seconds_between(F.col("start_time"), F.col("end_time"))
    timed = sums.withColumn("total_time_s", span)
    timed = timed.withColumn("notes_per_s", rate(F.col("notes"), F.col("total_time_s")))
    return _with_token_rates(timed, "notes")


def _merged_rates(df: DataFrame, notes: str) -> DataFrame:
    """Notes and all tokens per second of wall time; input and output tokens per generation second."""
    c = F.col
    tokens = c("input_tokens") + c("output_tokens")
    return df.select(
        "*",
        tokens.alias("total_tokens"),
        _rate_any(c(notes), c("wall_time_s")).alias("notes_per_s"),
        _rate_any(tokens, c("wall_time_s")).alias("total_toks_per_s"),
        _rate_any(c("input_tokens"), c("gen_time_s")).alias("input_toks_per_s"),
        _rate_any(c("output_tokens"), c("gen_time_s")).alias("output_toks_per_s"),
    )


def _rate_any(num: Column, den: Column) -> Column:
    """As :func:`rate`, but only a missing or zero divisor counts as nothing."""
    return F.when(den != 0, num.cast("double") / den).otherwise(F.lit(0.0))


def replica_metrics(workers: DataFrame) -> DataFrame:
    """One row for all workers; the wall time is null where no worker has both stamps."""
    sums = workers.agg(
        F.count("*").alias("replicas"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.coalesce(F.sum("gen_time_s"), F.lit(0.0)).alias("gen_time_s"),
        _total("notes_written").alias("notes_written"),
        _total("input_tokens").alias("input_tokens"),
        _total("output_tokens").alias("output_tokens"),
    )
    span = seconds_between(F.col("start_time"), F.col("end_time"))
    return _merged_rates(sums.withColumn("wall_time_s", span), "notes_written")


def bench_replica_metrics(workers: DataFrame) -> DataFrame:
    """One row for all bench workers; without stamps the longest worker stands for the wall time."""
    sums = workers.agg(
        F.count("*").alias("replicas"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.max("total_time_s").alias("_longest"),
        F.coalesce(F.sum("gen_time_s"), F.lit(0.0)).alias("gen_time_s"),
        _total("notes").alias("notes"),
        _total("batches").alias("batches"),
        _total("input_tokens").alias("input_tokens"),
        _total("output_tokens").alias("output_tokens"),
    )
    span = seconds_between(F.col("start_time"), F.col("end_time"))
    wall = F.coalesce(span, F.col("_longest"), F.lit(0.0))
    return _merged_rates(sums.withColumn("wall_time_s", wall).drop("_longest"), "notes")
