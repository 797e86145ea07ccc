"""Incremental enrichment whose memory of done ids is a state store, and whose metrics come from what is committed.

Every id of the stream has one entry in the store, which Spark's own removal of duplicates keeps; texts stay out of
it. A micro-batch looks up and adds only its own ids, so its cost follows its size and not the number of records so
far, which are never read again. Its notes are joined to the ids that are new in it. A run with a new checkpoint
starts from the ids of the records that are there: they go into the store with the first micro-batch, once.

Each micro-batch writes its records to a folder of its own and replaces it when the batch is tried again, and so with its row
of the run log. The counts of that row are taken from stored rows, never from running tasks, so a task that ran
twice counts once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notewright.operators.joins import salted_join
from notewright.session import path_exists, scratch_path, settle
from notewright.streaming.incremental import done_ids

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROW, SEED, FIRST = "row", "seed", "first"
LOG_COLUMNS = (
    "run_tag string, start_ts timestamp, end_ts timestamp, seen bigint, written bigint, skipped bigint, "
    "failed bigint, input_tokens bigint, output_tokens bigint, gen_ms bigint"
)


def with_firsts(notes: DataFrame, seeds: DataFrame | None = None) -> DataFrame:
    """The rows of streaming ``notes (ord, id, note)``, and a row of kind ``FIRST`` for each id that no earlier
    micro-batch had.

    ``seeds (id)`` is a stream of ids that are done; they must all be there in the first micro-batch, and come out
    with it as rows of kind ``SEED``. Only ids reach the store, in a batch's one shuffle by id.
    """
    def bare(ids: DataFrame, kind: str) -> DataFrame:
        return ids.select(
            F.lit(None).cast("bigint").alias("ord"), "id", F.lit(None).cast("string").alias("note"), F.lit(kind).alias("kind")
        )

    rows, ids = notes.select("ord", "id", "note", F.lit(ROW).alias("kind")), notes.select("id")
    if seeds is not None:
        rows, ids = rows.unionByName(bare(seeds, SEED)), ids.unionByName(seeds.select("id"))
    return rows.unionByName(bare(ids.dropDuplicates(["id"]), FIRST))


def fresh_rows(rows: DataFrame) -> DataFrame:
    """The notes of a stored micro-batch whose id neither an earlier one had nor the seeds. Rows that share a new id
    in one micro-batch are all fresh."""
    notes = rows.where(F.col("kind") == ROW).drop("kind")
    new = rows.where(F.col("kind") == FIRST).join(rows.where(F.col("kind") == SEED), "id", "left_anti").select("id")
    return salted_join(notes, new, "id", "left_semi", spread_by="ord")


def stream_seeds(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """The ids that were under ``out`` when the checkpoint was new, as a stream.

    They are copied beside the checkpoint's own files, so that what the run writes is no seed; a run that goes on
    from the checkpoint finds them in the store."""
    path = f"{checkpoint}/seeds"
    if not path_exists(spark, f"{checkpoint}/offsets/0"):
        settle(done_ids(spark, out).distinct(), path)
    return spark.readStream.schema("id string").parquet(path)


def start_stateful(
    notes: DataFrame, make_records: Callable[[DataFrame], DataFrame], out: str, checkpoint: str,
    log: str | None = None, run_tag: str = "all",
) -> StreamingQuery:
    """As :func:`~notewright.streaming.incremental.start_incremental`, with done ids in a state store.

    ``notes`` are ``(ord, id, note)`` and valid. With ``log`` each micro-batch leaves a row of counts there, which
    :func:`read_log` gives to ``operators.metrics.worker_metrics``. Records may have ``extraction_ok``, ``input_tokens``,
    ``output_tokens`` and ``gen_ms`` to be counted.
    """
    spark = notes.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    marked = with_firsts(notes, stream_seeds(spark, out, checkpoint))

    def write_batch(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        begin = dt.datetime.now(dt.timezone.utc)
        place = f"query={session.sparkContext.getLocalProperty('sql.streaming.queryId')}/batch={number}"
        # Stored once: looking at the batch again would run the state again.
        rows = settle(batch, scratch_path(session, "batch"))
        fresh = fresh_rows(rows)
        make_records(fresh).write.mode("overwrite").parquet(f"{out}/{place}")
        if log is not None:
            written = session.read.parquet(f"{out}/{place}")
            row = counted(rows.where(F.col("kind") == ROW), fresh, written, run_tag, begin, dt.datetime.now(dt.timezone.utc))
            row.coalesce(1).write.mode("overwrite").json(f"{log}/{place}")

    return (
        marked.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def counted(
    rows: DataFrame, fresh: DataFrame, written: DataFrame, run_tag: str, begin: dt.datetime, end: dt.datetime,
) -> DataFrame:
    """The row of the run log for one micro-batch."""
    total = lambda name: (
        F.coalesce(F.sum(name), F.lit(0)) if name in written.columns else F.lit(0)
    ).cast("bigint").alias(name)
    failed = F.count_if(~F.col("extraction_ok")) if "extraction_ok" in written.columns else F.lit(0).cast("bigint")
    came = rows.agg(F.count("*").alias("seen")).join(fresh.agg(F.count("*").alias("new"))).select(
        "seen", (F.col("seen") - F.col("new")).alias("skipped")
    )
    went = written.agg(
        F.count("*").alias("written"), failed.alias("failed"), total("input_tokens"), total("output_tokens"), total("gen_ms")
    )
    spark = rows.sparkSession
    stamps = spark.createDataFrame([(run_tag, begin, end)], "run_tag string, start_ts timestamp, end_ts timestamp")
    # One row each.
    return stamps.join(came).join(went).selectExpr(*[part.split()[0] for part in LOG_COLUMNS.split(", ")])


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """One row for each micro-batch that is done."""
    return spark.read.schema(LOG_COLUMNS).option("recursiveFileLookup", "true").json(log)
