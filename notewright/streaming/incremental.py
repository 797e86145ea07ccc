"""Incremental enrichment: take up note files that are new, leave out ids that are done, append records.

The records are the only memory of what is done. Each micro-batch writes a folder of its own, named after
the query and the batch, and replaces it when the batch is tried again; so a batch that failed half way,
or whose executors were lost, leaves nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from notewright.operators.resume import without_done
from notewright.session import path_exists


def done_ids(
    spark: SparkSession, out: str, query: str | None = None, batch: int | None = None
) -> DataFrame:
    """``(id)`` of all records under ``out``, except those of the batch that is being written."""
    if not path_exists(spark, out):
        return spark.createDataFrame([], "id string")
    # The schema is given, so that no file is opened for it and a folder without any is no error.
    stored = spark.read.schema("id string, query string, batch bigint").parquet(out)
    if query is not None:
        own = (F.col("query") == query) & (F.col("batch") == batch)
        stored = stored.where(~own)
    return stored.select("id").where(F.col("id").isNotNull())


def start_incremental(
    notes: DataFrame, make_records: Callable[[DataFrame], DataFrame], out: str, checkpoint: str
) -> StreamingQuery:
    """Start a run over the streaming ``notes`` that ends when all files there now are done.

    ``make_records`` turns a batch of new notes into records with an ``id``. Records go to Parquet, where
    the ids can be read without the rest. A second run with another checkpoint sees all files again and
    writes only what is not in ``out`` yet. Notes that share a new id in one batch are all written.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        fresh = without_done(batch, done_ids(spark, out, query, number))
        folder = f"{out}/query={query}/batch={number}"
        make_records(fresh).write.mode("overwrite").parquet(folder)

    return (
        notes.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
