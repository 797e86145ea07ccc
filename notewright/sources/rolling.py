"""Shards of an exact number of records with names that count on, committed together with the ids they hold.

Records are numbered in order: dealt out by ranges, counted there, and only the counts meet in one place. So every shard
but the last of a run has exactly ``shard_size`` records, however many tasks there are, and is written by one task.

A task writes its shards to a staging folder of the run under names of its own attempt, and tells their names when it ends.
The driver then writes one log entry for the run, by a rename; from there on the run counts as done. After that the
files get their names. If the driver is lost before the entry, nothing of the run is seen; if it is lost after it,
:func:`recover`, which every reader and writer calls first, moves what is left. A failed task's files are never named.

``path`` is any address that both Spark and Arrow's file systems know.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from notewright.operators.resume import clean_ids
from notewright.session import path_exists, scratch_path, settle, shuffle_partitions
from notewright.sources.shards import SHARD_SIZE

# The sink runs in processes that may not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

IDS, LOG, STAGING = "_ids", "_log", "_staging"
ROWS_PER_TASK = 1 << 33


def _at(path: str) -> tuple[arrow_fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return arrow_fs.LocalFileSystem(), path.rstrip("/")
    found, root = arrow_fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
    return found, root.rstrip("/")


def _names(fs: arrow_fs.FileSystem, folder: str) -> list[str]:
    found = fs.get_file_info(arrow_fs.FileSelector(folder, allow_not_found=True))
    return sorted(info.base_name for info in found if info.is_file)


@dataclass
class Written(WriterCommitMessage):
    """What one task has staged: ``(staged name, final name)`` of data and ids."""

    moves: list[tuple[str, str]] = field(default_factory=list)


class ShardWriter(DataSourceArrowWriter):
    """Takes rows ``(shard, id, line)`` that come shard by shard."""

    def __init__(self, path: str, prefix: str, run: str) -> None:
        self.path, self.prefix, self.run = path, prefix, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _at(self.path)
        stage = f"{STAGING}/{self.run}"
        fs.create_dir(f"{root}/{stage}")
        done, now, streams = Written(), None, []
        try:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("shard", "id", "line")]
                for shard, ident, line in zip(*columns):
                    if shard != now:
                        for stream in streams:
                            stream.close()
                        name, attempt, now = f"{self.prefix}_{shard:05d}", uuid.uuid4().hex, shard
                        moves = [(f"{stage}/{name}.{attempt}.jsonl", f"{name}.jsonl"),
                                 (f"{stage}/{name}.{attempt}.ids", f"{IDS}/{name}.ids")]
                        done.moves += moves
                        streams = [fs.open_output_stream(f"{root}/{staged}") for staged, _ in moves]
                    streams[0].write(line.encode() + b"\n")
                    if ident is not None:
                        streams[1].write(ident.encode() + b"\n")
            for stream in streams:
                stream.close()
        except BaseException:
            for staged, _ in done.moves:
                if fs.get_file_info(f"{root}/{staged}").is_file:
                    fs.delete_file(f"{root}/{staged}")
            raise
        return done

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _at(self.path)
        moves = [move for message in messages if message is not None for move in message.moves]
        for folder in (LOG, IDS, f"{STAGING}/{self.run}"):
            fs.create_dir(f"{root}/{folder}")
        entry = f"{STAGING}/{self.run}/entry.json"
        with fs.open_output_stream(f"{root}/{entry}") as stream:
            stream.write(json.dumps({"moves": moves}).encode())
        fs.move(f"{root}/{entry}", f"{root}/{LOG}/{self.run}.json")
        _settle_run(fs, root, self.run, moves)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _at(self.path)
        if fs.get_file_info(f"{root}/{STAGING}/{self.run}").type != arrow_fs.FileType.NotFound:
            fs.delete_dir(f"{root}/{STAGING}/{self.run}")


def _settle_run(fs: arrow_fs.FileSystem, root: str, run: str, moves: list) -> None:
    """Give the files of a run that counts as done their names, as far as they lack them."""
    stage = f"{root}/{STAGING}/{run}"
    if fs.get_file_info(stage).type == arrow_fs.FileType.NotFound:
        return

    def move(pair: tuple[str, str]) -> None:
        if fs.get_file_info(f"{root}/{pair[0]}").is_file:
            fs.move(f"{root}/{pair[0]}", f"{root}/{pair[1]}")

    with ThreadPoolExecutor(16) as pool:
        list(pool.map(move, moves))
    fs.delete_dir(stage)  # with what failed tasks left


def recover(path: str) -> None:
    """Finish runs that are logged and whose files were not all named."""
    fs, root = _at(path)
    staged = fs.get_file_info(arrow_fs.FileSelector(f"{root}/{STAGING}", allow_not_found=True))
    logged = set(_names(fs, f"{root}/{LOG}")) if staged else set()
    for run in (info.base_name for info in staged):
        if f"{run}.json" in logged:
            with fs.open_input_stream(f"{root}/{LOG}/{run}.json") as stream:
                _settle_run(fs, root, run, json.loads(stream.read())["moves"])


def next_shard(path: str, prefix: str) -> int:
    """One more than the last shard of this prefix, 0 where there is none."""
    fs, root = _at(path)
    pattern = re.compile(re.escape(prefix) + r"_(\d+)\.jsonl")
    found = [int(m[1]) for m in map(pattern.fullmatch, _names(fs, root)) if m]
    return max(found, default=-1) + 1


class RolledShards(DataSource):
    """The sink ``rolled_shards``; options are the path, the prefix and the name of the run."""

    @classmethod
    def name(cls) -> str:
        return "rolled_shards"

    def schema(self) -> str:
        return "shard int, id string, line string"

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options["path"], self.options["prefix"], self.options["run"])


def numbered(records: DataFrame, order: str) -> tuple[DataFrame, int]:
    """``records`` with ``_place``, their place in the order of a column from 0 on, and how many there are.

    They are on shared storage, so the places hold."""
    spark = records.sparkSession
    parts = records.repartitionByRange(shuffle_partitions(spark), order).sortWithinPartitions(order)
    rows = settle(parts.select(
        "*", F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(ROWS_PER_TASK - 1)).alias("_row"),
    ), scratch_path(spark, "numbered"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))  # one a shuffle partition
    total = counts.agg(F.sum("_n")).first()[0] or 0
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = rows.join(F.broadcast(starts), "_part").withColumn("_place", F.col("_start") + F.col("_row"))
    return placed.drop("_part", "_row", "_start"), total


def write_rolled(
    records: DataFrame, path: str, prefix: str, order: str, line: Column | None = None, shard_size: int = SHARD_SIZE,
) -> int:
    """Append ``records`` as shards ``<prefix>_00000.jsonl`` and on, in the order of a unique column; returns how many.

    ``line`` is the JSON of a record, by default of all its columns with nulls spelled out. The ids go to ``_ids`` under
    the same names. One run at a time may write a prefix; workers have one each.
    """
    spark = records.sparkSession
    recover(path)
    if line is None:
        line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in records.columns]), {"ignoreNullFields": "false"})
    lines = records.select(F.col(order).alias("order"), F.col("id").cast("string").alias("id"), line.alias("line"))
    placed, total = numbered(lines, "order")
    shards = -(-total // shard_size)
    if not shards:
        return 0
    shard = F.floor(F.col("_place") / F.lit(shard_size)).cast("int")
    dealt = placed.withColumn("shard", shard).repartitionById(shards, F.col("shard")).sortWithinPartitions("_place")
    first = next_shard(path, prefix)
    spark.dataSource.register(RolledShards)
    dealt.select((F.col("shard") + F.lit(first)).cast("int").alias("shard"), "id", "line").write.format(
        "rolled_shards"
    ).options(path=path, prefix=prefix, run=uuid.uuid4().hex).mode("append").save()
    return shards


def read_rolled_ids(spark: SparkSession, path: str) -> DataFrame:
    """``(id)`` of all records under ``path``, each once, without opening the records."""
    recover(path)
    if not path_exists(spark, f"{path}/{IDS}"):
        return spark.createDataFrame([], "id string")
    return clean_ids(spark.read.text(f"{path}/{IDS}"), "value")
