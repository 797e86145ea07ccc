"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that change results. They are runtime settings, so they can be put on any session.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in a reply keeps its last value instead of making the reply unreadable.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings that only change the plan.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Many folders are listed by this many tasks at most, and not by up to 10,000 of a folder each.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


def configure(spark: SparkSession) -> SparkSession:
    """Put the engine's settings on a session that somebody else started."""
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A one-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("notewright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**RESULT_SETTINGS, **PLAN_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="notewright-"))
    return configure(spark)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder that all executors share.

    The folder is ``spark.checkpoint.dir``; :func:`local_session` sets it where it is unset.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{base.rstrip('/')}/notewright/{label}-{uuid.uuid4().hex}"


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write a table to shared storage and go on from there: it is computed once, and what comes after
    does not depend on the executors that computed it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at ``path``, on whatever file system that names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what is in it, if it exists."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
