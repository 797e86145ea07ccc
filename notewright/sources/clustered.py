"""Records clustered by the hash of their id, so that runs that resume never shuffle them.

A clustered table is Parquet in a fixed number of buckets, registered with the session's catalog. Its files carry their
bucket in their names, so any session can register the folder again. Notes that are clustered alike meet the ids
bucket by bucket; other notes are dealt to the same buckets first. Either way the records stay where they are and
only their ids are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from notewright.session import path_exists


def register_clustered(spark: SparkSession, table: str, path: str, ddl: str, buckets: int) -> None:
    """Make a folder, empty or written before with these columns and buckets, known as a table."""
    if not spark.catalog.tableExists(table):
        place = path.replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({ddl}) USING parquet CLUSTERED BY (id) SORTED BY (id) "
                  f"INTO {buckets} BUCKETS LOCATION '{place}'")


def append_clustered(rows: DataFrame, table: str, path: str, buckets: int) -> None:
    """Append ``rows`` with an ``id``; each task writes one file of one bucket."""
    spark = rows.sparkSession
    known = path_exists(spark, path)
    if known:
        register_clustered(spark, table, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), buckets)
    dealt = rows.repartition(buckets, "id").write.bucketBy(buckets, "id").sortBy("id").format("parquet")
    if known:
        dealt.mode("append").saveAsTable(table)
    else:
        dealt.mode("error").option("path", path).saveAsTable(table)


def without_done_clustered(notes: DataFrame, table: str) -> DataFrame:
    """Notes whose id is not in a clustered table. The table is joined where it lies.

    An id that many rows share lies in one bucket; where that is a burden, use ``operators.resume.without_done``."""
    done = notes.sparkSession.table(table).select("id")
    # A merge join, as only its sides may keep their buckets; a broadcast would gather the ids in one place.
    return notes.join(done.hint("merge"), "id", "left_anti").select(*notes.columns)
