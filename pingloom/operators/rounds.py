"""Iterative operators' work tables: written to the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def work_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a temporary folder only where that is unset and the master is this machine."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="pingloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Bytes of files that a task of a join takes in; sorted in memory they are some tens of times as many.
TASK_BYTES = 8 << 20


def file_parts(spark: SparkSession, *paths: str) -> int | None:
    """How many tasks the files of some paths are for, by TASK_BYTES; None where the session's shuffle partitions will do, as Spark joins them to no fewer
    than there are cores."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    found = [hadoop(p) for p in paths]
    total = sum(p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength() for p in found)
    parts = -(-total // TASK_BYTES)
    return parts if parts > min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism) else None


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written and read again: its lineage ends there, and a lost executor costs nothing."""
    path = f"{work_dir(df.sparkSession)}/movement/{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_by(df: DataFrame, name: str, keys: list[str], parts: int | None = None) -> DataFrame:
    """df, written in buckets of its keys: joins on them, however many, read it without a shuffle of this side."""
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    df.repartition(parts, *keys).write.bucketBy(parts, *keys).sortBy(*keys).option("path", f"{work_dir(spark)}/movement/{table}").saveAsTable(table)
    return spark.table(table)


_KNOWN: dict[tuple, str] = {}


def once(spark: SparkSession, key: tuple, make, day: str = "service_date") -> DataFrame:
    """A table that many reads share: written when it is first asked for, and again if the folder has gone.  Each task writes its rows in the order of
    days, so that a read of some days skips the other pages of its file, and no shuffle gathers days that tasks would have to be split for again."""
    key = (spark.sparkContext.applicationId, work_dir(spark), *key)
    path = spark._jvm.org.apache.hadoop.fs.Path(_KNOWN.get(key, "/nowhere"))
    if key not in _KNOWN or not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        _KNOWN[key] = f"{work_dir(spark)}/movement/{uuid.uuid4().hex}/{key[-1]}"
        make().sortWithinPartitions(day).write.parquet(_KNOWN[key])
    return spark.read.parquet(_KNOWN[key])
