"""Reading tables: incremental choice of files, readiness of batches, merged tails."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PING = "internalRouteId string, realRouteNumber string, latitude double, longitude double, speed int, plate string, timestamp long, readableTime string, sourceTimestamp long, sourceReadableTime string"


def read_table(spark: SparkSession, *paths: str, merge: bool = False, recursive: bool = False) -> DataFrame:
    reader = spark.read.option("mergeSchema", merge).option("recursiveFileLookup", recursive)
    return reader.parquet(*paths)


def with_source(df: DataFrame) -> DataFrame:
    return df.withColumns({"source_file": F.col("_metadata.file_path"), "source_modified": F.col("_metadata.file_modification_time")})


def decode_pings(lines: DataFrame, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Pings from JSON lines, and the lines that aren't any."""
    parsed = lines.withColumn("data", F.from_json(column, PING + ", _corrupt_record string", {"columnNameOfCorruptRecord": "_corrupt_record"}))
    good = F.col("data").isNotNull() & F.col("data._corrupt_record").isNull() & F.col("data.timestamp").isNotNull()
    pings = parsed.where(good).select("data.*").drop("_corrupt_record").withColumn("eventTime", F.timestamp_seconds("timestamp"))
    return pings, parsed.where(~F.coalesce(good, F.lit(False))).select(column)


def select_new_files(files: Iterable[tuple[int, str]], mark: tuple[int, str] | None, limit: int | None = None) -> tuple[list[tuple[int, str]], tuple[int, str] | None]:
    """Files (modified, path) behind the mark, in order, and the new mark."""
    new = sorted(f for f in files if mark is None or f > mark)[:limit]
    return new, new[-1] if new else mark


def batch_ready(files: list[tuple[int, int]], now: int, min_files: int = 100, min_bytes: int = 64 << 20, max_age_s: int = 3600, small_tail: bool = False) -> bool:
    """Whether files (modified, bytes) are many, large or old enough to be compacted."""
    return bool(files) and (len(files) >= min_files or sum(b for _, b in files) >= min_bytes or now - min(m for m, _ in files) >= max_age_s or small_tail)


def with_tail(compacted: DataFrame, raw: DataFrame, handled: DataFrame, keys: list[str], file: str = "source_file") -> DataFrame:
    """Compacted rows and those of raw files that no compaction has handled yet, one row for each key.

    raw: with its file's name (with_source); handled: file names.  Going by files keeps late rows; keys drop what is in both.
    """
    tail = raw.join(handled.select(F.col(handled.columns[0]).alias(file)), file, "left_anti").drop(file)
    return compacted.unionByName(tail, allowMissingColumns=True).dropDuplicates(keys)


def from_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A table of a few rows that the driver holds."""
    return spark.createDataFrame(rows, schema)


def write_days(df: DataFrame, path: str, day: str = "service_date", files: int = 8) -> None:
    """Replaces the days that occur; a busy day is spread over several files."""
    spread = df.repartition(day, F.pmod(F.xxhash64(*df.columns), F.lit(files)))
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(day).parquet(path)


def reopened(history: DataFrame, new: DataFrame, day: str = "service_date") -> DataFrame:
    """The rows of history whose day occurs among new rows: those days are computed again from all of their rows."""
    return history.join(new.select(day).distinct(), day, "left_semi")
