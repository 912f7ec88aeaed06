"""Streams of pings: reading, de-duplication with a watermark, windows, and idempotent publishing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import when
from ..sources import publish
from ..sources.files import decode_pings

INGEST_KEY = ["internalRouteId", "realRouteNumber", "plate", "eventTime", "latitude", "longitude"]


def read_lines(spark: SparkSession, path: str, max_files: int = 64) -> DataFrame:
    return spark.readStream.format("text").option("maxFilesPerTrigger", max_files).load(path)


def read_socket(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines of a socket; it can't be read again after a failure, so it is for trials."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def deduplicated(pings: DataFrame, keys: list[str] = INGEST_KEY, late: str = "10 minutes") -> DataFrame:
    """For views of the last minutes only: rows behind the watermark are dropped, so nothing that is stored goes through here."""
    return pings.withWatermark("eventTime", late).dropDuplicatesWithinWatermark(keys)


def counts(pings: DataFrame, every: str = "5 minutes", late: str = "10 minutes", slide: str | None = None) -> DataFrame:
    """Pings in tumbling windows, or in sliding ones that start every `slide`."""
    window = F.window("eventTime", every, slide) if slide else F.window("eventTime", every)
    return pings.withWatermark("eventTime", late).groupBy(window.alias("w")).count().select(F.col("w.start").alias("start"), "count")


def sessions(pings: DataFrame, gap: str = "180 seconds", late: str = "10 minutes") -> DataFrame:
    """Visits of vehicles as session windows with state; a visit is given out once the watermark has passed it."""
    found = pings.withWatermark("eventTime", late).groupBy("plate", F.session_window("eventTime", gap).alias("w"))
    return found.agg(F.count("*").alias("points"), F.max("speed").alias("most")).select("plate", F.col("w.start").alias("entered_at"), "points", "most")


def start(lines: DataFrame, out: str, checkpoint: str, once: bool = False, bad: str | None = None, tz: str = "Europe/Moscow") -> StreamingQuery:
    """Publishes pings by batch (sources.publish): each batch exactly once, each key once in it, and rows of any age.  A late row's day stands in
    the manifest, so refresh_days computes that day again; what comes again in a later batch is left out there and in `published`.  Lines
    that are no pings go to `bad`, a folder for each batch."""
    pings, broken = decode_pings(lines)
    store = publish.Store(lines.sparkSession, out)

    def take(batch: DataFrame, number: int) -> None:
        rows = batch.dropDuplicates(INGEST_KEY).withColumn("service_date", when.service_date(F.col("eventTime"), tz))
        publish.put(store, rows, number)

    def put_aside(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").text(f"{bad}/batch={number}")

    def begin(df: DataFrame, each, at: str) -> StreamingQuery:
        writer = df.writeStream.foreachBatch(each).option("checkpointLocation", at)
        return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="5 seconds")).start()

    if bad:
        aside = begin(broken, put_aside, f"{checkpoint}-bad")
        if once:
            aside.awaitTermination()
    return begin(pings, take, checkpoint)


def published(spark: SparkSession, out: str, days: list[str] | None = None) -> DataFrame:
    """All published pings, one for each key."""
    return publish.published(publish.Store(spark, out), days=days).drop("batch").dropDuplicates(INGEST_KEY)


def ingest(spark: SparkSession, spool: str, out: str, checkpoint: str, once: bool = True, bad: str | None = None) -> StreamingQuery:
    return start(read_lines(spark, spool), out, checkpoint, once, bad)
