"""Live traces: the last points of each vehicle, kept as state of a stream."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TRACE = "plate string, lats array<double>, lons array<double>, times array<long>, expired boolean"
_STATE = "lats array<double>, lons array<double>, times array<long>"


def last_points(points: pd.DataFrame, most: int, minutes: int) -> pd.DataFrame:
    """Points (t in microseconds, lat, lon) in order of time, each once, of the last minutes before the newest, `most` at most.  What it gives
    doesn't depend on how points were split into earlier calls."""
    points = points.drop_duplicates(["t", "lat", "lon"]).sort_values(["t", "lat", "lon"], kind="stable")
    return points[points["t"] >= points["t"].max() - minutes * 60_000_000].tail(most)


def live_traces(pings: DataFrame, most: int = 100, minutes: int = 10, late: str = "10 minutes") -> DataFrame:
    """A row for each vehicle that a batch has changed: its last points, or none (expired) once the watermark is `minutes` past the newest.

    pings: plate, eventTime, latitude, longitude.  State holds `most` points a vehicle and goes when it expires.
    """

    def step(key, frames, state: GroupState):
        none = pd.DataFrame({"plate": [key[0]], "lats": [[]], "lons": [[]], "times": [[]], "expired": [True]})
        if state.hasTimedOut:
            state.remove()
            yield none
            return
        held = pd.DataFrame(dict(zip(("lat", "lon", "t"), map(list, state.get), strict=True)) if state.exists else {"lat": [], "lon": [], "t": []})
        for frame in frames:
            held = last_points(pd.concat([held, frame[["lat", "lon", "t"]]]), most, minutes)
        until = (int(held["t"].iloc[-1]) + minutes * 60_000_000) // 1000
        if until <= state.getCurrentWatermarkMs():
            if state.exists:
                state.remove()
            yield none
            return
        lats, lons, times = held["lat"].tolist(), held["lon"].tolist(), held["t"].astype("int64").tolist()
        state.update((lats, lons, times))
        state.setTimeoutTimestamp(until)
        yield pd.DataFrame({"plate": [key[0]], "lats": [lats], "lons": [lons], "times": [times], "expired": [False]})

    rows = pings.where("plate is not null and eventTime is not null and latitude is not null and longitude is not null")
    rows = rows.select(F.trim("plate").alias("plate"), "eventTime", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"), F.unix_micros("eventTime").alias("t")).where("plate <> ''")
    return rows.withWatermark("eventTime", late).groupBy("plate").applyInPandasWithState(step, TRACE, _STATE, "update", GroupStateTimeout.EventTimeTimeout)


def start_traces(pings: DataFrame, out: str, checkpoint: str, once: bool = False, **how) -> StreamingQuery:
    """Writes what each batch has changed to a folder of its own, so a batch that is run again leaves no second copy."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = live_traces(pings, **how).writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 second")).start()


def latest_traces(spark: SparkSession, out: str) -> DataFrame:
    """Each vehicle's last trace, without expired ones."""
    rows = spark.read.schema(f"{TRACE}, batch long").parquet(out)
    last = rows.groupBy("plate").agg(F.max_by(F.struct("lats", "lons", "times", "expired"), "batch").alias("b"))
    return last.select("plate", "b.*").where("not expired").drop("expired")
