"""From pings to stop visits: spatial join, sessions, visits, dwell, direction checks, last passes."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, when

#: Stops are a city's; above this many rows the join is left to a shuffle.
BROADCAST_ROWS = 200_000


def _few(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def served(df: DataFrame) -> DataFrame:
    """A table of stops or the like for a join: sent to all tasks where it is a city's."""
    return F.broadcast(df) if _few(df, BROADCAST_ROWS) else df


def dedup_pings(pings: DataFrame, keys: list[str], least: list[str] = (), most: list[str] = ()) -> DataFrame:
    """One row for each identity, with the least or greatest of other columns (partial aggregation before the shuffle)."""
    return pings.groupBy(*keys).agg(*(F.min(c).alias(c) for c in least), *(F.max(c).alias(c) for c in most))


def geo_join(points: DataFrame, stops: DataFrame, radius_m: float = 50.0, on: tuple[str, ...] = (), small: bool | None = None) -> DataFrame:
    """points x stops within radius_m, as an equi-join on grid cells.

    A stop goes into the cells around it; as a degree of longitude shrinks by cos(latitude), it goes into more cells to the
    sides the further north or south it lies (near a pole into those of every longitude).  Of a table too large to be sent to all tasks, the spots are,
    if there are few: points stay where they are, and only those near a spot meet the stops there.
    """
    if small is None and not (small := _few(stops, BROADCAST_ROWS)):
        spot = [*on, "stop_lat", "stop_lon"]
        spots = stops.select(*spot).distinct()
        if _few(spots, BROADCAST_ROWS):
            # A stop by its spot is one row, in the cells around it fifteen or more.
            members = F.broadcast(stops) if _few(stops, 15 * BROADCAST_ROWS) else stops
            return geo_join(points, spots, radius_m, on, small=True).join(members, spot)
    size = radius_m
    north = F.least(F.lit(90.0), F.abs("stop_lat") + radius_m / geo.DEGREE_M)
    most = math.ceil(360 * geo.DEGREE_M / size)
    wide = F.least(F.lit(float(most)), F.ceil(F.lit(1.01) / F.greatest(F.cos(F.radians(north)), F.lit(1e-9)))).cast("int")
    around = stops.withColumn("__a", F.explode(F.sequence(F.lit(-1), F.lit(1)))).withColumn("__b", F.explode(F.sequence(-wide, wide)))
    around = around.withColumns({"__i": geo.cell(F.col("stop_lat"), size) + F.col("__a"), "__j": geo.cell(F.col("stop_lon"), size) + F.col("__b")}).drop("__a", "__b")
    placed = points.withColumns({"__i": geo.cell(F.col("lat"), size), "__j": geo.cell(F.col("lon"), size)})
    joined = placed.join(F.broadcast(around) if small else around, [*on, "__i", "__j"])
    distance = geo.haversine_m(F.col("lat"), F.col("lon"), F.col("stop_lat"), F.col("stop_lon"))
    near = F.abs(F.col("lat") - F.col("stop_lat")) <= radius_m / geo.DEGREE_M * 1.01
    return joined.where(near).withColumn("distance_m", distance).where(F.col("distance_m") <= radius_m).drop("__i", "__j")


def sessionize(df: DataFrame, keys: list[str], ts: str, gap_s: int = 180, name: str = "session") -> DataFrame:
    """Numbers the runs of rows whose gaps are gap_s at most."""
    w = Window.partitionBy(*keys).orderBy(ts)
    gap = F.unix_timestamp(ts) - F.unix_timestamp(F.lag(ts).over(w))
    new = F.when(gap.isNull() | (gap > gap_s), 1).otherwise(0)
    return df.withColumn("__new", new).withColumn(name, F.sum("__new").over(w).cast("long")).drop("__new")


def visits_manual(df: DataFrame, keys: list[str], ts: str, gap_s: int = 180) -> DataFrame:
    return sessionize(df, keys, ts, gap_s).groupBy(*keys, "session").agg(F.min(ts).alias("entered_at"), F.max(ts).alias("exited_at"), F.count("*").alias("points")).drop("session")


def visits_builtin(df: DataFrame, keys: list[str], ts: str, gap_s: int = 180) -> DataFrame:
    """The same by session_window, which also runs on streams with a watermark."""
    found = df.groupBy(*keys, F.session_window(ts, f"{gap_s} seconds").alias("w")).agg(F.min(ts).alias("entered_at"), F.max(ts).alias("exited_at"), F.count("*").alias("points"))
    return found.drop("w")


def ambiguous(visits: DataFrame, keys: list[str], direction: str = "direction") -> DataFrame:
    """Keys that occur with more than one direction."""
    return visits.groupBy(*keys).agg(F.countDistinct(direction).alias("directions")).where("directions > 1")


def direction_safe(visits: DataFrame, keys: list[str], terminal: str = "is_terminal", direction: str = "direction") -> DataFrame:
    """Visits of unambiguous direction, and ambiguous ones at terminals.  A window tells them, so that visits which lie together by keys are not moved."""
    by = Window.partitionBy(*keys)
    odd = F.min(direction).over(by) < F.max(direction).over(by)
    # A visit whose keys aren't all known is like no other.
    known = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in keys))
    return visits.withColumn("__odd", F.coalesce(known & odd, F.lit(False))).where(~F.col("__odd") | F.col(terminal)).drop("__odd")


def dwell_dedup(visits: DataFrame, keys: list[str]) -> DataFrame:
    """One row for each visit: away from terminals first, then the least stop order."""
    w = Window.partitionBy(*keys).orderBy(F.col("is_terminal").asc(), F.col("stop_order").asc())
    return visits.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def last_pass(visits: DataFrame, grain: list[str], tz: str = "UTC") -> DataFrame:
    """The last exit of each day and grain, with the visit that made it."""
    day = when.service_date(F.col("exited_at"), tz)
    best = F.max(F.struct("exited_at", "plate", "entered_at"))
    found = visits.groupBy(day.alias("service_date"), *grain).agg(best.alias("b"))
    return found.select("service_date", *grain, F.col("b.exited_at").alias("last_pass_at"), F.col("b.plate").alias("plate"))
