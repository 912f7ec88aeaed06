"""The core chain: pings near stops, stop visits, trips between neighbouring stops, overtakes of one day."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, when
from . import trips
from .rollup import rounded
from .visits import direction_safe, dwell_dedup, geo_join, served

VISIT = ["service_date", "plate", "route", "stop_id", "direction"]


def route_context(route_stops: DataFrame, keys: tuple[str, ...] = ("route", "direction")) -> DataFrame:
    """Adds the least and greatest stop order of each route and direction, and whether a stop is a terminal."""
    ends = Window.partitionBy(*keys)
    found = route_stops.withColumns({"min_order": F.min("stop_order").over(ends), "max_order": F.max("stop_order").over(ends)})
    return found.withColumn("is_terminal", F.col("stop_order").isin(F.col("min_order"), F.col("max_order")))


def stop_visits(pings: DataFrame, route_stops: DataFrame, radius_m: float = 50.0, gap_s: int = 180, tz: str = "Europe/Moscow") -> DataFrame:
    """Visits of a day, vehicle, route, stop and direction: runs of pings within the radius whose gaps are gap_s at most.

    pings: plate, route, event_time, lat, lon; route_stops: route, stop_id, direction, stop_lat, stop_lon.  Distances are
    whole metres.  A run's first ping starts it, so one window does for the whole chain; pings that lie by vehicle (plate, route) are not moved.
    """
    stop = ["stop_id", "direction"]
    placed = route_stops.select("route", *stop, "stop_lat", "stop_lon").withColumns({"__spot": F.struct(*stop), "__n": F.count("*").over(Window.partitionBy("route", *stop))})
    # Stops at one spot have the same visits, which are found once; only a stop with several places keeps its own.
    spot = ["route", "stop_lat", "stop_lon"]
    alone = placed.where("__n = 1")
    spots = alone.groupBy(*spot).agg(F.min("__spot").alias("__spot"))
    own = placed.where("__n > 1")
    members = alone.drop("__spot").join(spots, spot).select("route", "__spot", *stop).unionByName(own.select("route", "__spot", *stop).distinct())
    near = geo_join(pings, spots.unionByName(own.select(*spot, "__spot")), radius_m, on=("route",))
    near = near.withColumn("service_date", when.service_date(F.col("event_time"), tz))
    run = ["service_date", "plate", "route", "__spot"]
    order = Window.partitionBy(*run).orderBy("event_time")
    gap = F.unix_timestamp("event_time") - F.unix_timestamp(F.lag("event_time").over(order))
    runs = near.withColumn("__new", F.when(gap <= gap_s, 0).otherwise(1)).withColumn("__run", F.sum("__new").over(order))
    metres = rounded(F.col("distance_m")).cast("long")
    found = runs.groupBy(*run, "__run").agg(
        F.min("event_time").alias("entered_at"),
        F.max("event_time").alias("exited_at"),
        F.count("*").alias("points"),
        F.min(metres).alias("least_m"),
        F.max(metres).alias("most_m"),
    )
    return found.join(served(members), ["route", "__spot"]).select(*VISIT, "entered_at", "exited_at", "points", "least_m", "most_m")


def neighbour_trips(visits: DataFrame, context: DataFrame, max_gap_s: int = 900) -> DataFrame:
    """Trips from each visit to the earliest later visit at the next stop of the same day, vehicle, route and direction.  Visits that lie by vehicle are not moved."""
    static = context.select("route", "direction", "stop_id", "stop_order", "is_terminal")
    rows = visits.join(served(static), ["route", "direction", "stop_id"])
    keys = ["service_date", "plate", "route", "direction"]
    # As of each exit the first entry behind it: both in one order of time, back from the last.  An exit asks for its stop's order, an entry is there for the order before.
    end = F.struct(F.col("entered_at").alias("end_at"), F.col("stop_id").alias("to_stop"))
    ask = F.struct(F.col("stop_order").alias("o"), F.col("exited_at").alias("t"), F.lit(1).alias("ask"), F.col("stop_id").alias("from_stop"), F.lit(None).cast(rows.select(end.alias("e")).schema["e"].dataType).alias("end"))
    there = F.struct((F.col("stop_order") - 1).alias("o"), F.col("entered_at").alias("t"), F.lit(0).alias("ask"), F.lit(None).cast(rows.schema["stop_id"].dataType).alias("from_stop"), end.alias("end"))
    both = rows.select(*keys, F.inline(F.array(ask, there)))
    behind = Window.partitionBy(*keys, "o").orderBy(F.desc("t"), F.desc("ask")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seconds = F.unix_timestamp("end.end_at") - F.unix_timestamp("start_at")
    first = both.withColumn("end", F.min("end").over(behind)).where("ask = 1 and end is not null").withColumnRenamed("t", "start_at").where(seconds <= max_gap_s)
    # A stop can have several visits with one exit, and several places on a route.
    found = first.select(*keys, "o", "from_stop", "start_at", "end").distinct()
    return found.select(*keys, "from_stop", "end.to_stop", "start_at", "end.end_at", seconds.alias("seconds"))


def segment_trips(pings: DataFrame, route_stops: DataFrame, segments: DataFrame, radius_m: float = 50.0, gap_s: int = 180, max_gap_s: int = 900, low: float = 3.0, high: float = 120.0, tz: str = "Europe/Moscow", dealt: bool = False) -> DataFrame:
    """The whole chain from pings to trips of plausible speed between neighbouring stops.

    Visits whose direction can't be told go, but for those at terminals; a stop that a route serves twice counts once; trips get their segment's metres and ids, and a speed in km/h, of low to high, or less at a terminal.  pings: plate, route, event_time, lat,
    lon; route_stops: route, direction, stop_id, stop_order, stop_lat, stop_lon; segments: route, direction, from_stop, to_stop, segment_id, physical_id,
    metres.  A vehicle's pings meet in one task, and from there on nothing is moved; dealt: pings were dealt to tasks by route and plate before.
    """
    context = route_context(route_stops)
    visits = stop_visits(pings if dealt else pings.repartition("route", "plate"), route_stops, radius_m, gap_s, tz).select(*VISIT, "entered_at", "exited_at")
    placed = visits.join(served(context.select("route", "direction", "stop_id", "stop_order", "min_order", "max_order", "is_terminal")), ["route", "direction", "stop_id"])
    same_time = ["service_date", "plate", "route", "stop_id", "entered_at", "exited_at"]
    sure = dwell_dedup(direction_safe(placed, same_time), [*same_time, "direction"])
    found = neighbour_trips(sure.select(*visits.columns), context, max_gap_s)
    ends = context.select("route", "direction", F.col("stop_id").alias("from_stop"), "stop_order", "min_order", "max_order")
    rows = with_segment(found.join(served(ends), ["route", "direction", "from_stop"]), segments)
    speed = rows.withColumns({"speed_kmh": geo.kmh(F.col("metres"), F.col("seconds")), "start_order": F.col("stop_order"), "end_order": F.col("stop_order") + 1})
    return trips.plausible(speed, low, high).drop("stop_order", "min_order", "max_order", "start_order", "end_order")


def with_segment(found: DataFrame, segments: DataFrame, keys: tuple[str, ...] = ("route", "direction", "from_stop", "to_stop")) -> DataFrame:
    """Trips with their segment's attributes; segments are static, a few for each route stop."""
    return found.join(served(segments), list(keys))


def day_overtakes(found: DataFrame, segment: list[str], bucket_s: int = 900, parts: int | None = None) -> DataFrame:
    """Overtakes between trips of one segment and service date, with both trips' seconds.  parts: how many tasks the segments' days are dealt to, if not the session's number."""
    keys = [*segment, "service_date"]
    # Trips of one vehicle, start and end, as from stops at one spot, meet others as one, with their number.
    alike = found.groupBy(*keys, "plate", "start_at", "end_at", "seconds").agg(F.count("*").alias("copies"))
    ids = F.concat_ws("|", F.col("plate").cast("string"), F.unix_timestamp("start_at").cast("string"), *(F.col(c).cast("string") for c in segment))
    dealt = alike.repartition(parts, *keys) if parts else alike.repartition(*keys)
    pairs = trips.overtakes(dealt.withColumn("trip_id", ids), keys, bucket_s, carry=("seconds", "copies"), dealt=True)
    for side in ("overtaker", "overtaken"):
        pairs = pairs.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(f"{side}_copies")))).drop("__copy", f"{side}_copies")
    return pairs.withColumnsRenamed({"overtaker_seconds": "overtaker_s", "overtaken_seconds": "overtaken_s"})
