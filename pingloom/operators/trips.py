"""Segment trips and overtakes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_stop_trips(visits: DataFrame, keys: list[str], order: str = "stop_order", max_gap_s: int = 900) -> DataFrame:
    """Each visit with the earliest later visit at the next stop in order, 0 < gap <= max_gap_s."""
    start = visits.select(*keys, F.col("visit_id").alias("start_id"), F.col(order).alias("__o"), F.col("exited_at").alias("left_at"))
    end = visits.select(*keys, F.col("visit_id").alias("end_id"), (F.col(order) - 1).alias("__o"), F.col("entered_at").alias("reached_at"))
    gap = F.unix_timestamp("reached_at") - F.unix_timestamp("left_at")
    pairs = start.join(end, [*keys, "__o"]).withColumn("seconds", gap).where((gap > 0) & (gap <= max_gap_s))
    best = pairs.groupBy("start_id").agg(F.min(F.struct("reached_at", "end_id", "seconds")).alias("b"))
    return best.select("start_id", F.col("b.end_id").alias("end_id"), F.col("b.seconds").alias("seconds"))


def plausible(trips: DataFrame, low: float = 3.0, high: float = 120.0) -> DataFrame:
    """Trips of plausible speed; slow ones stay where a terminal is at either end."""
    slow_ok = (F.col("speed_kmh") >= low) | (F.col("start_order") == F.col("min_order")) | (F.col("end_order") == F.col("max_order"))
    return trips.where((F.col("speed_kmh") <= high) & slow_ok)


#: Trips of a segment that meet each other without being dealt out by time.
BUSY = 512


def overtakes(trips: DataFrame, segment: list[str], bucket_s: int | None = None, carry: tuple[str, ...] = (), latest: Column | None = None, dealt: bool = False) -> DataFrame:
    """Pairs (a, b) of one segment and other vehicles where a starts later and ends earlier than b: a's interval lies
    strictly inside b's.

    bucket_s: deals a busy segment, of over BUSY trips, out by time, in buckets of so long at least, and of its trips' mean length.  The longer trip goes into
    every bucket that it touches, the one inside only into that of its start, so each pair is found once.  carry: columns given for both, as overtaker_x and
    overtaken_x.  latest: where the segment's keys tell it, a time (of columns of trips) after which no trip of the segment starts; long trips go into no
    bucket behind it.  dealt: trips were dealt to tasks by columns of the segment, and are not moved for that again.
    """
    inside = (F.col("a_start") > F.col("b_start")) & (F.col("a_end") < F.col("b_end")) & (F.col("overtaker") != F.col("overtaken"))
    out = [*segment, "overtaker_id", "overtaken_id", "overtaker", "overtaken", F.col("a_end").alias("overtake_at"), *(f"{side}_{c}" for c in carry for side in ("overtaker", "overtaken"))]

    def side(rows: DataFrame, name: str, at: str, *more: Column | str) -> DataFrame:
        carried = [F.col(c).alias(f"{name}_{c}") for c in carry]
        return rows.select(*segment, F.col("trip_id").alias(f"{name}_id"), F.col("plate").alias(name), F.col("start_at").alias(f"{at}_start"), F.col("end_at").alias(f"{at}_end"), *carried, *more)

    if not bucket_s:
        return side(trips, "overtaker", "a").join(side(trips, "overtaken", "b"), segment).where(inside).select(*out)
    # The one shuffle that brings a segment together serves both sides of both joins; only busy segments' trips are moved again.
    whole = Window.partitionBy(*segment)
    length = F.unix_timestamp("end_at") - F.unix_timestamp("start_at")
    rows = (trips if dealt else trips.repartition(*segment)).withColumns({"__n": F.count("*").over(whole), "__w": F.ceil(F.greatest(F.lit(bucket_s), F.avg(length).over(whole))).cast("long")})
    quiet, busy = rows.where(F.col("__n") <= BUSY), rows.where(F.col("__n") > BUSY)
    few = side(quiet, "overtaker", "a").join(side(quiet, "overtaken", "b"), segment).where(inside).select(*out)
    low = lambda c: F.floor(F.unix_timestamp(c) / F.col("__w"))
    until = low("end_at") if latest is None else F.least(low("end_at"), low(latest))
    a = side(busy, "overtaker", "a", low("start_at").alias("__t"))
    b = side(busy, "overtaken", "b", F.explode(F.sequence(low("start_at"), F.greatest(low("start_at"), until))).alias("__t"))
    return few.unionByName(a.join(b, [*segment, "__t"]).where(inside).select(*out))


def fastest_slowest(trips: DataFrame, segment: str = "segment_id") -> DataFrame:
    """The quickest and the slowest trip of each segment, if other vehicles made them."""
    key = F.struct("seconds", "plate", "trip_id")
    found = trips.groupBy(segment).agg(F.min(key).alias("f"), F.max(key).alias("s")).where("f.plate <> s.plate")
    return found.select(segment, F.col("f.plate").alias("fast_plate"), F.col("s.plate").alias("slow_plate"), F.col("f.seconds").alias("fast_s"), F.col("s.seconds").alias("slow_s"))


def decile_ratio(trips: DataFrame, segment: str = "segment_id", value: str = "seconds") -> DataFrame:
    """Sums and counts of the tenth of each segment's trips with the least and the greatest values, and their means' ratio.

    The tenths are the first and the last tile of ten; a place and a count give both, so rows are sorted once.
    """
    place = F.row_number().over(Window.partitionBy(segment).orderBy(value, "trip_id"))
    size = F.ceil(F.count("*").over(Window.partitionBy(segment)) / 10)
    ranked = trips.withColumns({"__place": place, "__n": F.count("*").over(Window.partitionBy(segment)), "__tenth": size})
    marked = ranked.withColumns({"q": F.col("__place") <= F.col("__tenth"), "s": F.col("__place") > F.col("__n") - F.col("__tenth")})
    pick = lambda c: (F.sum(F.when(F.col(c), F.col(value))).alias(f"{c}_sum"), F.count_if(c).alias(f"{c}_n"))
    ratio = F.try_divide(F.avg(F.when(F.col("s"), F.col(value))), F.avg(F.when(F.col("q"), F.col(value))))
    return marked.groupBy(segment).agg(*pick("q"), *pick("s"), ratio.alias("ratio"))


def wait_ratio(trips: DataFrame, keys: list[str], grain: list[str]) -> DataFrame:
    """Seconds of riding, seconds of waiting and their ratio.  A wait counts where a vehicle's next trip starts at the stop at
    which this one ended.  trips: trip_id, from_stop, to_stop, start_at, end_at, seconds."""
    w = Window.partitionBy(*keys).orderBy("start_at", "trip_id")
    rows = trips.withColumns({"__next": F.lead("start_at").over(w), "__from": F.lead("from_stop").over(w)})
    wait = F.when(F.col("__from") == F.col("to_stop"), F.unix_timestamp("__next") - F.unix_timestamp("end_at")).otherwise(0)
    found = rows.groupBy(*grain).agg(F.sum("seconds").alias("moving_s"), F.sum(wait).alias("waiting_s"))
    return found.withColumn("ratio", F.try_divide(F.col("waiting_s").cast("double"), F.col("moving_s")))


def split_runs(visits: DataFrame, keys: list[str], max_gap_s: int = 1800) -> DataFrame:
    """Numbers the runs of a vehicle's visits: a new one starts after a gap of over max_gap_s, or where stop order falls."""
    w = Window.partitionBy(*keys).orderBy("entered_at", "visit_id")
    gap = F.unix_timestamp("entered_at") - F.unix_timestamp(F.lag("exited_at").over(w))
    new = F.when((gap <= max_gap_s) & (F.col("stop_order") >= F.lag("stop_order").over(w)), 0).otherwise(1)
    return visits.withColumn("__new", new).withColumn("run", F.sum("__new").over(w).cast("long")).drop("__new")


def waits_and_moves(visits: DataFrame, keys: list[str]) -> DataFrame:
    """Seconds at stops and between them, by the next visit's entry."""
    w = Window.partitionBy(*keys).orderBy("entered_at", "visit_id")
    nxt = F.lead("entered_at").over(w)
    rows = visits.withColumns({"wait": F.unix_timestamp("exited_at") - F.unix_timestamp("entered_at"), "move": F.unix_timestamp(nxt) - F.unix_timestamp("exited_at")})
    return rows.groupBy(*keys).agg(F.sum("wait").alias("wait_s"), F.coalesce(F.sum("move"), F.lit(0)).alias("move_s"))


def skipped_stops(visits: DataFrame, keys: list[str], max_gap_s: int = 1800) -> DataFrame:
    """Arrivals at orders that a vehicle jumped over, shared out evenly in time."""
    w = Window.partitionBy(*keys).orderBy("entered_at", "visit_id")
    rows = visits.withColumns({"next_order": F.lead("stop_order").over(w), "next_at": F.unix_timestamp(F.lead("entered_at").over(w)), "at": F.unix_timestamp("exited_at")})
    rows = rows.where((F.col("next_order") > F.col("stop_order") + 1) & (F.col("next_at") - F.col("at")).between(1, max_gap_s))
    rows = rows.withColumn("missed", F.explode(F.sequence(F.col("stop_order") + 1, F.col("next_order") - 1)))
    share = F.expr("at + (next_at - at) * (missed - stop_order) div (next_order - stop_order)")
    return rows.select(*keys, "visit_id", F.col("missed").cast("long").alias("missed"), share.cast("long").alias("arrival"))
