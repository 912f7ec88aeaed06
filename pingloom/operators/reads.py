"""What a map of a city's traffic asks for, as functions over the caller's own tables.

Overtakes (one row each): service_date, segment_id, physical_id, route, overtaker, overtaken, overtake_at, overtaker_s, overtaken_s, and lat and lon
of the segment's middle.  Dwell events: service_date, plate, route, stop_id, entered_at, exited_at, dwell (seconds), is_terminal, lat, lon.  Trips: service_date,
segment_id, physical_id, route, direction, from_lat, from_lon, to_lat, to_lon, speed_kmh, end_at.  Stored by service_date, a period reads only its days.

Periods: `previous` is the day asked for; `all` is every day before today; `weekday` those of one weekday (1 to 7).
"""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import when
from . import containment, network, rollup
from .packs import Packs

CITY = "Europe/Moscow"
BUCKET_S = 300

#: What overtakes are counted by, for each scope and mode.
OVERTAKE_MODES = {
    ("route", "segment"): ["segment_id"],
    ("route", "segmentRoute"): ["segment_id", "route"],
    ("route", "segmentVehicle"): ["segment_id", "overtaker"],
    ("route", "vehicle"): ["overtaker"],
    ("physical", "segment"): ["physical_id"],
    ("physical", "segmentVehicle"): ["physical_id", "overtaker"],
    ("physical", "vehicle"): ["overtaker"],
    ("route", "pointHeatmap"): ["y", "x"],
    ("physical", "pointHeatmap"): ["y", "x"],
}
DWELL_MODES = {"stop": ["stop_id"], "stopRoute": ["stop_id", "route"], "route": ["route"], "vehicle": ["plate"], "heatmap": ["y", "x"], "longHeatmap": ["y", "x"], "longClusters": ["stop_id"]}
SPEED_MODES = {"point": ["y", "x"], "physicalSegment": ["physical_id"], "routeSegment": ["segment_id", "route", "direction"], "route": ["route", "direction"]}


def in_period(period: str = "all", day=None, weekday: int | None = None, today=None) -> Column:
    """The days of a period; without a day `previous` takes all, as `weekday` does without a weekday.  today: the city's day if it isn't given."""
    if period == "previous":
        return F.lit(True) if day is None else F.col("service_date") == F.lit(str(day)).cast("date")
    today = dt.datetime.now(ZoneInfo(CITY)).date() if today is None else today
    return rollup.period_filter(period, None, str(today), weekday)


def _points(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"y": rollup.grid("lat", 3), "x": rollup.grid("lon", 3)}) if "lat" in rows.columns else rows


def _key(scope: str) -> str:
    return {"route": "segment_id", "physical": "physical_id"}[scope]


def overtake_rows(events: DataFrame, scope: str = "route", plate=None, segment=None, **period) -> DataFrame:
    """Overtakes of a period, and of a vehicle or a segment of the scope."""
    return events.where(in_period(**period) & rollup.event_filter(**{"overtaker": plate, _key(scope): segment}))


def overtakes(events: DataFrame, scope: str = "route", mode: str = "segment", **asked) -> DataFrame:
    """Overtakes by what the mode shows: n, days, the mean a day, the last one, both sides' mean seconds.  events: pairs, or counted_overtakes."""
    dims = OVERTAKE_MODES[scope, mode]
    rows = _points(overtake_rows(events, scope, **asked))
    if "n" not in rows.columns:
        rows = rows.withColumns({"n": F.lit(1), "last_overtaken": F.col("overtaken")})
    mean_s = lambda total: rollup.rounded(F.sum(total) / F.sum("n")).cast("long")
    found = rows.groupBy(*dims).agg(
        F.sum("n").alias("n"),
        F.count_distinct("service_date").alias("days"),
        F.max(F.struct("overtake_at", "overtaker", "last_overtaken")).alias("l"),
        mean_s(F.col("n") * F.col("overtaker_s")).alias("overtaker_mean_s"),
        mean_s("overtaken_s").alias("overtaken_mean_s"),
    )
    return found.select(*dims, "n", "days", rollup.rounded(F.col("n") / F.col("days"), 2).alias("per_day"), F.col("l.overtake_at").alias("last_at"), F.col("l.last_overtaken").alias("last_overtaken"), "overtaker_mean_s", "overtaken_mean_s")


def counted_overtakes(trips: DataFrame, scope: str = "route", bucket_s: int = 900, parts: int | None = None, made: containment.Made | None = None, since: Column | None = None, packs: Packs | None = None) -> DataFrame:
    """A row for each trip that overtakes, instead of one for each pair, of which a busy segment has as many as the square of its trips: service_date,
    segment_id, physical_id, route, overtaker, started_at, overtake_at, overtaker_s, lat, lon, n, overtaken_s (summed over those overtaken) and last_overtaken (the greatest
    of their vehicles).  trips: service_date, segment_id, physical_id, route, plate, start_at, end_at, seconds, lat, lon; what follows
    from the segment may be left out here and added to the result.  made, since, packs: as in overtake_counts."""
    keys = ["service_date", _key(scope)]
    carry = tuple(c for c in ("segment_id", "physical_id", "route", "lat", "lon") if c not in keys and c in [*trips.columns, *(made(F.col) if made else ())])
    return containment.overtake_counts(trips, keys, bucket_s, carry, order="plate", parts=parts, since=since, made=made, packs=packs).withColumnsRenamed({"plate": "overtaker", "start_at": "started_at", "end_at": "overtake_at", "seconds": "overtaker_s"})


def overtake_details(events: DataFrame, scope: str = "route", page: int = 1, size: int = 50, trips: DataFrame | None = None, bucket_s: int = 900, **asked) -> DataFrame:
    """A page of overtakes, the last first, with the number of all.  With counted_overtakes as events, the pairs of the page are made from trips
    (counted_overtakes' ones): each that overtakes has one row at least, so no pair is needed behind as many of them as the page's end."""
    rows = overtake_rows(events, scope, **asked)
    order = [F.desc("overtake_at"), F.col("overtaker"), F.col("overtaken"), F.col(_key(scope))]
    if trips is None:
        return rollup.page_with_total(rows, order, page, size)
    size, number = min(max(1, size), 50), max(1, page)
    # The trip at the page's end; all that end at its time or later have their pairs made.
    least = rows.orderBy(F.desc("overtake_at")).limit(number * size).agg(F.min("overtake_at").alias("__least"))
    some = rows.join(F.broadcast(least)).where(F.col("overtake_at") >= F.col("__least")).drop("n", "overtaken_s", "last_overtaken", "__least")
    low = lambda c: F.floor(F.unix_timestamp(F.col(c).cast("timestamp")) / bucket_s)
    keys = ["service_date", _key(scope)]
    others = trips.select(*keys, F.col("plate").alias("overtaken"), F.col("seconds").alias("overtaken_s"), F.col("start_at").alias("__a"), F.col("end_at").alias("__b"))
    others = others.withColumn("__t", F.explode(F.sequence(low("__a"), low("__b"))))
    pairs = some.withColumn("__t", low("started_at")).join(others, [*keys, "__t"]).where("__a < started_at and __b > overtake_at and overtaken <> overtaker")
    total = rows.agg(F.sum("n").alias("total"))
    return rollup.page(pairs.drop("__t", "__a", "__b", "started_at"), order, number, size).join(F.broadcast(total)).withColumn("has_more", F.col("total") > number * size)


def timeline(rows: DataFrame, at: str, bucket_s: int = BUCKET_S, n: Column | None = None) -> DataFrame:
    """Events in buckets of five minutes: bucket (its start) and n."""
    return rows.where(F.col(at).isNotNull()).groupBy(when.bucket_start(F.col(at), bucket_s).alias("bucket")).agg((F.count("*") if n is None else F.sum(n)).alias("n"))


def overtake_timeline(events: DataFrame, scope: str = "route", **asked) -> DataFrame:
    """events: pairs, or counted_overtakes."""
    return timeline(overtake_rows(events, scope, **asked), "overtake_at", n=F.col("n") if "n" in events.columns else None)


def dwell_rows(events: DataFrame, mode: str = "stop", over60: bool = False, policy: str = "with-terminals", stop=None, route=None, plate=None, **period) -> DataFrame:
    """Dwell events of a period; modes that begin with `long` take those of over a minute."""
    long = over60 or mode.startswith("long")
    return events.where(in_period(**period) & rollup.dwell_filter(long, policy, stop_id=stop, route=route, plate=plate))


def dwell(events: DataFrame, mode: str = "stop", **asked) -> DataFrame:
    """Dwell by what the mode shows: n, total, mean and most seconds, days, and the last vehicle."""
    dims = DWELL_MODES[mode]
    rows = _points(dwell_rows(events, mode, **asked))
    last = F.max(F.struct("exited_at", "plate", "route"))
    found = rows.groupBy(*dims).agg(F.count("*").alias("n"), F.sum("dwell").alias("total_s"), rollup.mean("dwell").alias("mean_s"), F.max("dwell").alias("most_s"), F.count_distinct("service_date").alias("days"), last.alias("l"))
    return found.select(*dims, "n", "total_s", "mean_s", "most_s", "days", F.col("l.exited_at").alias("last_at"), F.col("l.plate").alias("last_plate"))


def dwell_details(events: DataFrame, page: int = 1, size: int = 50, **asked) -> DataFrame:
    """A page of dwell events, the last first, with the number of all."""
    return rollup.page_with_total(dwell_rows(events, **asked), [F.desc("entered_at"), F.col("plate"), F.col("stop_id")], page, size)


def dwell_timeline(events: DataFrame, **asked) -> DataFrame:
    return timeline(dwell_rows(events, **asked), "entered_at")


def speed_by_day(trips: DataFrame, mode: str = "point") -> DataFrame:
    """Kilometres an hour by day: samples, mean, least, most and the last trip; points are the middles of trips on a grid of a thousandth of a degree."""
    rows = trips.where(F.col("speed_kmh") > 0)
    if mode == "point":
        rows = _points(rows.withColumns({"lat": (F.col("from_lat") + F.col("to_lat")) / 2, "lon": (F.col("from_lon") + F.col("to_lon")) / 2}))
    speed = F.col("speed_kmh")
    return rollup.daily(rows, SPEED_MODES[mode], {"n": F.count("*"), "mean_kmh": rollup.mean(speed), "least_kmh": rollup.rounded(F.min(speed), 2), "most_kmh": rollup.rounded(F.max(speed), 2), "last_at": F.max("end_at")})


def speed_map(trips: DataFrame, mode: str = "point", **period) -> DataFrame:
    """Days of a period together: samples, the mean weighted by them, least and most."""
    days = speed_by_day(trips, mode).where(in_period(**period))
    weighted = rollup.rounded(F.sum(F.col("mean_kmh") * F.col("n")) / F.sum("n"), 2)
    return days.groupBy(*SPEED_MODES[mode]).agg(F.sum("n").alias("n"), F.count("*").alias("days"), weighted.alias("mean_kmh"), F.min("least_kmh").alias("least_kmh"), F.max("most_kmh").alias("most_kmh"))


def last_passes(visits: DataFrame, grain: tuple[str, ...] = ("route", "stop_id"), **period) -> DataFrame:
    """The last pass of each day of a period: entry, exit and dwell of the visit, its vehicle and second of day.  visits: service_date, plate, route,
    stop_id, entered_at, exited_at."""
    best = F.max(F.struct("exited_at", "entered_at", "plate", "route"))
    found = visits.where(in_period(**period)).groupBy("service_date", *grain).agg(best.alias("b"))
    seconds = F.unix_timestamp("b.exited_at") - F.unix_timestamp("b.entered_at")
    return found.select("service_date", *grain, F.col("b.entered_at").alias("entered_at"), F.col("b.exited_at").alias("exited_at"), seconds.alias("dwell"), F.col("b.plate").alias("plate"), F.col("b.route").alias("last_route"), when.second_of_day(F.col("b.exited_at")).alias("second_of_day"))


def origin_clusters(stops: DataFrame, radius_m: float = 180.0) -> DataFrame:
    """cluster, label, stop_ids, names: stops of one name near each other, in the order of label and first stop."""
    named = stops.where("stop_id is not null and stop_name is not null and stop_lat is not null and stop_lon is not null")
    parts = network.named_clusters(named, radius_m).join(named.select("stop_id", "stop_name"), "stop_id")
    found = parts.groupBy(F.col("label").alias("cluster")).agg(F.sort_array(F.collect_set("stop_id")).alias("stop_ids"), F.min_by("stop_name", "stop_id").alias("label"), F.sort_array(F.collect_set("stop_name")).alias("names"))
    return found.orderBy(F.lower("label"), F.get("stop_ids", 0))

