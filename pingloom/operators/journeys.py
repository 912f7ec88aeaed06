"""Journeys: first departures as of a time, earliest arrivals with their legs, replay of known paths, and their roll-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rollup import mean, rounded
from .rounds import written, written_by

LEG = "array<struct<from_stop:bigint,to_stop:bigint,dep:bigint,arr:bigint,plate:bigint>>"


def first_arrivals(requests: DataFrame, trips: DataFrame, keys: tuple[str, ...] = ("from_stop", "to_stop")) -> DataFrame:
    """As-of join: of the trips of a request's keys that leave at its `at` or later, the one with the least arrival.

    requests: keys, at, and others; trips: keys, dep, arr, plate.  Adds dep, arr and plate; ties go to the earlier
    departure, then the lesser plate.  Both sides are put in one order of time and a running minimum does the rest, so a request
    never meets all later trips.
    """
    best = F.struct("arr", "dep", "plate")
    rest = [c for c in requests.columns if c not in (*keys, "at")]
    asked = requests.select(*keys, F.col("at").alias("__t"), F.lit(1).alias("__ask"), F.lit(None).cast(trips.select(best.alias("b")).schema["b"].dataType).alias("__trip"), F.struct(*rest, "at").alias("__row"))
    there = trips.select(*keys, F.col("dep").alias("__t"), F.lit(0).alias("__ask"), best.alias("__trip"), F.lit(None).cast(asked.schema["__row"].dataType).alias("__row"))
    later = Window.partitionBy(*keys).orderBy(F.desc("__t"), "__ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = asked.unionByName(there).withColumn("__best", F.min("__trip").over(later)).where("__ask = 1 and __best is not null")
    return found.select(*keys, "__row.*", F.col("__best.dep").alias("dep"), F.col("__best.arr").alias("arr"), F.col("__best.plate").alias("plate"))


def _leg(frm: str, to: str) -> Column:
    kind = ["from_stop", "to_stop", "dep", "arr", "plate"]
    return F.struct(*(F.col(c).cast("long").alias(n) for c, n in zip([frm, to, "dep", "arr", "plate"], kind, strict=True)))


def leg_text(leg: Column) -> Column:
    return F.concat_ws("-", *(leg[c].cast("string") for c in ("from_stop", "to_stop", "dep", "arr", "plate")))


def first_by_departure(trips: DataFrame, keys: tuple[str, ...] = ("from_stop", "to_stop")) -> DataFrame:
    """Of each key's trips that leave at one time the one that arrives first (ties: the lesser plate): no other is ever a first arrival."""
    found = trips.groupBy(*keys, "dep").agg(F.min(F.struct("arr", "plate")).alias("b"))
    return found.select(*keys, "dep", "b.arr", "b.plate")


def earliest_journeys(trips: DataFrame, origins: DataFrame, rounds: int = 3, changes: DataFrame | None = None) -> DataFrame:
    """The earliest arrival at each stop with at most `rounds` rides, and its legs.

    trips: from_stop, to_stop, dep, arr, plate; origins: origin, stop, at.  Only labels that a round has changed go on, and with changes
    (stop_id) only those at their origin's own stop or at one of these.  Each trip counts as a ride; runs.run_journeys counts vehicles.
    Ties go to the lesser text of the legs.  No candidate is capped.
    """
    trips = written(first_by_departure(trips), "trips")
    links = written(trips.select("from_stop", "to_stop").distinct(), "links")
    if changes is not None:
        changes = written(changes.select(F.col("stop_id").alias("stop")).distinct(), "changes")
    start = origins.select("origin", "stop", "at", F.lit("").alias("path"), F.array().cast(LEG).alias("legs"))
    best = moved = written(start, "labels")
    for k in range(rounds):
        if k and changes is not None:
            moved = moved.join(changes, "stop", "left_semi")
        requests = moved.join(links, F.col("stop") == F.col("from_stop")).drop("stop")
        step = first_arrivals(requests, trips).withColumn("__leg", _leg("from_stop", "to_stop"))
        text = F.concat_ws(">", F.when(F.col("path") != "", F.col("path")), leg_text(F.col("__leg")))
        step = step.select("origin", F.col("to_stop").alias("stop"), F.col("arr").alias("at"), text.alias("path"), F.array_append("legs", F.col("__leg")).alias("legs"))
        least = F.min(F.struct("at", "path", "legs")).alias("b")
        new = best.withColumn("old", F.lit(True)).unionByName(step.withColumn("old", F.lit(False)))
        new = new.groupBy("origin", "stop").agg(least, F.min(F.when(F.col("old"), F.struct("at", "path"))).alias("was"))
        new = written(new.select("origin", "stop", "b.*", (~F.struct("b.at", "b.path").eqNullSafe(F.col("was"))).alias("moved")), "labels")
        best, moved = new.drop("moved"), new.where("moved").drop("moved")
        if moved.isEmpty():
            break
    return best.select("origin", "stop", "at", "path", "legs", F.size("legs").alias("rides"))


def fragments(journeys: DataFrame, keys: tuple[str, ...] = ("origin", "stop")) -> DataFrame:
    """Runs of one vehicle in each journey's legs: gaps and islands over legs in order."""
    rows = journeys.select(*keys, F.posexplode("legs").alias("leg", "x")).select(*keys, "leg", "x.*")
    w = Window.partitionBy(*keys).orderBy("leg")
    rows = rows.withColumn("new", F.when(F.lag("plate").over(w) == F.col("plate"), 0).otherwise(1)).withColumn("fragment", F.sum("new").over(w))
    return rows.groupBy(*keys, "fragment").agg(
        F.min("dep").alias("board"), F.max("arr").alias("alight"), F.count("*").alias("legs"), F.min("plate").alias("plate")
    )


def transfer_stops(route_stops: DataFrame, stop: str = "stop_id", route: str = "route") -> DataFrame:
    """Stops that two route patterns or more serve; only these are worth a change."""
    return route_stops.groupBy(stop).agg(F.countDistinct(route).alias("patterns")).where("patterns > 1")


def network_journeys(trips: DataFrame, origins: DataFrame, changes: DataFrame, rounds: int = 3) -> DataFrame:
    """earliest_journeys that go on from their own origin or a transfer stop only (changes: stop_id)."""
    return earliest_journeys(trips, origins, rounds, changes)


def arrival_slots(trips: DataFrame, keys: list[str], slot: int) -> DataFrame:
    """keys, slot, now and later: for each slot of departure times its trips, and of all later trips the one that arrives first.

    trips: keys, dep, arr, plate.  Slots before a later trip have rows too, so the first arrival as of any time is one equality join away.
    """
    trip = F.struct("arr", "dep", "plate")
    slots = trips.withColumn("slot", F.floor(F.col("dep") / slot).cast("long")).groupBy(*keys, "slot").agg(F.collect_list(trip).alias("now"), F.min(trip).alias("__best"))
    order = Window.partitionBy(*keys).orderBy("slot")
    behind = Window.partitionBy(*keys).orderBy(F.desc("slot")).rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumns({"__from": F.coalesce(F.lag("slot").over(order) + 1, F.least(F.lit(0), F.col("slot"))), "later": F.min("__best").over(behind)})
    spread = slots.withColumn("__at", F.explode(F.sequence("__from", "slot")))
    own = F.col("__at") == F.col("slot")
    nothing = F.slice("now", 1, 0)
    return spread.select(*keys, F.col("__at").alias("slot"), F.when(own, F.col("now")).otherwise(nothing).alias("now"), F.when(own, F.col("later")).otherwise(F.least("__best", F.coalesce("later", "__best"))).alias("later"))


def _steps() -> Column:
    """Each hop of a path as text: the stop that it leads to, and the metres of a walk."""
    hop = lambda k: F.concat_ws(":", F.element_at("path", k + 1).cast("string"), F.coalesce(F.element_at("meters_walked", k).cast("string"), F.lit("ride")))
    return F.transform(F.sequence(F.lit(1), F.size("meters_walked")), hop)


def path_trie(paths: DataFrame) -> DataFrame:
    """The distinct prefixes of paths (origin, path, meters_walked) as nodes: origin, level, up and node (prefixes as text), from_stop, to_stop, walked."""
    rows = paths.where(F.size("meters_walked") > 0).select("origin", "path", "meters_walked", _steps().alias("step")).withColumn("level", F.explode(F.sequence(F.lit(1), F.size("step"))))
    prefix = lambda k: F.array_join(F.slice("step", 1, k), ">")
    nodes = rows.select("origin", "level", prefix(F.col("level") - 1).alias("up"), prefix(F.col("level")).alias("node"), F.element_at("path", F.col("level")).alias("from_stop"), F.element_at("path", F.col("level") + 1).alias("to_stop"), F.element_at("meters_walked", F.col("level")).alias("walked"))
    return nodes.distinct()


def replay(paths: DataFrame, trips: DataFrame, requests: DataFrame, max_hops: int = 4, mps: float = 1.4, slot: int = 900, fallback: DataFrame | None = None, least: int = 0) -> DataFrame:
    """The earliest arrival at each destination by known paths.

    paths: origin, stop, path (stops in order), meters_walked (for each hop: metres, or null for a ride); requests: origin, at, requested.
    A ride is the first arrival as of the time; a walk takes its metres over mps, rounded up.  Paths are kept as a trie, so a prefix that
    many share is ridden once; trips are dealt once, into buckets of (from, to, slot), and each level joins its labels to them without moving trips again.
    fallback (origin, requested, stop, at): what a search found; it is taken into requests with under `least` destinations.
    """
    trie = written(path_trie(paths.where(F.size("path") <= max_hops + 1)), "trie")
    key = ["from_stop", "to_stop"]
    slots = written_by(arrival_slots(first_by_departure(trips), key, slot), "slots", [*key, "slot"])
    labels = written(requests.select("origin", "requested", "at", F.lit("").alias("node")), "labels")
    ends = written(paths.select("origin", "stop", path_text().alias("node")).distinct(), "ends")
    done = labels.join(ends, ["origin", "node"]).select("origin", "requested", "stop", "at")
    for level in range(1, max_hops + 1):
        here = trie.where(F.col("level") == level).drop("level").join(labels.withColumnRenamed("node", "up"), ["origin", "up"])
        walked = here.where("walked is not null").withColumn("at", (F.col("at") + F.ceil(F.col("walked") / mps)).cast("long"))
        asked = here.where("walked is null").withColumn("slot", F.floor(F.col("at") / slot).cast("long")).join(slots, [*key, "slot"])
        soon = F.array_min(F.filter("now", lambda t: t["dep"] >= F.col("at")))
        ridden = asked.withColumn("__best", F.least(F.coalesce(soon, "later"), F.coalesce("later", soon))).where("__best is not null").withColumn("at", F.col("__best.arr"))
        keep = ["origin", "requested", "at", "node"]
        labels = written(walked.select(*keep).unionByName(ridden.select(*keep)), "labels")
        done = done.unionByName(labels.join(ends, ["origin", "node"]).select("origin", "requested", "stop", "at"))
    found = done.groupBy("origin", "requested", "stop").agg(F.min("at").alias("at"))
    if fallback is None:
        return found
    found = written(found, "found")
    known = found.groupBy("origin", "requested").agg(F.count("*").alias("__n"))
    short = requests.select("origin", "requested").distinct().join(known, ["origin", "requested"], "left").where(F.coalesce("__n", F.lit(0)) < least).drop("__n")
    more = fallback.select(*found.columns).join(short, ["origin", "requested"], "left_semi")
    return found.unionByName(more).groupBy("origin", "requested", "stop").agg(F.min("at").alias("at"))


def path_text() -> Column:
    """A path's name in path_trie."""
    return F.when(F.size("meters_walked") == 0, "").otherwise(F.array_join(_steps(), ">"))


def request_grid(journeys: DataFrame, buckets: DataFrame, origins: int, stops: int) -> DataFrame:
    """For each bucket of the spine: possible pairs, reached pairs, journeys, vehicle changes; zeros where there are none."""
    found = journeys.groupBy("bucket").agg(
        F.countDistinct("origin", "stop").alias("reachable"), F.count("*").alias("detailed"), F.sum("fragments").alias("fragments")
    )
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    possible = F.lit(origins * (stops - 1)).cast("long").alias("possible")
    return buckets.join(found, "bucket", "left").select("bucket", possible, zero("reachable"), zero("detailed"), zero("fragments"))


def least_to(journeys: DataFrame, origins: list[int], keys: tuple[str, ...] = ("bucket", "stop")) -> DataFrame:
    """The least journey time of a set of origins to each stop and bucket."""
    return journeys.where(F.col("origin").isin(origins)).groupBy(*keys).agg(F.min("seconds").alias("least"))


def od_summary(journeys: DataFrame, keys: list[str]) -> DataFrame:
    """journeys: journey_id, seconds, pattern and the keys."""
    return journeys.groupBy(*keys).agg(
        F.min("seconds").alias("least"),
        rounded(F.avg("seconds")).cast("long").alias("mean"),
        F.count("*").alias("n"),
        F.min(F.struct("seconds", "journey_id"))["journey_id"].alias("best"),
        F.max("pattern").alias("pattern"),
    )


def od_patterns(journeys: DataFrame, keys: list[str]) -> DataFrame:
    """od_summary by route pattern, with waits, rides and changes."""
    whole = lambda c: rounded(F.avg(c)).cast("long")
    return journeys.groupBy(*keys, "pattern").agg(
        F.count("*").alias("n"),
        whole("seconds").alias("mean"),
        whole("wait_s").alias("mean_wait"),
        whole("ride_s").alias("mean_ride"),
        mean("changes").alias("mean_changes"),
        F.min("seconds").alias("least"),
        F.min(F.struct("seconds", "journey_id"))["journey_id"].alias("best"),
    )
