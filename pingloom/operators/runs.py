"""Journeys by vehicle runs: a traveller boards a run and stays on it, so all its later stops are one ride.

Events are trips of a vehicle between two stops: service_date, pattern (route and direction), ride (route and vehicle), from_stop, to_stop,
dep, arr (seconds of the service day, dep <= arr).  All tables here are keyed by service day.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rounds import written

RIDE = ["service_date", "ride"]
_ORDER = ["dep", "arr", "from_stop", "to_stop"]
LABEL = ["service_date", "origin", "requested", "stop"]
LEG = ["pattern", "ride", "from_stop", "to_stop", "dep", "arr"]


def vehicle_runs(events: DataFrame, max_gap_s: int = 1800) -> DataFrame:
    """Adds run, place, on_run, next_run and next_place.

    Events of a ride go by departure.  One that leaves before an earlier one has arrived is off the run (repeated or overlapping
    records): it has no place, but whoever boards it goes on with the first event of the run that leaves after its arrival.  A new run starts
    after a gap of over max_gap_s.  next_run and next_place tell where the ride goes on; next_run is null where it ends.
    """
    order = Window.partitionBy(*RIDE).orderBy(*_ORDER)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = events.withColumn("on_run", F.coalesce(F.col("dep") >= F.max("arr").over(earlier), F.lit(True)))
    last = F.max(F.when(F.col("on_run"), F.col("arr"))).over(earlier)
    rows = rows.withColumn("__new", F.when(F.col("on_run") & F.coalesce(F.col("dep") - last > max_gap_s, F.lit(True)), 1).otherwise(0))
    rows = rows.withColumns({"run": F.sum("__new").over(order).cast("long"), "place": F.sum(F.col("on_run").cast("int")).over(order).cast("long")}).drop("__new")

    # Where an event off the run goes on: runs at their departure and such events at their arrival in one order of time.
    at = F.when(F.col("on_run"), F.col("dep")).otherwise(F.col("arr"))
    here = F.when(F.col("on_run"), F.struct("place", "run", "dep"))
    later = Window.partitionBy(*RIDE).orderBy(F.desc("__t"), F.desc("on_run"), F.desc("place")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("__t", at).withColumn("__next", F.min(here).over(later))
    off = F.when(F.col("__next.dep") - F.col("arr") <= max_gap_s, F.col("__next.run"))
    found = rows.withColumns({"next_run": F.when(F.col("on_run"), F.col("run")).otherwise(off), "next_place": F.when(F.col("on_run"), F.col("place") + 1).otherwise(F.col("__next.place"))})
    blank = lambda c: F.when(F.col("on_run"), F.col(c))
    return found.withColumns({"run": blank("run"), "place": blank("place")}).drop("__t", "__next")


def filled_stops(events: DataFrame, runs: DataFrame, route_stops: DataFrame) -> DataFrame:
    """Arrivals at stops that a run passes without an event: service_date, ride, run, place, to_stop, arr, pattern.

    events and runs: as above, with start_order and end_order; route_stops: pattern, stop, stop_order.  Between two events of one pattern the time is shared out
    by stop order, rounded, and is a second at least.  place is that of the event before.
    """
    order = Window.partitionBy(*RIDE, "run").orderBy("place")
    nxt = lambda c: F.lead(c).over(order)
    rows = runs.where("on_run").withColumns({"__order": nxt("start_order"), "__dep": nxt("dep"), "__pattern": nxt("pattern")})
    gaps = rows.where("__pattern = pattern and __order > end_order + 1 and __dep > arr")
    stops = route_stops.select("pattern", F.col("stop").alias("__stop"), "stop_order")
    inside = gaps.join(stops, "pattern").where("stop_order > end_order and stop_order < __order")
    share = (F.col("stop_order") - F.col("end_order")) / (F.col("__order") - F.col("end_order"))
    late = F.greatest(F.lit(1), F.floor((F.col("__dep") - F.col("arr")) * share + F.lit(0.5)))
    return inside.select(*RIDE, "run", "place", F.col("__stop").alias("to_stop"), (F.col("arr") + late).cast("long").alias("arr"), "pattern")


def timetable(runs: DataFrame, boardings: int = 6, slot_s: int = 900) -> DataFrame:
    """service_date, stop, pattern, slot, now and later: for each slot of time the departures in it, and the first `boardings` after it.

    Slots without departures before a later one have rows too, so the first departures after any time are one equality join away.
    """
    key = ["service_date", "from_stop", "pattern"]
    event = F.struct("dep", "arr", "ride", "to_stop", "next_run", "next_place")
    order = Window.partitionBy(*key).orderBy(event)
    ahead = F.collect_list(event).over(order.rowsBetween(0, boardings))
    rows = runs.withColumns({"slot": F.floor(F.col("dep") / slot_s).cast("long"), "__event": event, "__ahead": ahead, "__n": F.row_number().over(order)})
    slots = rows.groupBy(*key, "slot").agg(F.sort_array(F.collect_list("__event")).alias("now"), F.min_by("__ahead", "__n").alias("__first"), F.max_by("__ahead", "__n").alias("__last"))
    before = F.coalesce(F.lag("slot").over(Window.partitionBy(*key).orderBy("slot")), F.lit(-1))
    slots = slots.withColumn("__from", before + 1).withColumn("__at", F.explode(F.sequence("__from", "slot")))
    own = F.col("__at") == F.col("slot")
    nothing = F.slice("now", 1, 0)
    return slots.select("service_date", F.col("from_stop").alias("stop"), "pattern", F.col("__at").alias("slot"), F.when(own, F.col("now")).otherwise(nothing).alias("now"), F.when(own, F.slice("__last", 2, boardings)).otherwise(F.slice("__first", 1, boardings)).alias("later"))


def change_stops(events: DataFrame) -> DataFrame:
    """service_date and stop of stops that two patterns or more serve on that day."""
    ends = events.select("service_date", F.explode(F.array("from_stop", "to_stop")).alias("stop"), "pattern")
    return ends.groupBy("service_date", "stop").agg(F.countDistinct("pattern").alias("__n")).where("__n > 1").drop("__n")


def leg_text(leg: Column) -> Column:
    return F.concat_ws("-", *(leg[c].cast("string") for c in LEG))


def run_journeys(events: DataFrame, requests: DataFrame, rides: int = 3, boardings: int = 6, max_gap_s: int = 1800, slot_s: int = 900, skipped: DataFrame | None = None) -> DataFrame:
    """The earliest arrival at each stop with 1, 2 .. `rides` rides, where one more ride gains time, and its legs.

    requests: service_date, origin, requested (second of day).  A label boards the first `boardings` departures of each pattern at its stop and
    takes all later stops of those runs; it goes on from its origin or from a stop that two patterns serve.  Each round keeps
    the best label of a request and stop, and only those go on that beat all with fewer rides, so rows are bounded by
    requests x stops.  Ties go to the lesser text of the legs.  skipped: further arrivals of runs (filled_stops).
    """
    found = vehicle_runs(events, max_gap_s)
    # Even places are events, odd ones what is filled in behind them; next_place is the first one that a traveller still passes.
    found = written(found.withColumns({"place": F.col("place") * 2, "next_place": F.col("next_place") * 2 - F.col("on_run").cast("long")}), "runs")
    slots = written(timetable(found, boardings, slot_s), "timetable")
    stops = found.where("on_run").select(*RIDE, "run", "place", "to_stop", "arr")
    if skipped is not None:
        stops = stops.unionByName(skipped.withColumn("place", F.col("place") * 2 + 1).select(*stops.columns))
    stops = written(stops.select(*RIDE, F.col("run").alias("next_run"), "place", F.col("to_stop").alias("__to"), F.col("arr").alias("__arr")), "stops")
    changes = written(change_stops(events), "changes")

    legs = F.array().cast("array<struct<pattern:string,ride:string,from_stop:bigint,to_stop:bigint,dep:bigint,arr:bigint>>")
    labels = requests.select("service_date", "origin", "requested", F.col("origin").alias("stop"), F.col("requested").cast("long").alias("at"), F.lit("").alias("path"), legs.alias("legs"))
    moving, best = written(labels, "labels"), None
    for ride in range(1, rides + 1):
        boarded = moving.withColumn("slot", F.floor(F.col("at") / slot_s).cast("long")).join(slots, ["service_date", "stop", "slot"])
        ahead = F.slice(F.concat(F.filter("now", lambda e: e["dep"] >= F.col("at")), F.col("later")), 1, boardings)
        boarded = boarded.withColumn("b", F.explode(ahead)).select("service_date", "origin", "requested", "stop", "path", "legs", "pattern", "b.*")
        own = boarded.select("*", F.col("to_stop").alias("__to"), F.col("arr").alias("__arr")).drop("next_run", "next_place")
        onward = boarded.where("next_run is not null").join(stops, [*RIDE, "next_run"]).where("place >= next_place").drop("next_run", "next_place", "place")
        leg = F.struct("pattern", "ride", F.col("stop").alias("from_stop"), F.col("__to").alias("to_stop"), "dep", F.col("__arr").alias("arr"))
        reached = own.unionByName(onward).where("__to <> origin").withColumn("__leg", leg)
        path = F.concat_ws(">", F.when(F.col("path") != "", F.col("path")), leg_text(F.col("__leg")))
        reached = reached.select("service_date", "origin", "requested", F.col("__to").alias("stop"), F.struct(F.col("__arr").alias("at"), path.alias("path"), F.array_append("legs", F.col("__leg")).alias("legs")).alias("b"))
        new = reached.groupBy(*LABEL).agg(F.min("b").alias("b")).select(*LABEL, "b.*", F.lit(ride).alias("rides"))
        if best is not None:
            known = best.groupBy(*LABEL).agg(F.min("at").alias("__known"))
            new = new.join(known, LABEL, "left").where("__known is null or at < __known").drop("__known")
        new = written(new, "labels")
        best = new if best is None else best.unionByName(new)
        moving = new.drop("rides").join(changes, ["service_date", "stop"], "left_semi")
        if moving.isEmpty():
            break
    return best


def earliest(journeys: DataFrame) -> DataFrame:
    """The journey that arrives first at each stop, of equals the one with fewer rides."""
    rest = [c for c in journeys.columns if c not in LABEL]
    return journeys.groupBy(*LABEL).agg(F.min(F.struct("at", "rides", *(c for c in rest if c not in ("at", "rides")))).alias("b")).select(*LABEL, "b.*")


def ride_fragments(journeys: DataFrame) -> DataFrame:
    """A row for each ride of each journey: its number, pattern, ride, stops, times, the wait before it and the seconds on board.  Legs of
    one ride in a row are one fragment."""
    rows = journeys.select(*LABEL, "rides", F.posexplode("legs").alias("leg", "x")).select(*LABEL, "rides", "leg", "x.*")
    w = Window.partitionBy(*LABEL, "rides").orderBy("leg")
    rows = rows.withColumn("__new", F.when(F.lag("ride").over(w) == F.col("ride"), 0).otherwise(1)).withColumn("fragment", F.sum("__new").over(w))
    first, last = F.min(F.struct("leg", "pattern", "from_stop", "dep")), F.max(F.struct("leg", "to_stop", "arr"))
    parts = rows.groupBy(*LABEL, "rides", "fragment").agg(first.alias("a"), last.alias("z"), F.min("ride").alias("ride"))
    ready = F.coalesce(F.lag("z.arr").over(Window.partitionBy(*LABEL, "rides").orderBy("fragment")), F.col("requested"))
    return parts.select(*LABEL, "rides", "fragment", "a.pattern", "ride", "a.from_stop", "z.to_stop", "a.dep", "z.arr", (F.col("a.dep") - ready).alias("wait_s"), (F.col("z.arr") - F.col("a.dep")).alias("ride_s"))


def request_counts(journeys: DataFrame, requests: DataFrame, stops: int) -> DataFrame:
    """For each day and request time: possible pairs, reached pairs, rides of the earliest journeys and their total seconds; zeros where nothing
    is reached."""
    best = earliest(journeys).groupBy("service_date", "requested").agg(F.count("*").alias("reached"), F.sum("rides").alias("rides"), F.sum(F.col("at") - F.col("requested")).alias("seconds"))
    asked = requests.groupBy("service_date", "requested").agg((F.count("*") * (stops - 1)).alias("possible"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return asked.join(best, ["service_date", "requested"], "left").select("service_date", "requested", "possible", zero("reached"), zero("rides"), zero("seconds"))
