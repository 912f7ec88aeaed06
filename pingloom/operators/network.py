"""Stops and roads as graphs: ride and walk edges, clusters, paths, earliest arrival, reachability."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import haversine_m, mercator_x, mercator_y
from ..functions.names import name_key
from .rounds import written
from .visits import geo_join


def cumulative(route_stops: DataFrame, route: str, order: str, step: str) -> DataFrame:
    w = Window.partitionBy(route).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return route_stops.withColumn("distance", F.sum(step).over(w))


#: Stops of a route that a task holds in memory while the later ones stream past, and pairs that are worth a task of their own.
RIDE_STOPS, RIDE_PAIRS = 4096, 1 << 22


def ride_edges(route_stops: DataFrame, route: str = "route", order: str = "stop_order", stop: str = "stop_id") -> DataFrame:
    """All ordered pairs of stops on a route, with the way between them.

    The pairs are the square of a route's stops, so a route is dealt to many tasks: each holds a block of its stops, which meet the ones behind them.
    """
    sizes = route_stops.where(F.col(route).isNotNull()).groupBy(route).agg(F.count("*").alias("n"))
    row = sizes.agg(F.sum(F.ceil(F.col("n") / RIDE_STOPS)).alias("blocks"), F.sum(F.col("n").cast("double") * F.col("n") / 2).alias("pairs")).first()
    parts = max(1, min(row["blocks"] or 0, int(row["pairs"] or 0) // RIDE_PAIRS + 1))
    place = F.row_number().over(Window.partitionBy(route).orderBy(order))
    placed = route_stops.select(route, order, stop, "distance").withColumn("__k", F.floor((place - 1) / RIDE_STOPS).cast("int"))
    a = placed.select(route, "__k", F.col(order).alias("a_o"), F.col(stop).alias("from_stop"), F.col("distance").alias("a_d"))
    b = placed.select(route, F.explode(F.sequence(F.lit(0), "__k")).alias("__k"), F.col(order).alias("b_o"), F.col(stop).alias("to_stop"), F.col("distance").alias("b_d"))
    pairs = b.repartition(parts, route, "__k").join(a.repartition(parts, route, "__k").hint("merge"), [route, "__k"]).where("a_o < b_o")
    return pairs.select(route, "from_stop", "to_stop", (F.col("b_d") - F.col("a_d")).alias("meters"))


def walk_edges(stops: DataFrame, radius_m: float = 300.0) -> DataFrame:
    points = stops.select(F.col("stop_id").alias("from_stop"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))
    return geo_join(points, stops.select("stop_id", "stop_lat", "stop_lon"), radius_m).where("from_stop <> stop_id").select("from_stop", F.col("stop_id").alias("to_stop"), "distance_m")


def connected(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, label: the least node that each reaches.  edges: a, b; nodes: node.

    Each round a node takes the least label around it and then that label's own label, so a chain of n takes about
    log n rounds; they end when no label moves.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), "edges")
    now = written(nodes.select("node", F.col("node").alias("label")).distinct(), "labels")
    while True:
        near = both.join(now.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("label").alias("near"))
        step = now.join(near.withColumnRenamed("a", "node"), "node", "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = now.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = written(step.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")), "labels")
        now = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return now


def named_clusters(stops: DataFrame, radius_m: float = 180.0) -> DataFrame:
    """stop_id, label: stops of one name (case and outer spaces aside) within the radius of each other, as components."""
    named = stops.select("stop_id", "stop_lat", "stop_lon", name_key(F.col("stop_name")).alias("name"))
    # Stops of one name at one spot are one node, called by the least of them; else a spot's stops make the square of their number.
    spot = ["name", "stop_lat", "stop_lon"]
    spots = written(named.dropna(subset=spot).groupBy(*spot).agg(F.min("stop_id").alias("spot")), "spots")
    points = spots.select(F.col("spot").alias("a"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"), "name")
    near = geo_join(points, spots, radius_m, on=("name",)).select("a", F.col("spot").alias("b"))
    # A stop that is at several spots joins them.
    members = written(named.join(spots, spot, "left").select("stop_id", "spot").distinct(), "members")
    several = members.groupBy("stop_id").agg(F.min("spot").alias("a"), F.max("spot").alias("z")).where("a < z").select("stop_id", "a")
    joined = members.join(several, "stop_id").select("a", F.col("spot").alias("b")).where("b is not null")
    labels = connected(near.unionByName(joined), spots.select(F.col("spot").alias("node")))
    found = members.join(labels, F.col("spot") == F.col("node"), "left")
    return found.groupBy("stop_id").agg(F.min(F.coalesce("label", "stop_id")).alias("label"))


def next_departure(requests: DataFrame, trips: DataFrame, keys: list[str]) -> DataFrame:
    """As-of join: the first departure at or after each request.  Both sides are sorted once by key and time."""
    asked = requests.select(*keys, F.col("at").alias("__t"), F.lit(1).alias("__ask"), F.lit(None).cast("long").alias("__dep"))
    there = trips.select(*keys, F.col("dep").alias("__t"), F.lit(0).alias("__ask"), F.col("dep").cast("long").alias("__dep"))
    later = Window.partitionBy(*keys).orderBy(F.desc("__t"), "__ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = asked.unionByName(there).withColumn("dep", F.min("__dep").over(later)).where("__ask = 1 and dep is not null")
    return found.select(*keys, F.col("__t").alias("at"), "dep").distinct()


#: A label of k_paths: a path from an origin, its walked metres by hop (null: a ride), its length and rides.
_LABEL = "origin long, stop long, path array<long>, meters_walked array<double>, meters double, rides int"


class Kept:
    """Labels of one origin, stop and number of rides, offered best first as sets of stops, that may begin one of the `most` best loop-free
    paths to anywhere.

    A label can go if, whatever `ahead` further stops its path takes, `most` better labels could take the same ones.  Better labels that hold
    one of these stops can't, so as many are set aside as hold the `ahead` commonest stops that this label itself doesn't hold.
    """

    def __init__(self, most: int, ahead: int):
        self.most, self.ahead, self.n, self.counts = most, ahead, 0, {}

    def take(self, stops) -> bool:
        if self.n >= self.most:
            blocked = sum(sorted((n for stop, n in self.counts.items() if stop not in stops), reverse=True)[: self.ahead])
            if self.n - blocked >= self.most:
                return False
        self.n += 1
        for stop in stops:
            self.counts[stop] = self.counts.get(stop, 0) + 1
        return True


def undominated(labels: list, most: int, ahead: int) -> list[int]:
    """Numbers of the labels that stay, of some in their order."""
    kept = Kept(most, ahead)
    return [k for k, stops in enumerate(labels) if kept.take(stops)]


def _best_labels(paths: DataFrame, most: int, ahead: int) -> DataFrame:
    """The labels of each origin, stop and number of rides that can still lead to a path among the best.  Labels stream through in order, so a task holds
    the counts of one group, however many labels it has."""
    group = ["origin", "stop", "rides", "__walked"]

    def prune(frames):
        now, kept = None, None
        for frame in frames:
            chosen = []
            for key, path in zip(zip(*(frame[c].tolist() for c in group), strict=True), frame["path"], strict=True):
                if key != now:
                    now, kept = key, Kept(most, ahead)
                chosen.append(kept.take(frozenset(path)))
            yield frame[chosen].drop(columns=["__order", "__walked"])

    # A longer path's text begins with this one's and the separator, so that equals keep their order as paths grow.
    order = F.concat(F.array_join("path", ">"), F.lit("> "), F.array_join(F.transform("meters_walked", lambda m: m.isNotNull().cast("string")), ","))
    walked = F.coalesce(F.element_at("meters_walked", -1).isNotNull(), F.lit(False))
    marked = paths.withColumns({"__order": order, "__walked": walked})
    return marked.repartition(*group).sortWithinPartitions(*group, "meters", "__order").mapInPandas(prune, _LABEL)


def k_paths(edges: DataFrame, origins: DataFrame, max_rides: int = 3, per_destination: int = 8, ratio: float = 1.5, walks: DataFrame | None = None, clusters: DataFrame | None = None) -> DataFrame:
    """Loop-free alternatives by rides, length and signature, at most `per_destination` each and within `ratio` of the shortest.

    edges and walks: from_stop, to_stop, meters.  After each ride a path may go on by one walk; a walk is no ride.  clusters: the same columns, ways between stops
    that count as one place; a path to one of them is also one to the other.  meters_walked has the metres of each hop that is a walk, and null for a ride.

    After each hop an origin's labels at a stop are cut to those that no `per_destination` better ones can stand for in every
    longer path (undominated), so a round's rows are bounded by what is kept, not by the number of prefixes; the result is that of all loop-free paths.
    """
    # Both are read in every round, and what they come from once.
    edges = written(edges.select("from_stop", "to_stop", F.col("meters").cast("double").alias("meters")), "edges")
    start = written(origins.select("origin"), "origins").select(F.col("origin").cast("long").alias("origin"), F.col("origin").cast("long").alias("stop"), F.array(F.col("origin").cast("long")).alias("path"), F.array().cast("array<double>").alias("meters_walked"), F.lit(0.0).alias("meters"), F.lit(0).alias("rides"))

    def hop(paths: DataFrame, by: DataFrame, ride: int) -> DataFrame:
        there = by.select(F.col("from_stop").cast("long").alias("__from"), F.col("to_stop").cast("long").alias("__to"), F.col("meters").cast("double").alias("__m"))
        step = paths.join(there, F.col("stop") == F.col("__from")).where(~F.array_contains("path", F.col("__to")))
        walked = F.lit(None).cast("double") if ride else F.col("__m")
        return step.select(
            "origin",
            F.col("__to").alias("stop"),
            F.array_append("path", F.col("__to")).alias("path"),
            F.array_append("meters_walked", walked).alias("meters_walked"),
            (F.col("meters") + F.col("__m")).alias("meters"),
            (F.col("rides") + ride).alias("rides"),
        )

    hops = 1 if walks is None else 2
    last = 0 if clusters is None else 1
    signature = F.struct(F.array_join("path", ">"), F.transform("meters_walked", lambda m: m.isNotNull()))
    paths, found = start, None
    for ride in range(1, max_rides + 1):
        left = (max_rides - ride) * hops + last
        paths = written(_best_labels(hop(paths, edges, 1), per_destination, left + hops - 1), "paths")
        if walks is not None:
            paths = paths.unionByName(written(_best_labels(hop(paths, walks, 0), per_destination, left), "paths"))
        found = paths if found is None else found.unionByName(paths)
    if clusters is not None:
        found = written(found, "paths")
        found = found.unionByName(hop(found, clusters, 0))
    by = Window.partitionBy("origin", "stop")
    ranked = found.withColumn("least", F.min("meters").over(by)).where(F.col("meters") <= F.col("least") * ratio)
    return ranked.withColumn("n", F.row_number().over(by.orderBy("rides", "meters", signature))).where(F.col("n") <= per_destination).drop("least")


#: Steps along roads that a task makes at once.
STEPS = 1 << 19
#: Nodes on one other that a task holds in memory while walks to that one stream past, and walks to them that it makes.
HUNG, WALKS = 4096, 1 << 24


def road_walks(roads: DataFrame, stops: DataFrame, max_m: float = 2000.0) -> DataFrame:
    """Walking metres from each stop along roads to every node within max_m.  roads: a, b, meters; stops: stop, node.

    A node with one neighbour hangs on it: no way leads through it, so ways are searched between the other nodes only, from each at which a stop is, once.
    Walks to and from what hangs there, which can be the square of a busy node's, follow from these, and are made last and not moved again.
    """
    both = roads.select("a", "b", "meters").unionByName(roads.select(F.col("b").alias("a"), F.col("a").alias("b"), "meters")).where("a <> b")
    both = written(both.groupBy("a", "b").agg(F.min("meters").alias("step")), "roads")
    degree = both.groupBy("a").agg(F.count("*").alias("degree"))
    alone, joint = degree.where("degree = 1").select("a"), degree.where("degree > 1").select(F.col("a").alias("b"))
    hung = written(both.join(alone, "a", "left_semi").join(joint, "b", "left_semi").select(F.col("a").alias("hung"), F.col("b").alias("place"), F.col("step").alias("way")), "hung")
    inner = both.join(hung.select(F.col("hung").alias("a")), "a", "left_anti").join(hung.select(F.col("hung").alias("b")), "b", "left_anti")
    starts = stops.select("stop", F.col("node").alias("origin")).distinct().withColumn("several", F.count("*").over(Window.partitionBy("stop")) > 1)
    starts = starts.join(hung, F.col("origin") == F.col("hung"), "left").select("stop", "origin", "several", F.coalesce("place", "origin").alias("home"), F.coalesce("way", F.lit(0.0)).alias("off"))
    starts = written(starts, "starts")
    home = starts.select(F.col("home").alias("stop"), F.col("home").alias("node")).dropna().distinct()
    between = _walks_between(written(inner, "roads"), home, max_m).select(F.col("stop").alias("home"), F.col("node").alias("place"), F.col("meters").alias("inner"))
    there = (F.col("off") + F.col("inner")).alias("meters")
    reached = written(starts.join(between, "home").where(F.col("off") + F.col("inner") <= max_m).select("stop", "origin", "several", "place", there), "reached")
    # Walks from a place to what hangs on it are dealt out both ways: a task holds some of the nodes and makes about WALKS walks to them.
    load = reached.groupBy("place").agg(F.count("*").alias("asks")).join(hung.groupBy("place").agg(F.count("*").alias("ends")), "place")
    load = load.select("place", (F.col("asks") * F.col("ends")).alias("walks"), F.ceil(F.col("ends") / HUNG).cast("int").alias("blocks"), F.ceil(F.col("asks") * F.least("ends", F.lit(HUNG)) / WALKS).cast("int").alias("deals"))
    load = written(load, "load")
    row = load.agg(F.sum(F.col("blocks") * F.col("deals")).alias("tasks"), F.sum("walks").alias("walks")).first()
    parts = max(1, min(row["tasks"] or 0, (row["walks"] or 0) // (WALKS // 4) + 1))
    numbers = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    dealt = lambda key, c: F.pmod(F.xxhash64(key), F.col(c)).cast("int")
    asked = reached.join(load, "place").select("stop", "origin", "several", "place", "meters", dealt("stop", "deals").alias("deal"), numbers("blocks").alias("block"))
    ends = hung.join(load, "place").select("place", "hung", "way", dealt("hung", "blocks").alias("block"), numbers("deals").alias("deal"))
    keys = ["place", "block", "deal"]
    out = asked.repartition(parts, *keys).join(ends.repartition(parts, *keys).hint("merge"), keys).select("stop", "origin", "several", F.col("hung").alias("node"), (F.col("meters") + F.col("way")).alias("meters")).where(F.col("meters") <= max_m)
    found = reached.select("stop", "origin", "several", F.col("place").alias("node"), "meters").unionByName(out).where("node <> origin")
    found = found.unionByName(starts.select("stop", "origin", "several", F.col("origin").alias("node"), F.lit(0.0).alias("meters")))
    walk = ["stop", "node", "meters"]
    once = found.where("not several").select(*walk)
    if starts.where("several").isEmpty():
        return once
    # Only a stop at several nodes has several walks to one.
    return once.unionByName(found.where("several").groupBy("stop", "node").agg(F.min("meters").alias("meters")).select(*walk))


def _walks_between(both: DataFrame, stops: DataFrame, max_m: float) -> DataFrame:
    """stop, node, meters, along both ways of roads: a, b, step.

    Rounds of joins: a round goes on only from nodes whose way the last one made shorter, until there are none.  Nothing
    is collected or broadcast, whatever the size of the road graph.
    """
    degree = written(both.groupBy("a").agg(F.count("*").alias("degree")), "degrees")
    best = moved = written(stops.select("stop", "node", F.lit(0.0).alias("meters")).distinct(), "walks")
    while not moved.isEmpty():
        # Steps from each node are known before they are made: a busy node is dealt out by stop, and tasks get about STEPS of them.
        load = moved.groupBy("node").agg(F.count("*").alias("n")).join(degree, F.col("node") == F.col("a")).select("a", (F.col("n") * F.col("degree")).alias("steps"))
        load = written(load.withColumn("deals", F.ceil(F.col("steps") / STEPS).cast("int")), "load")
        parts = ((load.agg(F.sum("steps")).first()[0] or 0) + best.count()) // STEPS + 1
        deals = load.select("a", "deals")
        asked = moved.join(deals, F.col("node") == F.col("a")).select("stop", "a", "meters", F.pmod(F.xxhash64("stop"), "deals").cast("int").alias("deal"))
        there = both.join(deals, "a").select("a", "b", "step", F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal"))
        step = asked.repartition(parts, "a", "deal").join(there.hint("merge"), ["a", "deal"]).select("stop", F.col("b").alias("node"), (F.col("meters") + F.col("step")).alias("meters")).where(F.col("meters") <= max_m)
        rows = best.withColumn("was", F.col("meters")).unionByName(step.withColumn("was", F.lit(None).cast("double")))
        new = written(rows.repartition(parts, "stop", "node").groupBy("stop", "node").agg(F.min("meters").alias("meters"), F.min("was").alias("was")), "walks")
        best, moved = new.drop("was"), new.where("was is null or meters < was").drop("was")
    return best


def road_pieces(ways: DataFrame, piece_m: float = 100.0) -> DataFrame:
    """Ways (way, a_lat, a_lon, b_lat, b_lon) cut into equal pieces of at most piece_m; place counts them from the start."""
    length = haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    cut = ways.withColumn("pieces", F.greatest(F.lit(1), F.ceil(length / piece_m)).cast("int"))
    cut = cut.withColumn("place", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    middle = lambda c: F.col(f"a_{c}") + (F.col(f"b_{c}") - F.col(f"a_{c}")) * (F.col("place") + 0.5) / F.col("pieces")
    return cut.select("way", "place", middle("lat").alias("lat"), middle("lon").alias("lon"))


def connectors(stops: DataFrame, nodes: DataFrame, radius_m: float = 180.0, least: int = 3, widest_m: float = 2000.0) -> DataFrame:
    """stop_id, node, distance_m: road nodes within radius_m of a stop, or the `least` nearest within widest_m where there are none."""
    points = stops.select("stop_id", F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))
    ends = nodes.select("node", F.col("lat").alias("stop_lat"), F.col("lon").alias("stop_lon"))
    near = geo_join(points, ends, radius_m).select("stop_id", "node", "distance_m")
    alone = points.join(near.select("stop_id").distinct(), "stop_id", "left_anti")
    far = geo_join(alone, ends, widest_m).select("stop_id", "node", "distance_m")
    place = F.row_number().over(Window.partitionBy("stop_id").orderBy("distance_m", "node"))
    return near.unionByName(far.withColumn("n", place).where(F.col("n") <= least).drop("n"))


def access(walks: DataFrame, arrivals: DataFrame, mps: float = 1.3) -> DataFrame:
    """For each place the least of arrival plus walk, and the nearest stop.  walks: place, stop, meters; arrivals: stop, at."""
    total = F.col("at") + F.ceil(F.col("meters") / mps)
    return walks.join(arrivals, "stop").groupBy("place").agg(F.min(F.struct(total.alias("t"), F.col("stop"))).alias("b"), F.min(F.struct("meters", "stop")).alias("n")).select("place", F.col("b.t").alias("best_at"), F.col("b.stop").alias("best_stop"), F.col("n.stop").alias("nearest_stop"))


def dilate(cells: DataFrame, reach: int) -> DataFrame:
    """Cells within `reach` of a cell (a disc)."""
    spread = F.sequence(F.lit(-reach), F.lit(reach))
    near = cells.withColumn("dx", F.explode(spread)).withColumn("dy", F.explode(spread)).where(f"dx * dx + dy * dy <= {reach * reach}")
    return near.select((F.col("x") + F.col("dx")).alias("x"), (F.col("y") + F.col("dy")).alias("y")).distinct()


def hull_area(points: list[tuple[float, float]]) -> float:
    """The area of the convex hull (monotone chain and shoelace)."""
    def half(ps):
        out: list = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    ordered = sorted(set(points))
    ring = half(ordered) + half(ordered[::-1])
    return abs(sum(a[0] * b[1] - a[1] * b[0] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2 if len(ring) > 2 else 0.0


def contour_areas(cells: DataFrame, group: str = "component", size: float = 1.0) -> DataFrame:
    """Convex hull area of each group of cells (their corners count).  A row's extremes are enough for the hull, so that a
    task gets two cells for each row of the raster."""
    edge = cells.groupBy(group, "y").agg(F.min("x").alias("a"), F.max("x").alias("b"))

    def area(pdf: pd.DataFrame) -> pd.DataFrame:
        corners = [(x, y + k) for a, b, y in zip(pdf["a"], pdf["b"], pdf["y"], strict=True) for x in (a, b + 1) for k in (0, 1)]
        return pd.DataFrame({group: [pdf[group].iloc[0]], "area": [hull_area([(float(x), float(y)) for x, y in corners]) * size * size]})

    return edge.groupBy(group).applyInPandas(area, f"{group} long, area double")


def grid_components(cells: DataFrame) -> DataFrame:
    """cells (x, y) with their component: cells that touch, corners included.  A component is named by its least cell's number."""
    number = lambda x, y: x.cast("long") * (1 << 31) + y.cast("long")
    placed = cells.select("x", "y").distinct()
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1) if (i, j) > (0, 0))))
    near = placed.withColumn("o", around).select(number(F.col("x"), F.col("y")).alias("a"), (F.col("x") + F.col("o.i")).alias("x"), (F.col("y") + F.col("o.j")).alias("y"))
    edges = near.join(placed, ["x", "y"]).select("a", number(F.col("x"), F.col("y")).alias("b"))
    labels = connected(edges, placed.select(number(F.col("x"), F.col("y")).alias("node")))
    named = placed.withColumn("node", number(F.col("x"), F.col("y")))
    return named.join(labels, "node").select("x", "y", F.col("label").alias("component"))


def contours(cells: DataFrame, thresholds: tuple[int, ...] = (15, 30, 60), size: float = 1.0) -> DataFrame:
    """For each threshold of minutes: cells reached in time, their households, components, and the sum of the components' hull areas.

    cells: x, y, minutes, households.
    """
    out = None
    for limit in thresholds:
        within = cells.where(F.col("minutes") <= limit)
        parts = grid_components(within)
        areas = contour_areas(parts, size=size).agg(F.count("*").alias("components"), F.coalesce(F.sum("area"), F.lit(0.0)).alias("area"))
        total = within.agg(F.count("*").alias("cells"), F.coalesce(F.sum("households"), F.lit(0)).cast("long").alias("households"))
        row = total.join(F.broadcast(areas)).select(F.lit(limit).alias("minutes"), "cells", "households", "components", "area")
        out = row if out is None else out.unionByName(row)
    return out


def tile_pixels(points: DataFrame, zoom: int, measures: dict[str, Column], pixel: int = 1) -> DataFrame:
    """A map layer as rows: tile (z, x, y), pixel in the tile (px, py) and its measures.  points: lat, lon."""
    z = F.lit(zoom)
    at = points.withColumns({"__x": F.floor(mercator_x(F.col("lon"), z) / pixel).cast("long"), "__y": F.floor(mercator_y(F.col("lat"), z) / pixel).cast("long")})
    side = 256 // pixel
    tile = lambda c: F.floor(F.col(c) / side).cast("long")
    keys = [z.alias("z"), tile("__x").alias("x"), tile("__y").alias("y"), (F.col("__x") % side).alias("px"), (F.col("__y") % side).alias("py")]
    return at.groupBy(*keys).agg(*(m.alias(n) for n, m in measures.items()))


def colour_scale(values: DataFrame, column: str = "value", share: float = 0.9) -> DataFrame:
    """The value below which `share` of the rows lie, without interpolation (the lower of two), and both ends."""
    place = F.expr(f"percentile_disc({share}) within group (order by {column})")
    return values.agg(F.min(column).alias("least"), place.alias("top"), F.max(column).alias("most"))


def write_graph(paths: DataFrame, path: str, parts: int = 64) -> None:
    """Paths stored by a hash of their origin, so that a request for a few origins reads a few folders."""
    rows = paths.withColumn("origin_part", F.pmod(F.xxhash64("origin"), F.lit(parts)).cast("int"))
    rows.repartition(parts, "origin_part").sortWithinPartitions("origin", "stop").write.mode("overwrite").partitionBy("origin_part").parquet(path)


def read_graph(graph: DataFrame, origins: DataFrame, parts: int = 64) -> DataFrame:
    """The paths of some origins; only their parts are scanned, told at run time by the origins' table."""
    wanted = origins.select("origin", F.pmod(F.xxhash64("origin"), F.lit(parts)).cast("int").alias("origin_part")).distinct()
    return graph.join(wanted, ["origin_part", "origin"], "left_semi").drop("origin_part")
