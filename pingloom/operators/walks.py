"""Walks along roads from many stops: the road graph is cut into tiles with a halo, and each tile searches its own stops."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import DEGREE_M, haversine_m, plane_cell
from .rounds import written

#: Stops that one task searches from.
STOPS = 500


def _around(lat: Column, lon: Column, tile_m: float, reach_m: float) -> Column:
    """The tiles within reach of a point, as an array of (x, y)."""
    ends = []
    for degrees, metre in ((lat, 1.0), (lon, F.cos(F.radians(lat)))):
        off = F.lit(reach_m * 1.01 / DEGREE_M) / metre
        ends.append((degrees - off, degrees + off))
    (south, north), (west, east) = ends
    low_x, low_y = plane_cell(south, west, tile_m)
    high_x, high_y = plane_cell(north, east, tile_m)
    return F.flatten(F.transform(F.sequence(low_x, high_x), lambda x: F.transform(F.sequence(low_y, high_y), lambda y: F.struct(x.alias("x"), y.alias("y")))))


def nearest_by_road(heads: np.ndarray, ends: np.ndarray, metres: np.ndarray, starts: list[tuple[int, float]], most: float) -> dict[int, float]:
    """Least metres to each node within `most`, over edges in compressed rows: node n's are heads[n] to heads[n + 1]."""
    best: dict[int, float] = {}
    todo = [(m, n) for n, m in starts if m <= most]
    heapq.heapify(todo)
    while todo:
        at, node = heapq.heappop(todo)
        if node in best:
            continue
        best[node] = at
        for k in range(heads[node], heads[node + 1]):
            if (to := at + metres[k]) <= most and ends[k] not in best:
                heapq.heappush(todo, (to, int(ends[k])))
    return best


def tiled_walks(roads: DataFrame, stops: DataFrame, connectors: DataFrame, max_m: float = 2000.0, tile_m: float = 4000.0) -> DataFrame:
    """stop, node and metres of all nodes within max_m of each stop along roads, by way of the stop's connectors.

    roads: a, b, a_lat, a_lon, b_lat, b_lon, metres (no shorter than the straight line; both ways); stops: stop, lat, lon; connectors: stop, node, metres.  A stop
    lies in one tile, a road in every tile from which it can be reached, so no search leaves its tile and the number of jobs doesn't
    depend on how many roads a walk takes.  A tile of very many stops is dealt to several tasks.
    """
    x, y = plane_cell(F.col("lat"), F.col("lon"), tile_m)
    placed = written(stops.select("stop", x.alias("x"), y.alias("y")), "placed")
    shares = placed.groupBy("x", "y").agg(F.ceil(F.count("*") / STOPS).cast("int").alias("n")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    shares = written(shares, "shares")
    mine = F.pmod(F.xxhash64("stop"), F.col("n")).cast("int")
    starts = connectors.join(placed, "stop").join(shares.select("x", "y", "n").distinct(), ["x", "y"]).select("x", "y", mine.alias("part"), "stop", "node", F.col("metres").cast("double").alias("metres"))
    ends = F.array_union(_around(F.col("a_lat"), F.col("a_lon"), tile_m, max_m), _around(F.col("b_lat"), F.col("b_lon"), tile_m, max_m))
    near = roads.withColumn("t", F.explode(ends)).select("t.x", "t.y", "a", "b", F.col("metres").cast("double").alias("metres")).distinct()
    near = near.join(shares.select("x", "y", "part"), ["x", "y"])

    def search(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        nodes = np.unique(np.concatenate([there["a"].to_numpy(np.int64), there["b"].to_numpy(np.int64), asked["node"].to_numpy(np.int64)]))
        a, b = np.searchsorted(nodes, there["a"]), np.searchsorted(nodes, there["b"])
        frm, to, metres = np.concatenate([a, b]), np.concatenate([b, a]), np.tile(there["metres"].to_numpy(), 2)
        order = np.argsort(frm, kind="stable")
        heads = np.searchsorted(frm[order], np.arange(len(nodes) + 1)).tolist()
        to, metres = to[order].tolist(), metres[order].tolist()
        out = []
        for stop, rows in asked.groupby("stop"):
            found = nearest_by_road(heads, to, metres, [*zip(np.searchsorted(nodes, rows["node"]).tolist(), rows["metres"].tolist(), strict=True)], max_m)
            out.append(pd.DataFrame({"stop": stop, "node": nodes[list(found)], "metres": list(found.values())}))
        return pd.concat(out) if out else pd.DataFrame({"stop": [], "node": [], "metres": []})

    keys = ["x", "y", "part"]
    return starts.groupBy(*keys).cogroup(near.groupBy(*keys)).applyInPandas(search, "stop long, node long, metres double")


def walk_candidates(walks: DataFrame, pieces: DataFrame, max_m: float = 2000.0) -> DataFrame:
    """piece, stop and metres from the stop to the piece's middle, by whichever end is nearer: the table that every snapshot joins arrivals to.

    pieces: piece, a, b (nodes), to_a and to_b (metres from the middle to them).
    """
    ends = pieces.select("piece", F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("to_a").alias("m")), F.struct(F.col("b").alias("node"), F.col("to_b").alias("m")))).alias("e")).select("piece", "e.*")
    total = F.col("metres") + F.col("m")
    return walks.join(ends, "node").where(total <= max_m).groupBy("piece", "stop").agg(F.min(total).alias("metres"))


def cut_roads(roads: DataFrame, piece_m: float = 20.0) -> DataFrame:
    """piece (road, its place), nodes and metres to them, and the piece's ends and length.  roads: road, a, b, a_lat, a_lon, b_lat, b_lon."""
    straight = haversine_m(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    cut = roads.withColumn("__d", straight).withColumn("__n", F.greatest(F.lit(1), F.ceil(F.col("__d") / piece_m)).cast("int")).withColumn("place", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    at = lambda c, off: F.col(f"a_{c}") + (F.col(f"b_{c}") - F.col(f"a_{c}")) * ((F.col("place") + off) / F.col("__n"))
    middle = (F.col("place") + 0.5) / F.col("__n") * F.col("__d")
    return cut.select(F.struct("road", "place").alias("piece"), "a", "b", middle.alias("to_a"), (F.col("__d") - middle).alias("to_b"), *(at(c, off).alias(f"{e}_{c}") for e, off in (("a", 0), ("b", 1)) for c in ("lat", "lon")), (F.col("__d") / F.col("__n")).alias("metres"))


def best_and_nearest(candidates: DataFrame, arrivals: DataFrame, mps: float = 1.3) -> DataFrame:
    """For each piece the stop from which it is reached first (of equals the least id), with seconds, and the stop that is nearest.

    arrivals: stop, seconds (of the ride).
    """
    total = F.col("seconds") + F.ceil(F.col("metres") / mps)
    found = candidates.join(arrivals, "stop").groupBy("piece").agg(F.min(F.struct(total.alias("t"), F.col("stop"), F.col("metres"))).alias("b"), F.min(F.struct("metres", "stop", "seconds")).alias("n"))
    return found.select("piece", F.col("b.t").cast("long").alias("seconds"), F.col("b.stop").alias("stop"), F.col("b.metres").alias("walk_m"), F.col("n.stop").alias("nearest_stop"), F.col("n.metres").alias("nearest_m"), F.col("n.seconds").alias("nearest_seconds"))
