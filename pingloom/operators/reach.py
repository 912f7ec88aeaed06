"""From minutes along roads to areas and map layers: discs of cells, components, polygons with households, and lines drawn to pixels."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import DEGREE_M, PLANE_LATITUDE, mercator_x, mercator_y, plane_cell
from .network import connected
from .rounds import written

THRESHOLDS = (15, 30, 60)
_HALF = 1 << 24


def reached_cells(segments: DataFrame, cell_m: float = 25.0, reach_m: float = 250.0, latitude: float = PLANE_LATITUDE) -> DataFrame:
    """x, y and the least minutes of all cells whose middle one lies within reach of a segment.

    segments: a_lat, a_lon, b_lat, b_lon, metres, minutes.  A segment is sampled a cell apart; samples of one cell meet before the discs are
    laid, and the least minutes of a disc serve all thresholds at once.
    """
    steps = F.greatest(F.lit(1), F.ceil(F.col("metres") / cell_m)).cast("int")
    points = segments.withColumn("__n", steps).withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__n"))))
    along = lambda c: F.col(f"a_{c}") + (F.col(f"b_{c}") - F.col(f"a_{c}")) * (F.col("__k") / F.col("__n"))
    x, y = plane_cell(along("lat"), along("lon"), cell_m, latitude)
    middles = points.select(x.alias("x"), y.alias("y"), "minutes").groupBy("x", "y").agg(F.min("minutes").alias("minutes"))
    radius = max(0, math.ceil(reach_m / cell_m))
    disc = [F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1) if math.hypot(i, j) <= radius + 0.25]
    spread = middles.withColumn("o", F.explode(F.array(*disc)))
    return spread.groupBy((F.col("x") + F.col("o.i")).alias("x"), (F.col("y") + F.col("o.j")).alias("y")).agg(F.min("minutes").alias("minutes"))


def threshold_components(cells: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """threshold, x, y and component of the cells within each threshold; cells touch at sides and corners.  All thresholds are labelled together."""
    limits = F.filter(F.array(*map(F.lit, range(len(thresholds)))), lambda k: F.get(F.array(*map(F.lit, thresholds)), k) >= F.col("minutes"))
    within = written(cells.withColumn("k", F.explode(limits)).select("k", "x", "y"), "within")
    name = lambda x, y: F.col("k").cast("long") * (1 << 50) + (x + _HALF) * (1 << 25) + (y + _HALF)
    around = F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 1), (1, -1), (1, 0), (1, 1)))))
    here = within.withColumn("node", name(F.col("x"), F.col("y")))
    near = here.withColumn("o", around).select(F.col("node").alias("a"), name(F.col("x") + F.col("o.i"), F.col("y") + F.col("o.j")).alias("node"))
    edges = near.join(here.select("node"), "node").select("a", F.col("node").alias("b"))
    labels = connected(edges, here.select("node"))
    return here.join(labels, "node").select(F.get(F.array(*map(F.lit, thresholds)), F.col("k")).alias("threshold"), "x", "y", F.col("label").alias("component"))


def hull(points: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The corners of the convex hull, counter-clockwise from the least; points on its sides are left out."""

    def half(ps):
        out: list = []
        for p in ps:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) <= (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]):
                out.pop()
            out.append(p)
        return out[:-1]

    ordered = sorted(set(points))
    return half(ordered) + half(ordered[::-1])


def polygons(parts: DataFrame, cell_m: float = 25.0, latitude: float = PLANE_LATITUDE) -> DataFrame:
    """threshold, component, cells, area_m2 and ring (corners as x and y of cells, and as lat and lon) of each component's convex hull.

    A row of cells gives its two ends, so a task gets two numbers for each row of a component.
    """
    rows = parts.groupBy("threshold", "component", "y").agg(F.min("x").alias("a"), F.max("x").alias("b"), F.count("*").alias("n"))
    wide = math.cos(math.radians(latitude))
    kind = "threshold int, component long, cells long, area_m2 double, xs array<long>, ys array<long>, lats array<double>, lons array<double>"

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        corners = [(int(x), int(y) + k) for a, b, y in zip(frame["a"], frame["b"], frame["y"], strict=True) for x in (a, b + 1) for k in (0, 1)]
        ring = hull(corners)
        twice = sum(p[0] * q[1] - q[0] * p[1] for p, q in zip(ring, ring[1:] + ring[:1], strict=True))
        xs, ys = [x for x, _ in ring], [y for _, y in ring]
        row = {"threshold": frame["threshold"].iloc[0], "component": frame["component"].iloc[0], "cells": int(frame["n"].sum()), "area_m2": abs(twice) / 2 * cell_m * cell_m}
        return pd.DataFrame([row | {"xs": xs, "ys": ys, "lats": [y * cell_m / DEGREE_M for y in ys], "lons": [x * cell_m / (DEGREE_M * wide) for x in xs]}])

    return rows.groupBy("threshold", "component").applyInPandas(one, kind)


def reach_totals(cells: DataFrame, shapes: DataFrame, households: DataFrame, thresholds: tuple[int, ...] = THRESHOLDS) -> DataFrame:
    """threshold, cells, households, polygons and area_km2.  households: x, y, households on the same cells; a threshold that nothing lies within has zeros."""
    spark = cells.sparkSession
    every = spark.createDataFrame([(t,) for t in thresholds], "threshold int")
    within = cells.join(households, ["x", "y"], "left").withColumn("threshold", F.explode(F.filter(F.array(*map(F.lit, thresholds)), lambda t: t >= F.col("minutes"))))
    people = within.groupBy("threshold").agg(F.count("*").alias("cells"), F.coalesce(F.sum("households"), F.lit(0)).alias("households"))
    areas = shapes.groupBy("threshold").agg(F.count("*").alias("polygons"), (F.sum("area_m2") / 1e6).alias("area_km2"))
    zero = lambda c, kind="long": F.coalesce(c, F.lit(0)).cast(kind).alias(c)
    return every.join(people, "threshold", "left").join(areas, "threshold", "left").select("threshold", zero("cells"), zero("households"), zero("polygons"), zero("area_km2", "double"))


def line_pixels(segments: DataFrame, widths: dict[int, float], value: str = "minutes", tile: int = 256) -> DataFrame:
    """A layer of lines as rows: z, tile x and y, pixel px and py, and the least value of the lines that cover it.

    segments: a_lat, a_lon, b_lat, b_lon and the value.  A pixel is covered if its middle lies within half the zoom's width of the line.  Each line becomes rows of
    pixels by the ends of its outline there, so long slanted lines don't fill their bounding boxes; tiles come from the pixels.
    """
    pairs = F.explode(F.array(*(F.struct(F.lit(z).alias("z"), F.lit(float(w) / 2).alias("r")) for z, w in widths.items())))
    rows = segments.withColumn("w", pairs).select(value, F.col("w.z").alias("z"), F.col("w.r").alias("r"), *(F.col(f"{e}_{c}") for e in "ab" for c in ("lat", "lon")))
    for e in "ab":
        rows = rows.withColumns({f"{e}x": mercator_x(F.col(f"{e}_lon"), F.col("z")), f"{e}y": mercator_y(F.col(f"{e}_lat"), F.col("z"))})
    first, last = F.floor(F.least("ay", "by") - F.col("r")).cast("long"), F.floor(F.greatest("ay", "by") + F.col("r")).cast("long")
    rows = rows.withColumn("py", F.explode(F.sequence(first, last))).withColumn("cy", F.col("py") + 0.5)
    length = F.sqrt(F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2))
    # The outline's ends in this row: on the circles about both ends, and on the sides, parallel to the line.
    ends: list[Column] = []
    for e in "ab":
        away = F.pow(F.col("r"), 2) - F.pow(F.col("cy") - F.col(f"{e}y"), 2)
        half = F.when(away >= 0, F.sqrt(away))
        ends += [F.col(f"{e}x") - half, F.col(f"{e}x") + half]
    for side in (-1, 1):
        nx, ny = (F.col("by") - F.col("ay")) / length * F.col("r") * side, (F.col("ax") - F.col("bx")) / length * F.col("r") * side
        share = (F.col("cy") - F.col("ay") - ny) / (F.col("by") - F.col("ay"))
        ends.append(F.when((F.col("by") != F.col("ay")) & share.between(0, 1), F.col("ax") + nx + (F.col("bx") - F.col("ax")) * share))
    rows = rows.withColumn("__ends", F.array_compact(F.array(*ends))).where(F.size("__ends") > 0)
    low, high = F.floor(F.array_min("__ends")).cast("long") - 1, F.floor(F.array_max("__ends")).cast("long") + 1
    rows = rows.withColumn("px", F.explode(F.sequence(low, high))).withColumn("cx", F.col("px") + 0.5)
    square = F.pow(F.col("bx") - F.col("ax"), 2) + F.pow(F.col("by") - F.col("ay"), 2)
    along = ((F.col("cx") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("cy") - F.col("ay")) * (F.col("by") - F.col("ay"))) / F.when(square > 0, square)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    apart = F.pow(F.col("cx") - F.col("ax") - t * (F.col("bx") - F.col("ax")), 2) + F.pow(F.col("cy") - F.col("ay") - t * (F.col("by") - F.col("ay")), 2)
    covered = rows.where(apart <= F.pow(F.col("r"), 2))
    part = lambda c: F.floor(F.col(c) / tile).cast("long")
    return covered.groupBy("z", part("px").alias("x"), part("py").alias("y"), F.pmod("px", F.lit(tile)).alias("px"), F.pmod("py", F.lit(tile)).alias("py")).agg(F.min(value).alias(value))
