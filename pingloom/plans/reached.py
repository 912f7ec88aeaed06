"""Queries of reachability: cells, polygons, households and pixels, over short roads that lead away from the stops of the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reach, walks
from .queries import NEED, PARTS, query, stops

CELL, REACH = 250.0, 500.0
WIDTHS = {12: 3, 14: 6}

PARTS["roads"] = """roads AS (SELECT stop_lat AS a_lat, stop_lon AS a_lon, stop_lat + 0.004::DOUBLE AS b_lat, stop_lon + (stop_id % 5 - 2) / 500::DOUBLE AS b_lon, 520.0::DOUBLE AS metres, stop_id * 7 % 70 AS minutes FROM stops)"""
_CELL = "floor({0} * 111320.0::DOUBLE {1} / 250.0::DOUBLE)::BIGINT"
PARTS["reached"] = f"""sampled AS (SELECT a_lat + (b_lat - a_lat) * (k / 3::DOUBLE) AS lat, a_lon + (b_lon - a_lon) * (k / 3::DOUBLE) AS lon, minutes FROM roads, range(4) t(k)),
middles AS (SELECT {_CELL.format("lon", "* cos(radians(55.8::DOUBLE))")} AS x, {_CELL.format("lat", "")} AS y, minutes FROM sampled),
reached AS (SELECT x + i AS x, y + j AS y, min(minutes) AS minutes FROM middles, range(-2, 3) t(i), range(-2, 3) u(j) WHERE sqrt(i * i + j * j) <= 2.25 GROUP BY 1, 2)"""
PARTS["parts"] = """limits AS (SELECT unnest([15, 30, 60])::INTEGER AS threshold),
inside AS (SELECT threshold, x, y FROM reached JOIN limits ON minutes <= threshold),
touching AS (SELECT a.threshold, a.x, a.y, b.x AS bx, b.y AS by_ FROM inside a JOIN inside b ON a.threshold = b.threshold AND b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1),
parts AS (SELECT threshold, x, y, min(ox * 4294967296 + oy) AS part FROM (WITH RECURSIVE r AS (SELECT threshold, x, y, x AS ox, y AS oy FROM inside UNION SELECT r.threshold, r.x, r.y, bx, by_ FROM r JOIN touching e ON r.threshold = e.threshold AND r.ox = e.x AND r.oy = e.y) SELECT * FROM r) GROUP BY ALL),
rows_ AS (SELECT threshold, part, y, min(x) AS a, max(x) + 1 AS b FROM parts GROUP BY ALL),
corners AS (SELECT DISTINCT threshold, part, unnest([a, b, a, b]) AS x, unnest([y, y, y + 1, y + 1]) AS y FROM rows_),
sides AS (SELECT p.threshold, p.part, p.x AS px, p.y AS py, q.x AS qx, q.y AS qy FROM corners p JOIN corners q ON p.threshold = q.threshold AND p.part = q.part AND (p.x, p.y) <> (q.x, q.y)
  WHERE NOT EXISTS (SELECT 1 FROM corners r WHERE r.threshold = p.threshold AND r.part = p.part AND ((q.x - p.x) * (r.y - p.y) - (q.y - p.y) * (r.x - p.x) < 0
    OR ((q.x - p.x) * (r.y - p.y) = (q.y - p.y) * (r.x - p.x) AND ((r.x - p.x) * (q.x - p.x) + (r.y - p.y) * (q.y - p.y) < 0 OR (r.x - q.x) * (p.x - q.x) + (r.y - q.y) * (p.y - q.y) < 0))))),
shapes AS (SELECT threshold, part, sum(px * qy - qx * py) / 2 * 62500.0::DOUBLE AS area_m2, string_agg(px || ',' || py, ' ' ORDER BY px, py) AS ring FROM sides GROUP BY ALL)"""
PARTS["homes"] = """homes AS (SELECT x, y, sum(flats)::BIGINT AS households FROM (SELECT floor((stop_lon + 0.003::DOUBLE) * 111320.0::DOUBLE * cos(radians(55.8::DOUBLE)) / 250.0::DOUBLE)::BIGINT AS x, floor((stop_lat + 0.002::DOUBLE) * 111320.0::DOUBLE / 250.0::DOUBLE)::BIGINT AS y, 1 + stop_id % 9 AS flats FROM stops) GROUP BY ALL)"""
NEED |= {"roads": ["stops", "roads"], "reached": ["stops", "roads", "reached"], "shapes": ["stops", "roads", "reached", "parts"], "totals": ["stops", "roads", "reached", "parts", "homes"]}


def roads(s, d):
    return stops(s, d).select(
        F.col("stop_lat").alias("a_lat"), F.col("stop_lon").alias("a_lon"), (F.col("stop_lat") + 0.004).alias("b_lat"), (F.col("stop_lon") + (F.col("stop_id") % 5 - 2) / F.lit(500.0)).alias("b_lon"), F.lit(520.0).alias("metres"), (F.col("stop_id") * 7 % 70).alias("minutes")
    )


def homes(s, d):
    x, y = reach.plane_cell(F.col("stop_lat") + 0.002, F.col("stop_lon") + 0.003, CELL)
    return stops(s, d).groupBy(x.alias("x"), y.alias("y")).agg(F.sum(1 + F.col("stop_id") % 9).alias("households"))


def reached(s, d):
    return reach.reached_cells(roads(s, d), CELL, REACH)


def shapes(s, d):
    return reach.polygons(reach.threshold_components(reached(s, d)), CELL)


query("reach_cells", "SELECT x, y, minutes FROM reached", "reached")(reached)
query("reach_polygons", "SELECT threshold, area_m2, ring FROM shapes", "shapes")(
    lambda s, d: shapes(s, d).select("threshold", "area_m2", F.array_join(F.transform(F.array_sort(F.arrays_zip("xs", "ys")), lambda p: F.concat_ws(",", p["xs"].cast("string"), p["ys"].cast("string"))), " ").alias("ring"))
)
query(
    "reach_totals",
    """SELECT l.threshold, count(c.x) AS cells, coalesce(sum(households), 0)::BIGINT AS households, (SELECT count(*) FROM shapes s WHERE s.threshold = l.threshold) AS polygons, coalesce((SELECT sum(area_m2) FROM shapes s WHERE s.threshold = l.threshold) / 1000000.0::DOUBLE, 0) AS area_km2
  FROM limits l LEFT JOIN inside c ON c.threshold = l.threshold LEFT JOIN homes h ON h.x = c.x AND h.y = c.y GROUP BY l.threshold""",
    "totals",
)(lambda s, d: reach.reach_totals(reached(s, d), shapes(s, d), homes(s, d)))
_MX, _MY = "({0} + 180.0::DOUBLE) / 360.0::DOUBLE * 256.0::DOUBLE * pow(2.0::DOUBLE, z)", "(0.5::DOUBLE - ln((1 + sin(radians({0}))) / (1 - sin(radians({0})))) / (4 * pi())) * 256.0::DOUBLE * pow(2.0::DOUBLE, z)"
query(
    "line_pixels",
    f"""SELECT z, px // 256 AS x, py // 256 AS y, px % 256 AS px, py % 256 AS py, min(minutes) AS minutes FROM (SELECT *, px + 0.5::DOUBLE AS cx, py + 0.5::DOUBLE AS cy, greatest(0, least(1, ((px + 0.5::DOUBLE - ax) * (bx - ax) + (py + 0.5::DOUBLE - ay) * (by_ - ay)) / (pow(bx - ax, 2) + pow(by_ - ay, 2)))) AS t FROM (
  SELECT *, unnest(range((floor(least(ax, bx)) - 5)::BIGINT, (floor(greatest(ax, bx)) + 6)::BIGINT)) AS px FROM (SELECT *, unnest(range((floor(least(ay, by_)) - 5)::BIGINT, (floor(greatest(ay, by_)) + 6)::BIGINT)) AS py FROM (
  SELECT z, r, minutes, {_MX.format("a_lon")} AS ax, {_MY.format("a_lat")} AS ay, {_MX.format("b_lon")} AS bx, {_MY.format("b_lat")} AS by_ FROM roads, (VALUES (12, 1.5::DOUBLE), (14, 3.0::DOUBLE)) w(z, r)))))
  WHERE pow(cx - ax - t * (bx - ax), 2) + pow(cy - ay - t * (by_ - ay), 2) <= pow(r, 2) GROUP BY 1, 2, 3, 4, 5""",
    "roads",
)(lambda s, d: reach.line_pixels(roads(s, d), WIDTHS))

# Walks: streets along the lattice of stops; every third stop is asked from.
PARTS["streets"] = """streets AS (SELECT a.stop_id AS a, b.stop_id AS b, CASE b.stop_id - a.stop_id WHEN 1 THEN 300.0::DOUBLE ELSE 1200.0::DOUBLE END AS metres FROM stops a JOIN stops b ON (b.stop_id = a.stop_id + 1 AND a.stop_id % 20 < 19 AND a.stop_id % 25 < 24) OR (b.stop_id = a.stop_id + 25 AND a.stop_id % 20 < 15)),
ways AS (SELECT a, b, metres FROM streets UNION ALL SELECT b, a, metres FROM streets),
walked AS (SELECT stop, node, min(m) AS metres FROM (WITH RECURSIVE w AS (SELECT stop_id AS stop, stop_id AS node, 15.0::DOUBLE AS m FROM stops WHERE stop_id % 3 = 0 UNION SELECT stop, b, m + metres FROM w JOIN ways ON node = a WHERE m + metres <= 2000) SELECT * FROM w) GROUP BY ALL)"""
PARTS["walk_pieces"] = """walk_pieces AS (SELECT a * 10 + k AS piece, a, b, (k + 0.5::DOUBLE) * 75 AS to_a, (3.5::DOUBLE - k) * 75 AS to_b FROM streets, range(4) t(k) WHERE metres = 300),
candidates AS (SELECT piece, stop, min(metres + m) AS metres FROM walked JOIN (SELECT piece, a AS node, to_a AS m FROM walk_pieces UNION ALL SELECT piece, b, to_b FROM walk_pieces) USING (node) WHERE metres + m <= 2000 GROUP BY ALL)"""
NEED |= {"streets": ["stops", "streets"], "walk_pieces": ["stops", "streets", "walk_pieces"]}


def streets(s, d):
    a = stops(s, d).select(F.col("stop_id").alias("a"), F.col("stop_lat").alias("a_lat"), F.col("stop_lon").alias("a_lon"))
    b = stops(s, d).select(F.col("stop_id").alias("b"), F.col("stop_lat").alias("b_lat"), F.col("stop_lon").alias("b_lon"))
    steps = a.withColumn("b", F.explode(F.array(F.when((F.col("a") % 20 < 19) & (F.col("a") % 25 < 24), F.col("a") + 1), F.when(F.col("a") % 20 < 15, F.col("a") + 25)))).where("b is not null")
    return steps.join(b, "b").withColumn("metres", F.when(F.col("b") - F.col("a") == 1, 300.0).otherwise(1200.0))


def walked(s, d):
    asked = stops(s, d).where("stop_id % 3 = 0").select(F.col("stop_id").alias("stop"), F.col("stop_lat").alias("lat"), F.col("stop_lon").alias("lon"))
    return walks.tiled_walks(streets(s, d), asked, asked.select("stop", F.col("stop").alias("node"), F.lit(15.0).alias("metres")), tile_m=2500.0)


def walk_candidates(s, d):
    rows = streets(s, d).where("metres = 300").withColumn("k", F.explode(F.array(*map(F.lit, range(4)))))
    pieces = rows.select((F.col("a") * 10 + F.col("k")).alias("piece"), "a", "b", ((F.col("k") + 0.5) * 75).alias("to_a"), ((F.lit(3.5) - F.col("k")) * 75).alias("to_b"))
    return walks.walk_candidates(walked(s, d), pieces)


query("tiled_walks", "SELECT stop, node, metres FROM walked", "streets")(walked)
query("walk_candidates", "SELECT piece, stop, metres FROM candidates", "walk_pieces")(walk_candidates)
query(
    "walk_best_and_nearest",
    """SELECT piece, min(stop % 40 * 60 + ceil(metres / 1.3::DOUBLE))::BIGINT AS seconds, arg_min(stop, (stop % 40 * 60 + ceil(metres / 1.3::DOUBLE), stop)) AS stop, arg_min(metres, (stop % 40 * 60 + ceil(metres / 1.3::DOUBLE), stop)) AS walk_m,
  arg_min(stop, (metres, stop)) AS nearest_stop, min(metres) AS nearest_m, arg_min(stop % 40 * 60, (metres, stop)) AS nearest_seconds FROM candidates GROUP BY 1""",
    "walk_pieces",
)(lambda s, d: walks.best_and_nearest(walk_candidates(s, d), stops(s, d).select(F.col("stop_id").alias("stop"), (F.col("stop_id") % 40 * 60).alias("seconds"))))
