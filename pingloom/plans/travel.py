"""Queries of journeys and their roll-ups, topology, contours and map layers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import journeys, network
from ..sources import topology
from .queries import HAVERSINE, MERC, NEED, PARTS, _read, links, origins, pings, plated, query, rides, static_paths, stops

LEG = "from_stop || '-' || to_stop || '-' || dep || '-' || arr || '-' || plate"


def _round(k: int) -> str:
    """A round in SQL: the first arrival of each label and link, then the least arrival of each stop."""
    return f"""s{k} AS (SELECT origin, to_stop AS stop, min(arr) AS "at", arg_min(path || CASE WHEN path = '' THEN '' ELSE '>' END || {LEG}, (arr, dep, plate)) AS path
  FROM j{k - 1} JOIN plated ON stop = from_stop AND dep >= "at" GROUP BY origin, from_stop, to_stop),
j{k} AS (SELECT origin, stop, min("at") AS "at", arg_min(path, ("at", path)) AS path FROM (SELECT * FROM j{k - 1} UNION ALL SELECT * FROM s{k}) GROUP BY ALL)"""


PARTS["plated"] = "plated AS (SELECT *, (dep * 7 + arr) % 5 AS plate FROM links)"
PARTS["journeys"] = """j0 AS (SELECT i AS origin, i AS stop, 0::BIGINT AS "at", '' AS path FROM range(20) t(i)),\n""" + ",\n".join(map(_round, (1, 2, 3)))
PARTS["od"] = """od AS (SELECT from_stop AS origin, to_stop AS stop, dep, arr, dep % 6 * 10 AS bucket, (DATE '1992-01-01' + dep::INTEGER)::DATE AS service_date, arr - dep AS seconds, (arr - dep) % 5 AS wait_s,
  (arr - dep) - (arr - dep) % 5 AS ride_s, arr % 3 AS changes, 'r' || (arr % 4) AS pattern, from_stop || '|' || to_stop || '|' || dep || '|' || arr AS journey_id,
  isodow((DATE '1992-01-01' + dep::INTEGER)::DATE)::INTEGER AS weekday_iso FROM links)"""
NEED |= {"journeys": ["links", "plated", "journeys"], "od": ["links", "od"]}


def best_journeys(s, d):
    return journeys.earliest_journeys(plated(rides(s, d)), origins(s))


query("journeys_with_legs", 'SELECT origin, stop, "at", path, CASE WHEN path = \'\' THEN 0 ELSE length(path) - length(replace(path, \'>\', \'\')) + 1 END::INTEGER AS rides FROM j3', "journeys")(
    lambda s, d: best_journeys(s, d).select("origin", "stop", "at", "path", "rides")
)
query(
    "journey_fragments",
    """SELECT origin, stop, fragment, min(dep) AS board, max(arr) AS alight, count(*) AS legs, min(plate) AS plate FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY origin, stop ORDER BY leg)::BIGINT AS fragment FROM (
  SELECT *, CASE WHEN lag(plate) OVER (PARTITION BY origin, stop ORDER BY leg) = plate THEN 0 ELSE 1 END AS fresh FROM (
  SELECT origin, stop, leg, split_part(x, '-', 3)::BIGINT AS dep, split_part(x, '-', 4)::BIGINT AS arr, split_part(x, '-', 5)::BIGINT AS plate FROM (
  SELECT origin, stop, unnest(range(len(string_split(path, '>')))) AS leg, unnest(string_split(path, '>')) AS x FROM j3 WHERE path <> '')))) GROUP BY ALL""",
    "journeys",
)(lambda s, d: journeys.fragments(best_journeys(s, d)))


def _network_round(k: int) -> str:
    """A round from labels at an origin or at a stop of change; c holds the labels that the last round made better."""
    return f"""t{k} AS (SELECT origin, to_stop AS stop, min(arr) AS "at" FROM c{k - 1} JOIN plated ON stop = from_stop AND dep >= "at" GROUP BY ALL),
n{k} AS (SELECT origin, stop, min("at") AS "at" FROM (SELECT * FROM n{k - 1} UNION ALL SELECT * FROM t{k}) GROUP BY ALL),
c{k} AS (SELECT * FROM n{k} WHERE stop IN (SELECT stop FROM changes) AND (origin, stop, "at") NOT IN (SELECT (origin, stop, "at") FROM n{k - 1}))"""


PARTS["networked"] = """changes AS (SELECT from_stop AS stop FROM plated GROUP BY 1 HAVING count(DISTINCT plate) > 1 AND from_stop % 2 = 0),
n0 AS (SELECT i AS origin, i AS stop, 0::BIGINT AS "at" FROM range(20) t(i)),\nc0 AS (SELECT * FROM n0),\n""" + ",\n".join(map(_network_round, (1, 2, 3)))
query("journeys_by_transfer_stops", "SELECT * FROM n3", "links", "plated", "networked")(lambda s, d: _network(s, d))


def _network(s, d):
    found = plated(rides(s, d))
    changes = journeys.transfer_stops(found, "from_stop", "plate").where("from_stop % 2 = 0").select(F.col("from_stop").alias("stop_id"))
    return journeys.network_journeys(found, origins(s), changes).select("origin", "stop", "at")


def _hop(k: int) -> str:
    """A hop of replayed paths: a walk of 3 m takes 3 s at 1.4 m/s; a ride is the first arrival as of the time."""
    return f"""h{k} AS (SELECT origin, stop, path, walked, CASE WHEN any_value(walked[{k}]) THEN any_value("at") + 3 ELSE min(arr) END AS "at"
  FROM h{k - 1} LEFT JOIN links ON NOT walked[{k}] AND from_stop = path[{k}] AND to_stop = path[{k + 1}] AND dep >= "at" WHERE len(path) > {k} AND "at" IS NOT NULL GROUP BY origin, stop, path, walked)"""


HOPS = 6
PARTS["replayed"] = 'h0 AS (SELECT origin, stop, path, walked, 0::BIGINT AS "at" FROM paths),\n' + ",\n".join(map(_hop, range(1, HOPS + 1)))
NEED["replayed"] = ["links", "edges", "paths", "replayed"]
query(
    "static_replay",
    'SELECT origin, 0::BIGINT AS requested, stop, min("at") AS "at" FROM (' + " UNION ALL ".join(f"SELECT * FROM h{k} WHERE len(path) = {k + 1}" for k in range(1, HOPS + 1)) + ') WHERE "at" IS NOT NULL GROUP BY ALL',
    "replayed",
)(lambda s, d: journeys.replay(static_paths(s, d), plated(rides(s, d)), origins(s).select("origin", "at", F.col("at").alias("requested")), HOPS, slot=64))


def od(s, d):
    day = F.date_add(F.lit("1992-01-01").cast("date"), F.col("dep").cast("int"))
    total = F.col("arr") - F.col("dep")
    return links(s, d).select(
        F.col("from_stop").alias("origin"),
        F.col("to_stop").alias("stop"),
        (F.col("dep") % 6 * 10).alias("bucket"),
        day.alias("service_date"),
        (F.weekday(day) + 1).cast("int").alias("weekday_iso"),
        total.alias("seconds"),
        (total % 5).alias("wait_s"),
        (total - total % 5).alias("ride_s"),
        (F.col("arr") % 3).alias("changes"),
        F.concat(F.lit("r"), (F.col("arr") % 4).cast("string")).alias("pattern"),
        F.concat_ws("|", "from_stop", "to_stop", "dep", "arr").alias("journey_id"),
    )


OD_KEYS = {
    "day": ["service_date", "weekday_iso", "origin", "stop"],
    "day_bucket": ["service_date", "weekday_iso", "bucket", "origin", "stop"],
    "all": ["origin", "stop"],
    "weekday": ["weekday_iso", "origin", "stop"],
    "bucket": ["bucket", "origin", "stop"],
    "weekday_bucket": ["weekday_iso", "bucket", "origin", "stop"],
}
WHOLE = "floor(avg({0}) + 0.5)::BIGINT AS {1}"
for grain, keys in OD_KEYS.items():
    cols = ", ".join(keys)
    query(
        f"od_{grain}",
        f"SELECT {cols}, min(seconds) AS least, {WHOLE.format('seconds', 'mean')}, count(*) AS n, arg_min(journey_id, (seconds, journey_id)) AS best, max(pattern) AS pattern FROM od GROUP BY {cols}",
        "od",
    )(lambda s, d, keys=keys: journeys.od_summary(od(s, d), keys))
    query(
        f"od_pattern_{grain}",
        f"""SELECT {cols}, pattern, count(*) AS n, {WHOLE.format("seconds", "mean")}, {WHOLE.format("wait_s", "mean_wait")}, {WHOLE.format("ride_s", "mean_ride")}, floor(avg(changes) * 100 + 0.5) / 100 AS mean_changes,
  min(seconds) AS least, arg_min(journey_id, (seconds, journey_id)) AS best FROM od GROUP BY {cols}, pattern""",
        "od",
    )(lambda s, d, keys=keys: journeys.od_patterns(od(s, d), keys))
query(
    "request_grid_counts",
    """SELECT b AS bucket, 20 * 19::BIGINT AS possible, coalesce(reachable, 0) AS reachable, coalesce(detailed, 0) AS detailed, coalesce(fragments, 0)::BIGINT AS fragments
  FROM (SELECT unnest(range(0, 90, 10)) AS b) LEFT JOIN (SELECT bucket, count(DISTINCT (origin, stop)) AS reachable, count(*) AS detailed, sum(changes + 1)::BIGINT AS fragments FROM od GROUP BY 1) ON b = bucket""",
    "od",
)(lambda s, d: journeys.request_grid(od(s, d).withColumn("fragments", F.col("changes") + 1), s.range(0, 90, 10).withColumnRenamed("id", "bucket"), 20, 20))
query("least_to_destination", "SELECT bucket, stop, min(seconds) AS least FROM od WHERE origin IN (1, 4, 7) GROUP BY ALL", "od")(lambda s, d: journeys.least_to(od(s, d), [1, 4, 7]))

# Topology: the documents are put together from the tables, then parsed.


def _topology(s, d):
    stop = _read(s, d, "supplier").select(F.struct(F.col("s_suppkey").cast("string").alias("k"), F.array("s_name", (F.col("s_suppkey") * 0.5).cast("string"), F.col("s_suppkey").cast("string")).alias("v")).alias("e"))
    bus = _read(s, d, "nation").select(
        F.struct(F.col("n_nationkey").cast("string").alias("k"), F.array(F.lit(""), F.col("n_name"), F.lit(""), F.lit(""), F.lit(""), (F.col("n_nationkey") % 3).cast("string")).alias("v")).alias("e")
    )
    route = _read(s, d, "supplier").select(
        F.struct(
            F.concat(F.lit("k"), F.col("s_suppkey")).alias("k"),
            F.transform(F.array(F.col("s_nationkey") + F.when(F.col("s_suppkey") % 10 == 0, 1000).otherwise(0), "s_suppkey", F.col("s_suppkey") % 2, F.col("s_suppkey") % 30), lambda x: x.cast("string")).alias("v"),
        ).alias("e")
    )
    as_map = lambda df, name: df.agg(F.map_from_entries(F.collect_list("e")).alias(name))
    whole = as_map(stop, "nbusstop").join(F.broadcast(as_map(bus, "bus"))).join(F.broadcast(as_map(route, "route")))  # one row each
    return topology.parse_topology(whole.select(F.to_json(F.struct("*")).alias("value")))


query(
    "topology_route_stops",
    """SELECT s_nationkey::VARCHAR AS route_id, CASE WHEN s_nationkey % 3 IN (1, 2) THEN 'Т' ELSE '' END || n_name AS route, s_suppkey::VARCHAR AS stop_id, s_name AS stop_name, s_suppkey::DOUBLE AS stop_lat,
  s_suppkey * 0.5::DOUBLE AS stop_lon, (s_suppkey % 2)::INTEGER AS direction, (s_suppkey % 30)::INTEGER AS stop_order FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 10 <> 0""",
)(lambda s, d: _topology(s, d)[2].select("route_id", "route", "stop_id", "stop_name", "stop_lat", "stop_lon", "direction", "stop_order"))

# Reachability: contours, pieces, connectors, map layers.
PARTS["reach"] = "reach AS (SELECT DISTINCT p_partkey % 97 AS x, p_size::BIGINT AS y FROM part),\ntimed AS (SELECT *, (x * 7 + y * 3) % 70 AS minutes, 1 + (x + y) % 4 AS households FROM reach)"


def timed_cells(s, d):
    cells = _read(s, d, "part").select((F.col("p_partkey") % 97).cast("long").alias("x"), F.col("p_size").cast("long").alias("y")).distinct()
    return cells.withColumns({"minutes": (F.col("x") * 7 + F.col("y") * 3) % 70, "households": 1 + (F.col("x") + F.col("y")) % 4})


query(
    "contour_households",
    """SELECT l AS minutes, count(x) AS cells, coalesce(sum(households), 0)::BIGINT AS households FROM (SELECT unnest([15, 30, 60]) AS l) LEFT JOIN timed ON minutes <= l GROUP BY 1""",
    "reach",
)(lambda s, d: network.contours(timed_cells(s, d)).select("minutes", "cells", "households"))
query(
    "contour_components",
    """SELECT x, y, min(other) AS component FROM (WITH RECURSIVE c AS (SELECT * FROM timed WHERE minutes <= 30),
  e AS (SELECT a.x, a.y, b.x AS bx, b.y AS by_ FROM c a JOIN c b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1),
  r AS (SELECT x, y, x AS ox, y AS oy FROM c UNION SELECT r.x, r.y, bx, by_ FROM r JOIN e ON r.ox = e.x AND r.oy = e.y) SELECT x, y, ox * 2147483648 + oy AS other FROM r) GROUP BY ALL""",
    "reach",
)(lambda s, d: network.grid_components(timed_cells(s, d).where("minutes <= 30")))
query(
    "tile_pixels",
    f"""SELECT 13 AS z, gx // 64 AS x, gy // 64 AS y, gx % 64 AS px, gy % 64 AS py, count(*) AS n, max(speed) AS most FROM (
  SELECT speed, floor((lon + 180) / 360 * 256 * pow(2, 13) / 4)::BIGINT AS gx, {MERC.replace("zoom", "13").replace("/ 6)", "/ 4)")} AS gy FROM pings) GROUP BY ALL""",
    "pings",
)(lambda s, d: network.tile_pixels(pings(s, d), 13, {"n": F.count("*"), "most": F.max("speed")}, 4))
APART = HAVERSINE.replace("stop_lat", "n_lat").replace("stop_lon", "n_lon")
query(
    "stop_connectors",
    f"""SELECT stop_id, node FROM (SELECT stop_id, stop_lat AS lat, stop_lon AS lon FROM stops), (SELECT stop_id AS node, stop_lat + 0.001 AS n_lat, stop_lon AS n_lon FROM stops WHERE stop_id % 3 = 0)
  WHERE abs(lat - n_lat) < 0.02 AND {APART} <= 180""",
    "stops",
)(lambda s, d: _connectors(s, d))


def _connectors(s, d):
    found = stops(s, d)
    nodes = found.where("stop_id % 3 = 0").select(F.col("stop_id").alias("node"), (F.col("stop_lat") + 0.001).alias("lat"), F.col("stop_lon").alias("lon"))
    return network.connectors(found, nodes, least=0).select("stop_id", "node")
