"""Queries of journeys by vehicle runs.

An order is a vehicle's run on one of seven days: its lines in order are stops, a few minutes apart.  A pattern serves fifteen stops, ten of which it
shares with its neighbours.  Vehicles have several runs a day, some of which overlap.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import chain, packs, runs
from .queries import HAVERSINE, NEED, PARTS, _read, line_parts, order_lines, query

RIDES, BOARDINGS = 3, 6

PARTS["ride_events"] = """lines AS (SELECT o_orderkey, o_custkey, l_partkey % 15 + o_custkey % 12 * 5 AS stop, row_number() OVER (PARTITION BY o_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS k
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
hops AS (SELECT *, lead(stop) OVER (PARTITION BY o_orderkey ORDER BY k) AS to_stop FROM lines),
ride_events AS (SELECT DATE '2024-01-01' + (o_orderkey % 7)::INTEGER AS service_date, 'r' || (o_custkey % 12) AS pattern, 'r' || (o_custkey % 12) || '|' || (o_orderkey % 40) AS ride, stop AS from_stop, to_stop,
  o_orderkey * 7919 % 80000 + k * 300 + stop AS dep, o_orderkey * 7919 % 80000 + k * 300 + 240 + to_stop AS arr, k AS start_order, k + 1 AS end_order FROM hops WHERE to_stop <> stop)"""
PARTS["run_events"] = """flagged AS (SELECT *, coalesce(dep >= max(arr) OVER (PARTITION BY service_date, ride ORDER BY dep, arr, from_stop, to_stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS on_run FROM ride_events),
opened AS (SELECT *, CASE WHEN on_run AND coalesce(dep - max(CASE WHEN on_run THEN arr END) OVER (PARTITION BY service_date, ride ORDER BY dep, arr, from_stop, to_stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 1800, true) THEN 1 ELSE 0 END AS fresh FROM flagged),
placed AS (SELECT *, CASE WHEN on_run THEN sum(fresh) OVER w END::BIGINT AS run, CASE WHEN on_run THEN sum(on_run::INTEGER) OVER w END::BIGINT AS place FROM opened WINDOW w AS (PARTITION BY service_date, ride ORDER BY dep, arr, from_stop, to_stop ROWS UNBOUNDED PRECEDING)),
ahead AS (SELECT service_date, ride, arr, arg_min(m.run, m.place) AS to_run, min(m.place) AS to_place, arg_min(m.dep, m.place) AS to_dep FROM (SELECT DISTINCT service_date, ride, arr FROM placed WHERE NOT on_run) e JOIN (SELECT service_date, ride, run, place, dep FROM placed WHERE on_run) m USING (service_date, ride) WHERE m.dep >= e.arr GROUP BY ALL),
run_events AS (SELECT p.*, CASE WHEN on_run THEN run WHEN to_dep - p.arr <= 1800 THEN to_run END AS next_run, CASE WHEN on_run THEN place + 1 ELSE to_place END AS next_place FROM placed p LEFT JOIN ahead a ON NOT on_run AND p.service_date = a.service_date AND p.ride = a.ride AND p.arr = a.arr)"""


def _ride(k: int) -> str:
    leg = "b.pattern || '-' || b.ride || '-' || b.stop || '-' || {to} || '-' || b.dep || '-' || {arr}"
    path = "path || CASE WHEN path = '' THEN '' ELSE '>' END || " + leg
    known = " UNION ALL ".join(f"SELECT * FROM g{j}" for j in range(1, k)) or "SELECT * FROM g0 WHERE false"
    goes = "" if k == 1 else "AND (service_date, stop) IN (SELECT (service_date, stop) FROM changes)"
    return f"""b{k} AS (SELECT l.service_date, origin, requested, stop, path, e.pattern, e.ride, e.to_stop, e.dep, e.arr, next_run, next_place FROM g{k - 1} l JOIN run_events e ON l.service_date = e.service_date AND stop = from_stop AND dep >= "at" {goes.replace("service_date", "l.service_date", 1)}
  QUALIFY row_number() OVER (PARTITION BY l.service_date, origin, requested, stop, e.pattern ORDER BY e.dep, e.arr, e.ride, e.to_stop, next_run, next_place) <= {BOARDINGS}),
r{k} AS (SELECT service_date, origin, requested, to_stop AS stop, arr AS "at", {path.format(to="b.to_stop", arr="b.arr")} AS path FROM b{k} b UNION ALL
  SELECT b.service_date, origin, requested, m.to_stop, m.arr, {path.format(to="m.to_stop", arr="m.arr")} FROM b{k} b JOIN placed m ON b.service_date = m.service_date AND b.ride = m.ride AND b.next_run = m.run AND m.place >= b.next_place),
g{k} AS (SELECT n.* FROM (SELECT service_date, origin, requested, stop, min("at") AS "at", arg_min(path, ("at", path)) AS path, {k} AS rides FROM r{k} WHERE stop <> origin GROUP BY ALL) n
  LEFT JOIN (SELECT service_date, origin, requested, stop, min("at") AS known FROM ({known}) GROUP BY ALL) o ON n.service_date = o.service_date AND n.origin = o.origin AND n.requested = o.requested AND n.stop = o.stop WHERE known IS NULL OR "at" < known)"""


PARTS["run_journeys"] = """changes AS (SELECT service_date, stop FROM (SELECT service_date, from_stop AS stop, pattern FROM ride_events UNION ALL SELECT service_date, to_stop, pattern FROM ride_events) GROUP BY ALL HAVING count(DISTINCT pattern) > 1),
g0 AS (SELECT DATE '2024-01-01' + d::INTEGER AS service_date, o AS origin, r * 21600 AS requested, o AS stop, r * 21600 AS "at", '' AS path, 0 AS rides FROM range(7) x(d), range(20) y(o), range(1, 4) z(r)),
""" + ",\n".join(map(_ride, range(1, RIDES + 1))) + ",\nfound AS (" + " UNION ALL ".join(f"SELECT * FROM g{k}" for k in range(1, RIDES + 1)) + ")"
NEED |= {"run_events": ["ride_events", "run_events"], "run_journeys": ["ride_events", "run_events", "run_journeys"]}


def hop_packs(s, d):
    """How lines, their orders' customers and hops are packed; None where the tables are small."""
    if not line_parts(s, d):
        return None
    lines, orders = _read(s, d, "lineitem"), _read(s, d, "orders")
    found = packs.measured(lines.select("l_linenumber", "l_partkey", (F.col("l_partkey") % 15).alias("spot")), ["l_linenumber", "l_partkey", "spot"])
    found |= packs.measured(orders.select("o_orderkey", "o_custkey", (F.col("o_custkey") % 12).alias("pattern_no")), ["o_orderkey", "o_custkey", "pattern_no"])
    (kind, [(least, most)], _), (other, [(low, high)], _) = found.fields["spot"], found.fields["pattern_no"]
    stop = (kind if kind == other else "bigint", [(least + low * 5, most + high * 5)], False)
    return found | packs.Packs({"stop": stop, "to_stop": stop})


HOP = ["o_orderkey", "pattern_no", "stop", "to_stop", "k"]


def hops(s, d, held=None):
    """Each line's stop and number in its run, with the next one's stop.  held: hop_packs, if they are known."""
    # Lines alike in number and part are at one stop: the further columns of the SQL's order tell which of them is first, and that changes no hop.
    in_order = lambda lines: lines.withColumn("__j", F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")))
    rows = order_lines(s, d, ["l_linenumber", "l_partkey", "o_custkey"], held or hop_packs(s, d), in_order)
    rows = rows.select("l_orderkey", "o_orderkey", "__j", (F.col("o_custkey") % 12).alias("pattern_no"), (F.col("l_partkey") % 15 + F.col("o_custkey") % 12 * 5).alias("stop"))
    run = Window.partitionBy("l_orderkey").orderBy("__j")
    return rows.withColumns({"k": F.row_number().over(run).cast("long"), "to_stop": F.lead("stop").over(run)}).select(*HOP).where("to_stop <> stop")


def ride_columns(c=F.col):
    """What a hop's ride, stops and times are, from the columns of hops."""
    start = c("o_orderkey") * 7919 % 80000 + c("k") * 300
    pattern = F.concat(F.lit("r"), c("pattern_no").cast("string"))
    return {
        "service_date": F.date_add(F.lit("2024-01-01").cast("date"), (c("o_orderkey") % 7).cast("int")),
        "pattern": pattern,
        "ride": F.concat_ws("|", pattern, (c("o_orderkey") % 40).cast("string")),
        "from_stop": c("stop"),
        "to_stop": c("to_stop"),
        "dep": start + c("stop"),
        "arr": start + 240 + c("to_stop"),
        "start_order": c("k"),
        "end_order": c("k") + 1,
    }


def ride_events(s, d):
    return hops(s, d).select(*(c.alias(name) for name, c in ride_columns().items()))


def requests(s):
    """Three requests a day from each of twenty stops."""
    cell = F.col("id")
    return s.range(7 * 20 * 3).select(F.date_add(F.lit("2024-01-01").cast("date"), F.floor(cell / 60).cast("int")).alias("service_date"), F.floor(cell % 60 / 3).cast("long").alias("origin"), ((cell % 3 + 1) * 21600).alias("requested"))


def best(s, d):
    return runs.run_journeys(ride_events(s, d), requests(s), RIDES, BOARDINGS)


EVENT = ["service_date", "ride", "pattern", "from_stop", "to_stop", "dep", "arr"]
query("vehicle_runs", f"SELECT {', '.join(EVENT)}, on_run, run, place, next_run, next_place FROM run_events", "run_events")(lambda s, d: runs.vehicle_runs(ride_events(s, d)).select(*EVENT, "on_run", "run", "place", "next_run", "next_place"))
query("run_journeys", 'SELECT service_date, origin, requested, stop, "at", path, rides FROM found', "run_journeys")(lambda s, d: best(s, d).select(*runs.LABEL, "at", "path", "rides"))
query(
    "run_journey_fragments",
    """SELECT service_date, origin, requested, stop, rides, fragment, pattern, ride, from_stop, to_stop, dep, arr, dep - coalesce(lag(arr) OVER (PARTITION BY service_date, origin, requested, stop, rides ORDER BY fragment), requested) AS wait_s, arr - dep AS ride_s FROM (
  SELECT service_date, origin, requested, stop, rides, fragment, arg_min(pattern, leg) AS pattern, min(ride) AS ride, arg_min(from_stop, leg) AS from_stop, arg_max(to_stop, leg) AS to_stop, arg_min(dep, leg) AS dep, arg_max(arr, leg) AS arr FROM (
  SELECT *, sum(fresh) OVER (PARTITION BY service_date, origin, requested, stop, rides ORDER BY leg)::BIGINT AS fragment FROM (
  SELECT *, CASE WHEN lag(ride) OVER (PARTITION BY service_date, origin, requested, stop, rides ORDER BY leg) = ride THEN 0 ELSE 1 END AS fresh FROM (
  SELECT service_date, origin, requested, stop, rides, leg, split_part(x, '-', 1) AS pattern, split_part(x, '-', 2) AS ride, split_part(x, '-', 3)::BIGINT AS from_stop, split_part(x, '-', 4)::BIGINT AS to_stop, split_part(x, '-', 5)::BIGINT AS dep, split_part(x, '-', 6)::BIGINT AS arr
  FROM (SELECT *, unnest(range(len(string_split(path, '>')))) AS leg, unnest(string_split(path, '>')) AS x FROM found))))
  GROUP BY ALL)""",
    "run_journeys",
)(lambda s, d: runs.ride_fragments(best(s, d)))
query(
    "run_request_counts",
    """SELECT a.service_date, a.requested, possible, coalesce(reached, 0) AS reached, coalesce(rides, 0)::BIGINT AS rides, coalesce(seconds, 0)::BIGINT AS seconds FROM (SELECT service_date, requested, count(*) * 69 AS possible FROM g0 GROUP BY ALL) a
  LEFT JOIN (SELECT service_date, requested, count(*) AS reached, sum(rides) AS rides, sum("at" - requested) AS seconds FROM (SELECT service_date, origin, requested, stop, min("at") AS "at", arg_min(rides, ("at", rides)) AS rides FROM found GROUP BY ALL) GROUP BY ALL) b ON a.service_date = b.service_date AND a.requested = b.requested""",
    "run_journeys",
)(lambda s, d: runs.request_counts(best(s, d), requests(s), 70))

# The whole chain on true gaps.  Vehicles of a pattern go along its stops in order; each event gives two pings at its stop and two at the next one.
PARTS["whole_chain"] = """tracks AS (SELECT 'p' || (o_custkey % 12) AS route, 'v' || (o_orderkey % 3000) AS plate, k AS place, o_orderkey * 7919 % 80000 + k * 240 + o_orderkey % 97 * k AS t, DATE '2024-01-01' + (o_orderkey % 7)::INTEGER AS day, o_orderkey % 5 = 0 AS there FROM lines WHERE k <= 9),
chain_pings AS (SELECT route, plate, day::TIMESTAMP + INTERVAL (t + 25 * i) SECOND AS event_time, 55.7::DOUBLE + place / 200::DOUBLE AS lat, 49.1::DOUBLE + (i - 1) / 10000::DOUBLE AS lon FROM tracks, range(3) x(i)),
served AS (SELECT 'p' || p AS route, d AS direction, p * 100 + o * 2 + (CASE WHEN o IN (4, 7) THEN 0 ELSE d END) AS stop_id, CASE d WHEN 0 THEN o ELSE 10 - o END AS stop_order, 55.7::DOUBLE + o / 200::DOUBLE AS stop_lat, 49.1::DOUBLE + (CASE WHEN o IN (4, 7) THEN 0 ELSE d END) / 10000::DOUBLE AS stop_lon FROM range(12) a(p), range(2) b(d), range(1, 10) c(o)),
ctx AS (SELECT *, min(stop_order) OVER w AS least, max(stop_order) OVER w AS most FROM served WINDOW w AS (PARTITION BY route, direction)),
close AS (SELECT c.route, c.direction, c.stop_id, plate, event_time, (event_time + INTERVAL 3 HOUR)::DATE AS service_date FROM chain_pings p JOIN served c ON p.route = c.route AND abs(lat - stop_lat) < 0.001 WHERE {dist} <= 50),
gapped AS (SELECT *, CASE WHEN epoch_us(event_time) - epoch_us(lag(event_time) OVER w) <= 180000000 THEN 0 ELSE 1 END AS fresh FROM close WINDOW w AS (PARTITION BY service_date, plate, route, stop_id, direction ORDER BY event_time)),
stayed AS (SELECT service_date, plate, route, stop_id, direction, min(event_time) AS entered_at, max(event_time) AS exited_at FROM (SELECT *, sum(fresh) OVER (PARTITION BY service_date, plate, route, stop_id, direction ORDER BY event_time) AS run FROM gapped) GROUP BY service_date, plate, route, stop_id, direction, run),
told AS (SELECT s.*, stop_order, least, most, stop_order IN (least, most) AS is_terminal FROM stayed s JOIN ctx USING (route, direction, stop_id)),
safe AS (SELECT * FROM told WHERE is_terminal OR (service_date, plate, route, stop_id, entered_at, exited_at) NOT IN (SELECT (service_date, plate, route, stop_id, entered_at, exited_at) FROM told GROUP BY ALL HAVING count(DISTINCT direction) > 1)),
linked AS (SELECT a.service_date, a.plate, a.route, a.direction, a.stop_id AS from_stop, a.stop_order, a.least, a.most, a.exited_at AS start_at, arg_min(b.stop_id, (b.entered_at, b.stop_id)) AS to_stop, min(b.entered_at) AS end_at FROM safe a JOIN safe b ON a.service_date = b.service_date AND a.plate = b.plate AND a.route = b.route AND a.direction = b.direction AND b.stop_order = a.stop_order + 1
  AND b.entered_at > a.exited_at AND epoch_us(b.entered_at) // 1000000 - epoch_us(a.exited_at) // 1000000 <= 900 GROUP BY ALL),
timed_ AS (SELECT *, epoch_us(end_at) // 1000000 - epoch_us(start_at) // 1000000 AS seconds FROM linked),
whole AS (SELECT service_date, plate, route, direction, from_stop, to_stop, start_at, end_at, seconds, 300.0::DOUBLE + from_stop % 7 * 100 AS metres, (300.0::DOUBLE + from_stop % 7 * 100) * 3.6::DOUBLE / seconds AS speed_kmh FROM timed_
  WHERE (300.0::DOUBLE + from_stop % 7 * 100) * 3.6::DOUBLE / seconds <= 120 AND ((300.0::DOUBLE + from_stop % 7 * 100) * 3.6::DOUBLE / seconds >= 3 OR stop_order = least OR stop_order + 1 = most))""".replace("{dist}", HAVERSINE)
NEED["whole_chain"] = ["ride_events", "whole_chain"]


def order_sizes(s, d):
    """Orders with the number of their lines, which is all of these that a run's pings tell; `copies` and `copy` number the rows of an order that occurs again."""
    sizes = _read(s, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    rows = sizes.join(_read(s, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    same = Window.partitionBy("o_orderkey")
    return rows.select("o_orderkey", "o_custkey", "n", F.count("*").over(same).alias("copies"), F.row_number().over(same.orderBy("o_custkey")).alias("copy"))


def chain_pings(s, d):
    """Pings that were dealt to tasks by vehicle, as the orders that they follow from."""
    orders = order_sizes(s, d).select(
        F.concat(F.lit("p"), (F.col("o_custkey") % 12).cast("string")).alias("route"), F.concat(F.lit("v"), (F.col("o_orderkey") % 3000).cast("string")).alias("plate"), "o_orderkey", "copy", "copies", F.least(F.col("n") * F.col("copies"), F.lit(9)).alias("last")
    ).where("copy <= last")
    parts = line_parts(s, d)
    # An order becomes up to 54 rows of pings near stops.
    orders = orders.repartition(4 * parts, "route", "plate") if parts else orders.repartition("route", "plate")
    lines = orders.withColumn("k", F.explode(F.sequence(F.col("copy").cast("long"), "last", "copies"))).withColumn("i", F.explode(F.array(*map(F.lit, range(3)))))
    t = F.col("o_orderkey") * 7919 % 80000 + F.col("k") * 240 + F.col("o_orderkey") % 97 * F.col("k") + F.col("i") * 25
    day = F.unix_date(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("o_orderkey") % 7).cast("int"))).cast("long") * 86_400
    return lines.select("route", "plate", F.timestamp_seconds(day + t).alias("event_time"), (F.lit(55.7) + F.col("k") / F.lit(200.0)).alias("lat"), (F.lit(49.1) + (F.col("i") - 1) / F.lit(10000.0)).alias("lon"))


def served_stops(s):
    cell = s.range(12 * 2 * 9).select(F.floor(F.col("id") / 18).cast("long").alias("p"), F.floor(F.col("id") % 18 / 9).cast("long").alias("d"), (F.col("id") % 9 + 1).alias("o"))
    side = F.when(F.col("o").isin(4, 7), 0).otherwise(F.col("d"))
    return cell.select(F.concat(F.lit("p"), F.col("p").cast("string")).alias("route"), F.col("d").alias("direction"), (F.col("p") * 100 + F.col("o") * 2 + side).alias("stop_id"), F.when(F.col("d") == 0, F.col("o")).otherwise(10 - F.col("o")).alias("stop_order"), (F.lit(55.7) + F.col("o") / F.lit(200.0)).alias("stop_lat"), (F.lit(49.1) + side / F.lit(10000.0)).alias("stop_lon"))


def whole_chain(s, d):
    found = served_stops(s)
    a = found.select("route", "direction", F.col("stop_id").alias("from_stop"), F.col("stop_order").alias("o"))
    b = found.select("route", "direction", F.col("stop_id").alias("to_stop"), (F.col("stop_order") - 1).alias("o"))
    segments = a.join(b, ["route", "direction", "o"]).drop("o").withColumns({"metres": F.lit(300.0) + F.col("from_stop") % 7 * 100, "segment_id": F.concat_ws("|", "route", "direction", "from_stop", "to_stop"), "physical_id": F.concat_ws("|", "from_stop", "to_stop")})
    return chain.segment_trips(chain_pings(s, d), found, segments, dealt=True)


TRIP = ["service_date", "plate", "route", "direction", "from_stop", "to_stop", "start_at", "end_at", "seconds", "metres", "speed_kmh"]
query("whole_chain_trips", f"SELECT {', '.join(TRIP)} FROM whole", "whole_chain")(lambda s, d: whole_chain(s, d).select(*TRIP).withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start_at", "end_at")}))
query(
    "whole_chain_overtakes",
    """SELECT a.service_date, a.from_stop, a.to_stop, a.plate AS overtaker, b.plate AS overtaken, a.end_at AS overtake_at, a.seconds AS overtaker_s, b.seconds AS overtaken_s FROM whole a JOIN whole b ON a.service_date = b.service_date AND a.from_stop = b.from_stop AND a.to_stop = b.to_stop
  WHERE a.start_at > b.start_at AND a.end_at < b.end_at AND a.plate <> b.plate""",
    "whole_chain",
)(lambda s, d: chain.day_overtakes(whole_chain(s, d), ["from_stop", "to_stop"], parts=line_parts(s, d)).select("service_date", "from_stop", "to_stop", "overtaker", "overtaken", F.col("overtake_at").cast("timestamp_ntz").alias("overtake_at"), "overtaker_s", "overtaken_s"))
