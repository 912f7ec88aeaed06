"""Queries of the operators over projections of the test tables, and SQL that gives the same rows.

Pings are events (plate: user, route: event type); stops are suppliers on the pings' lattice; segment trips are order lines
(segment: part, plate: supplier, from order date to ship date); visits are runs of a plate's pings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo, names, when
from ..operators import journeys, network, packs, rollup, rounds, trips, visits

Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
GAP_S = 43_200

#: Shared parts of the SQL.
PARTS = {
    "pings": """pings AS (SELECT event_id, user_id AS plate, event_type AS route, ts AS event_time, floor(value)::BIGINT AS speed,
  (557000 + (user_id % 20) * 20 + event_id % 7)::DOUBLE / 10000 AS lat, (491000 + (event_id % 25) * 20)::DOUBLE / 10000 AS lon FROM events)""",
    "stops": """stops AS (SELECT s_suppkey AS stop_id, s_name AS stop_name, (557003 + (s_suppkey % 20) * 20)::DOUBLE / 10000 AS stop_lat, (491000 + (s_suppkey % 25) * 20)::DOUBLE / 10000 AS stop_lon FROM supplier)""",
    "gaps": f"""gaps AS (SELECT *, CASE WHEN (epoch_us(event_time) // 1000000) - (epoch_us(lag(event_time) OVER (PARTITION BY plate, route ORDER BY event_time)) // 1000000) <= {GAP_S} THEN 0 ELSE 1 END AS fresh FROM pings)""",
    "visits": """sessions AS (SELECT *, sum(fresh) OVER (PARTITION BY plate, route ORDER BY event_time) AS session FROM gaps),
visits AS (SELECT plate, route, min(event_time) AS entered_at, max(event_time) AS exited_at, count(*) AS points FROM sessions GROUP BY plate, route, session)""",
    "stays": """stays AS (SELECT *, plate::VARCHAR || '|' || route || '|' || (epoch_us(entered_at) // 1000000) AS visit_id, (epoch_us(entered_at) // 1000000) % 12 AS stop_order, (epoch_us(entered_at) // 1000000) // 7 % 2 AS direction, (epoch_us(entered_at) // 1000000) % 12 IN (0, 11) AS is_terminal,
  entered_at::DATE AS service_date, (epoch_us(exited_at) // 1000000) - (epoch_us(entered_at) // 1000000) AS dwell FROM visits)""",
    "trips": """trips AS (SELECT DISTINCT l_orderkey::VARCHAR || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey AS trip_id, l_partkey AS segment_id, l_suppkey AS plate, o_orderdate AS start_at, l_shipdate AS end_at, date_diff('day', o_orderdate, l_shipdate) AS seconds, o_orderdate::DATE AS service_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate)""",
    "over": """over_ AS (SELECT a.segment_id, a.trip_id AS overtaker_id, b.trip_id AS overtaken_id, a.plate AS overtaker, b.plate AS overtaken, a.end_at AS overtake_at FROM trips a JOIN trips b USING (segment_id) WHERE a.start_at > b.start_at AND a.end_at < b.end_at AND a.plate <> b.plate)""",
    "links": """links AS (SELECT DISTINCT l_suppkey % 20 AS from_stop, l_partkey % 20 AS to_stop, date_diff('day', DATE '1992-01-01', o_orderdate) AS dep, date_diff('day', DATE '1992-01-01', l_shipdate) AS arr FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate AND l_suppkey % 20 <> l_partkey % 20)""",
}
NEED = {"visits": ["pings", "gaps", "visits"], "stays": ["pings", "gaps", "visits", "stays"], "over": ["trips", "over"]}


def query(name: str, sql: str | None = None, *parts: str):
    """Registers a query, with SQL over the named parts."""
    def put(f):
        Q[name] = f
        if sql:
            needed = list(dict.fromkeys(x for p in parts for x in NEED.get(p, [p])))
            SQL[name] = ("WITH " + ",\n".join(PARTS[p] for p in needed) + "\n" if needed else "") + sql
        return f

    return put


def _read(s: SparkSession, d: str, t: str) -> DataFrame:
    return s.read.parquet(f"{d}/{t}.parquet")


def pings(s, d):
    lattice = lambda base, step: (F.lit(base) + step).cast("double") / 10000
    return _read(s, d, "events").select("event_id", F.col("user_id").alias("plate"), F.col("event_type").alias("route"), F.col("ts").alias("event_time"), F.floor("value").cast("long").alias("speed"), lattice(557000, (F.col("user_id") % 20) * 20 + F.col("event_id") % 7).alias("lat"), lattice(491000, (F.col("event_id") % 25) * 20).alias("lon"))


def stops(s, d):
    return _read(s, d, "supplier").select(F.col("s_suppkey").alias("stop_id"), F.col("s_name").alias("stop_name"), ((F.lit(557003) + F.col("s_suppkey") % 20 * 20).cast("double") / 10000).alias("stop_lat"), ((F.lit(491000) + F.col("s_suppkey") % 25 * 20).cast("double") / 10000).alias("stop_lon"))


def stays(s, d):
    v = visits.visits_manual(pings(s, d), ["plate", "route"], "event_time", GAP_S)
    t = F.unix_timestamp("entered_at")
    return v.withColumns({"visit_id": F.concat_ws("|", F.col("plate").cast("string"), "route", t.cast("string")), "stop_order": t % 12, "direction": F.expr("unix_timestamp(entered_at) div 7") % 2, "is_terminal": (t % 12).isin(0, 11), "service_date": F.to_date("entered_at"), "dwell": F.unix_timestamp("exited_at") - t})


def line_parts(s, d):
    """Tasks for the order lines of tables that are large for the session's shuffle partitions, else None."""
    return rounds.file_parts(s, f"{d}/lineitem.parquet", f"{d}/orders.parquet")


def order_lines(s, d, wanted=None, held=None, then=None):
    """Order lines with their orders; large tables are dealt to more tasks, so that no task grows with them.  wanted: the columns besides the keys, if not all;
    held: how they are packed on the way; then: what is done to an order's lines before they meet it."""
    lines, orders = _read(s, d, "lineitem"), _read(s, d, "orders")
    if parts := line_parts(s, d):
        lines, orders = (dealt(t, key, parts, wanted, held) for t, key in ((lines, "l_orderkey"), (orders, "o_orderkey")))
    return (then(lines) if then else lines).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def dealt(table, key, parts, wanted=None, held=None):
    """A table dealt to tasks by its key, packed on the way where that is told."""
    if held is None:
        return table.repartition(parts, key)
    columns = [key, *(c for c in table.columns if c in wanted and c != key)]
    own = held.only(columns[1:])
    return own.restored(own.packed(table.select(columns)).repartition(parts, key), columns)


TRIP_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "l_shipdate"]


def trip_packs(s, d):
    """How the columns of trip_lines are packed; None where the tables are small."""
    if not line_parts(s, d):
        return None
    lines = packs.measured(_read(s, d, "lineitem"), [c for c in TRIP_LINE if c.startswith("l_")])
    return lines | packs.measured(_read(s, d, "orders"), ["o_orderdate"])


def trip_lines(s, d, held=None):
    """A row for each segment trip, with the columns of the tables that its own follow from.  held: trip_packs, if they are known."""
    rows = order_lines(s, d, TRIP_LINE, held or trip_packs(s, d)).where("l_shipdate > o_orderdate")
    # The numbers tell rows apart as well as their text does; told apart by order first, they stay where the join put them.
    return rows.select(*TRIP_LINE).distinct()


def trip_columns(c=F.col):
    return {
        "trip_id": F.concat_ws("|", *(c(x).cast("string") for x in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))),
        "segment_id": c("l_partkey"),
        "plate": c("l_suppkey"),
        "start_at": c("o_orderdate"),
        "end_at": c("l_shipdate"),
        "seconds": F.date_diff(c("l_shipdate"), c("o_orderdate")).cast("long"),
        "service_date": F.to_date(c("o_orderdate")),
    }


def segment_trips(s, d):
    return trip_lines(s, d).select(*(c.alias(name) for name, c in trip_columns().items()))


def dealt_trips(s, d):
    """Segment trips that were dealt to tasks by their segment, those of large tables as the lines that they follow from."""
    if not (parts := line_parts(s, d)):
        return segment_trips(s, d).repartition("segment_id")
    held = trip_packs(s, d)
    rows = dealt(trip_lines(s, d, held), "l_partkey", parts, TRIP_LINE, held)
    return rows.select(*(c.alias(name) for name, c in trip_columns().items()))


def rides(s, d):
    """Links as often as they occur, for what doesn't mind repeats."""
    rows = order_lines(s, d).where("l_shipdate > o_orderdate and l_suppkey % 20 <> l_partkey % 20")
    day = lambda c: F.date_diff(F.col(c), F.lit("1992-01-01").cast("date")).cast("long")
    return rows.select((F.col("l_suppkey") % 20).alias("from_stop"), (F.col("l_partkey") % 20).alias("to_stop"), day("o_orderdate").alias("dep"), day("l_shipdate").alias("arr"))


def links(s, d):
    return rides(s, d).distinct()


def plated(found):
    """Links with a vehicle."""
    return found.withColumn("plate", (F.col("dep") * 7 + F.col("arr")) % 5)


def origins(s):
    return s.range(20).select(F.col("id").alias("origin"), F.col("id").alias("stop"), F.lit(0).cast("long").alias("at"))


def over(s, d):
    return trips.overtakes(segment_trips(s, d), ["segment_id"])


query("ping_count", "SELECT count(*) AS n, max((epoch_us(event_time) // 1000000)) AS last FROM pings", "pings")(lambda s, d: pings(s, d).agg(F.count("*").alias("n"), F.max(F.unix_timestamp("event_time")).alias("last")))
query("ping_bbox_filter", "SELECT event_id, plate FROM pings WHERE lat BETWEEN 55.71 AND 55.73 AND lon BETWEEN 49.11 AND 49.13 AND speed BETWEEN 0 AND 140", "pings")(lambda s, d: pings(s, d).where(F.col("lat").between(55.71, 55.73) & F.col("lon").between(49.11, 49.13) & F.col("speed").between(0, 140)).select("event_id", "plate"))
query("ping_null_filter", "SELECT event_id FROM pings WHERE event_time IS NOT NULL AND lat IS NOT NULL AND plate IS NOT NULL", "pings")(lambda s, d: pings(s, d).dropna(subset=["event_time", "lat", "plate"]).select("event_id"))
query("dedup_identity_minmax", "SELECT plate, route, lat, lon, min(event_id) AS event_id, max(speed) AS speed FROM pings GROUP BY ALL", "pings")(lambda s, d: visits.dedup_pings(pings(s, d), ["plate", "route", "lat", "lon"], ["event_id"], ["speed"]))
query("dedup_ingest_key", "SELECT DISTINCT plate, route, event_time FROM pings", "pings")(lambda s, d: pings(s, d).select("plate", "route", "event_time").dropDuplicates())
query("stats_5min", "SELECT (epoch_us(event_time) // 1000000) // 300 * 300 AS bucket, count(*) AS n FROM pings GROUP BY 1", "pings")(lambda s, d: pings(s, d).groupBy(F.window("event_time", "5 minutes").alias("w")).agg(F.count("*").alias("n")).select(F.unix_timestamp("w.start").alias("bucket"), "n"))
query("stats_5min_zero_filled", "SELECT bucket, coalesce(n, 0)::BIGINT AS n FROM (SELECT unnest(range(min(b), max(b) + 300, 300)) AS bucket FROM (SELECT (epoch_us(event_time) // 1000000) // 300 * 300 AS b FROM pings)) LEFT JOIN (SELECT (epoch_us(event_time) // 1000000) // 300 * 300 AS bucket, count(*) AS n FROM pings GROUP BY 1) USING (bucket)", "pings")(lambda s, d: rollup.zero_filled(pings(s, d), "event_time", 300))
query("tumbling_15min_stop", "SELECT plate, (epoch_us(event_time) // 1000000) // 900 * 900 AS bucket, min(speed) AS least, max(speed) AS most FROM pings GROUP BY ALL", "pings")(lambda s, d: pings(s, d).groupBy("plate", F.window("event_time", "15 minutes").alias("w")).agg(F.min("speed").alias("least"), F.max("speed").alias("most")).select("plate", F.unix_timestamp("w.start").alias("bucket"), "least", "most"))
VISITS_SQL = "SELECT plate, route, entered_at, exited_at, points FROM visits"
query("session_visits_manual", VISITS_SQL, "visits")(lambda s, d: visits.visits_manual(pings(s, d), ["plate", "route"], "event_time", GAP_S))
query("session_visits_builtin", VISITS_SQL.replace("entered_at, exited_at", "date_trunc('second', entered_at) AS entered_at, date_trunc('second', exited_at) AS exited_at"), "visits")(lambda s, d: visits.visits_builtin(pings(s, d).withColumn("event_time", F.date_trunc("second", "event_time")), ["plate", "route"], "event_time", GAP_S).withColumns({"entered_at": F.col("entered_at").cast("timestamp_ntz"), "exited_at": F.col("exited_at").cast("timestamp_ntz")}))
HAVERSINE = "2 * 6371000.0::DOUBLE * asin(sqrt(pow(sin(radians(stop_lat - lat) / 2), 2) + cos(radians(lat)) * cos(radians(stop_lat)) * pow(sin(radians(stop_lon - lon) / 2), 2)))"
NEAR_SQL = f"SELECT event_id, stop_id FROM pings, stops WHERE abs(lat - stop_lat) < 0.001 AND {HAVERSINE} <= 40"
query("geo_grid_join", NEAR_SQL, "pings", "stops")(lambda s, d: visits.geo_join(pings(s, d), stops(s, d), 40.0).select("event_id", "stop_id"))
query("ambiguous_having", "SELECT plate, stop_order, count(DISTINCT direction) AS directions FROM stays GROUP BY ALL HAVING count(DISTINCT direction) > 1", "stays")(lambda s, d: visits.ambiguous(stays(s, d), ["plate", "stop_order"]))
ODD = "SELECT plate, stop_order FROM stays GROUP BY ALL HAVING count(DISTINCT direction) > 1"
query("direction_safe_visits", f"SELECT visit_id FROM stays WHERE is_terminal OR (plate, stop_order) NOT IN ({ODD})", "stays")(lambda s, d: visits.direction_safe(stays(s, d), ["plate", "stop_order"]).select("visit_id"))
query("dwell_dedup_rank", "SELECT plate, service_date, visit_id FROM stays QUALIFY row_number() OVER (PARTITION BY plate, service_date ORDER BY is_terminal, stop_order, visit_id) = 1", "stays")(lambda s, d: visits.dwell_dedup(stays(s, d).withColumn("stop_order", F.struct("stop_order", "visit_id")), ["plate", "service_date"]).select("plate", "service_date", "visit_id"))
query("next_stop_trips", "SELECT a.visit_id AS start_id, arg_min(b.visit_id, (b.entered_at, b.visit_id)) AS end_id, min((epoch_us(b.entered_at) // 1000000) - (epoch_us(a.exited_at) // 1000000)) AS seconds FROM stays a JOIN stays b ON a.plate = b.plate AND b.stop_order = a.stop_order + 1 AND (epoch_us(b.entered_at) // 1000000) - (epoch_us(a.exited_at) // 1000000) BETWEEN 1 AND 864000 GROUP BY 1", "stays")(lambda s, d: trips.next_stop_trips(stays(s, d), ["plate"], max_gap_s=864000))
query("trip_speed_filter", "SELECT trip_id FROM trips WHERE seconds <= 120 AND (seconds >= 30 OR segment_id % 12 = 0 OR segment_id % 12 = 11)", "trips")(lambda s, d: trips.plausible(segment_trips(s, d).withColumns({"speed_kmh": F.col("seconds"), "start_order": F.col("segment_id") % 12, "end_order": F.col("segment_id") % 12, "min_order": F.lit(0), "max_order": F.lit(11)}), 30, 120).select("trip_id"))
query("overtakes_route", "SELECT * FROM over_", "over")(over)
query("overtakes_bucketed", "SELECT * FROM over_", "over")(lambda s, d: trips.overtakes(dealt_trips(s, d), ["segment_id"], 30 * 86400, dealt=True))
query("overtakes_physical", "SELECT a.physical, a.trip_id AS overtaker_id, b.trip_id AS overtaken_id, a.plate AS overtaker, b.plate AS overtaken, a.end_at AS overtake_at FROM (SELECT *, segment_id // 2 AS physical FROM trips) a JOIN (SELECT *, segment_id // 2 AS physical FROM trips) b USING (physical) WHERE a.start_at > b.start_at AND a.end_at < b.end_at AND a.plate <> b.plate", "trips")(lambda s, d: trips.overtakes(segment_trips(s, d).withColumn("physical", F.expr("segment_id div 2")), ["physical"]))
for grain, dims in {"segment": ["segment_id"], "segment_vehicle": ["segment_id", "overtaker"], "vehicle": ["overtaker"]}.items():
    cols = ", ".join(dims)
    query(f"overtake_daily_{grain}", f"SELECT overtake_at::DATE AS service_date, {cols}, count(*) AS n, max(overtake_at) AS last_at, arg_max(overtaken, (overtake_at, overtaker_id, overtaken_id)) AS last_overtaken FROM over_ GROUP BY ALL", "over")(lambda s, d, dims=dims: rollup.daily(over(s, d).withColumn("service_date", F.to_date("overtake_at")), dims, {"n": F.count("*"), "last_at": F.max("overtake_at"), "last_overtaken": F.max(F.struct("overtake_at", "overtaker_id", "overtaken_id", "overtaken"))["overtaken"]}))
    query(f"overtake_summary_{grain}", f"SELECT {cols}, weekday_iso, sum(n)::BIGINT AS n, count(*) AS days, max(n) AS most FROM (SELECT *, unnest([0, isodow(day)::INTEGER]) AS weekday_iso FROM (SELECT overtake_at::DATE AS day, {cols}, count(*) AS n FROM over_ GROUP BY ALL)) GROUP BY ALL", "over")(lambda s, d, dims=dims: rollup.summary(rollup.daily(over(s, d).withColumn("service_date", F.to_date("overtake_at")), dims, {"n": F.count("*")}), dims, {"n": F.sum("n"), "days": F.count("*"), "most": F.max("n")}))
query("overtake_top10", "SELECT overtaker, count(*) AS n FROM over_ GROUP BY 1 ORDER BY n DESC, overtaker LIMIT 10", "over")(lambda s, d: over(s, d).groupBy("overtaker").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "overtaker").limit(10))
for grain, dims in {"stop": ["stop_order"], "stop_route": ["stop_order", "route"], "route": ["route"], "vehicle": ["plate"]}.items():
    cols = ", ".join(dims)
    query(f"rubber_daily_{grain}", f"SELECT service_date, terminal_policy, {cols}, sum(dwell)::BIGINT AS total, max(dwell) AS most, count(*) AS n FROM (SELECT *, 'with' AS terminal_policy FROM stays UNION ALL SELECT *, 'without' FROM stays WHERE NOT is_terminal) GROUP BY ALL", "stays")(lambda s, d, dims=dims: rollup.daily(rollup.terminal_policies(stays(s, d)), ["terminal_policy", *dims], {"total": F.sum("dwell"), "most": F.max("dwell"), "n": F.count("*")}))
    query(f"rubber_summary_{grain}", f"SELECT weekday_iso, {cols}, sum(dwell)::BIGINT AS total, count(DISTINCT service_date) AS days FROM (SELECT *, 0 AS weekday_iso FROM stays UNION ALL SELECT *, isodow(service_date)::INTEGER FROM stays) GROUP BY ALL", "stays")(lambda s, d, dims=dims: rollup.summary(stays(s, d), dims, {"total": F.sum("dwell"), "days": F.countDistinct("service_date")}))
query("rubber_long_dwell", "SELECT route, count(*) AS n, sum(dwell)::BIGINT AS total FROM stays WHERE dwell > 60 GROUP BY 1", "stays")(lambda s, d: stays(s, d).where("dwell > 60").groupBy("route").agg(F.count("*").alias("n"), F.sum("dwell").alias("total")))
query("rubber_ratio_lead", "SELECT plate, route, sum((epoch_us(exited_at) // 1000000) - (epoch_us(entered_at) // 1000000))::BIGINT AS wait_s, coalesce(sum((epoch_us(nxt) // 1000000) - (epoch_us(exited_at) // 1000000)), 0)::BIGINT AS move_s FROM (SELECT *, lead(entered_at) OVER (PARTITION BY plate, route ORDER BY entered_at) AS nxt FROM visits) GROUP BY ALL", "visits")(lambda s, d: trips.waits_and_moves(stays(s, d), ["plate", "route"]))
for grain, dims in {"route_stop": ["route", "stop_order"], "route": ["route"], "stop": ["stop_order"]}.items():
    cols = ", ".join(dims)
    query(f"last_pass_daily_{grain}", f"SELECT (exited_at + INTERVAL 3 HOUR)::DATE AS service_date, {cols}, max(exited_at) AS last_pass_at, arg_max(plate, (exited_at, plate)) AS plate FROM stays GROUP BY ALL", "stays")(lambda s, d, dims=dims: visits.last_pass(stays(s, d), dims, "Europe/Moscow"))
    query(f"last_pass_summary_{grain}", f"SELECT {cols}, weekday_iso, sum(hour(t) * 3600 + minute(t) * 60 + second(t))::BIGINT AS seconds, count(*) AS sample_days FROM (SELECT *, unnest([0, isodow(service_date)::INTEGER]) AS weekday_iso FROM (SELECT exited_at::DATE AS service_date, {cols}, max(exited_at) AS t FROM stays GROUP BY ALL)) GROUP BY ALL", "stays")(lambda s, d, dims=dims: rollup.summary(visits.last_pass(stays(s, d), dims).withColumn("sec", when.second_of_day(F.col("last_pass_at"))), dims, {"seconds": F.sum("sec"), "sample_days": F.count("*")}))
query("speed_point_grid", "SELECT floor(lat * 1000)::BIGINT AS y, floor(lon * 1000)::BIGINT AS x, count(*) AS n, sum(speed)::BIGINT AS total, max(speed) AS most FROM pings GROUP BY ALL", "pings")(lambda s, d: pings(s, d).groupBy(F.floor(F.col("lat") * 1000).cast("long").alias("y"), F.floor(F.col("lon") * 1000).cast("long").alias("x")).agg(F.count("*").alias("n"), F.sum("speed").alias("total"), F.max("speed").alias("most")))
query("speed_segment_daily", "SELECT service_date, segment_id, count(*) AS n, sum(seconds)::BIGINT AS total, min(seconds) AS least, max(seconds) AS most FROM trips GROUP BY ALL", "trips")(lambda s, d: rollup.daily(segment_trips(s, d), ["segment_id"], {"n": F.count("*"), "total": F.sum("seconds"), "least": F.min("seconds"), "most": F.max("seconds")}))
DAILY = "SELECT segment_id, service_date, sum(seconds) AS total, count(*) AS n FROM trips GROUP BY ALL"
query("speed_summary_weighted", f"SELECT segment_id, sum(total)::DOUBLE / sum(n)::DOUBLE AS mean FROM ({DAILY}) GROUP BY 1", "trips")(lambda s, d: segment_trips(s, d).groupBy("segment_id", "service_date").agg(F.sum("seconds").alias("total"), F.count("*").alias("n")).groupBy("segment_id").agg((F.sum("total").cast("double") / F.sum("n")).alias("mean")))
query("speed_summary_unweighted", f"SELECT segment_id, sum(total * 1000 // n)::BIGINT AS milli_sum, count(*) AS days FROM ({DAILY}) GROUP BY 1", "trips")(lambda s, d: segment_trips(s, d).groupBy("segment_id", "service_date").agg(F.sum("seconds").alias("total"), F.count("*").alias("n")).groupBy("segment_id").agg(F.sum(F.expr("total * 1000 div n")).alias("milli_sum"), F.count("*").alias("days")))
MERC = "floor((0.5 - ln((1 + sin(radians(lat))) / (1 - sin(radians(lat)))) / (4 * pi())) * 256 * pow(2, zoom) / 6)::BIGINT"
query("speed_mercator_buckets", f"SELECT zoom, floor((lon + 180) / 360 * 256 * pow(2, zoom) / 6)::BIGINT AS x, {MERC} AS y, count(*) AS n, sum(speed)::BIGINT AS total FROM pings, (SELECT unnest(range(11, 16))::INTEGER AS zoom) GROUP BY ALL", "pings")(lambda s, d: pings(s, d).withColumn("zoom", F.explode(F.array(*map(F.lit, range(11, 16))))).groupBy("zoom", F.floor(geo.mercator_x(F.col("lon"), F.col("zoom")) / 6).cast("long").alias("x"), F.floor(geo.mercator_y(F.col("lat"), F.col("zoom")) / 6).cast("long").alias("y")).agg(F.count("*").alias("n"), F.sum("speed").alias("total")))
TILE = "sum(seconds) FILTER ({0} = 1)::BIGINT AS {0}_sum, count(*) FILTER ({0} = 1) AS {0}_n"
query(
    "speed_ntile_ratio",
    f"""SELECT segment_id, {TILE.format("q")}, {TILE.format("s")}, avg(seconds) FILTER (s = 1) / avg(seconds) FILTER (q = 1) AS ratio FROM (
  SELECT *, ntile(10) OVER (PARTITION BY segment_id ORDER BY seconds, trip_id) AS q, ntile(10) OVER (PARTITION BY segment_id ORDER BY seconds DESC, trip_id DESC) AS s FROM trips) GROUP BY 1""",
    "trips",
)(lambda s, d: trips.decile_ratio(segment_trips(s, d)))
query("fastest_slowest_pairs", "SELECT segment_id, arg_min(plate, (seconds, plate, trip_id)) AS fast_plate, arg_max(plate, (seconds, plate, trip_id)) AS slow_plate, min(seconds) AS fast_s, max(seconds) AS slow_s FROM trips GROUP BY 1 HAVING fast_plate <> slow_plate", "trips")(lambda s, d: trips.fastest_slowest(segment_trips(s, d)))
query(
    "last_movement_two_day",
    """SELECT route, max(event_time) FILTER (speed > 0 AND event_time::DATE = top) AS today, max(event_time) FILTER (speed > 0 AND event_time::DATE = top - 1) AS yesterday
  FROM pings, (SELECT max(event_time)::DATE AS top FROM pings) GROUP BY 1""",
    "pings",
)(lambda s, d: rollup.last_movement(pings(s, d)))
query(
    "active_traces_last_n",
    "SELECT plate, event_id FROM pings QUALIFY row_number() OVER (PARTITION BY plate ORDER BY event_time DESC, event_id DESC) <= 100",
    "pings",
)(lambda s, d: rollup.active_traces(pings(s, d)).select("plate", "event_id"))
query("details_page", "SELECT trip_id, seconds FROM trips ORDER BY seconds DESC, trip_id LIMIT 50 OFFSET 50", "trips")(lambda s, d: rollup.page(segment_trips(s, d), [F.desc("seconds"), F.col("trip_id")], 2).select("trip_id", "seconds"))
query(
    "route_natural_sort",
    """SELECT p_partkey, CASE WHEN digits = '' THEN '9999' WHEN length(ltrim(digits, '0')) < 4 THEN lpad(ltrim(digits, '0'), 4, '0') ELSE ltrim(digits, '0') END || ':'
  || CASE WHEN electric THEN 'Т' ELSE '' END || ':' || regexp_replace(bare, '[0-9]', '', 'g') || ':' || name AS key
  FROM (SELECT *, regexp_replace(bare, '[^0-9]', '', 'g') AS digits FROM (SELECT p_partkey, name, name LIKE 'Т%' AS electric, CASE WHEN name LIKE 'Т%' THEN substr(name, 2) ELSE name END AS bare
  FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'Т' ELSE '' END || CASE WHEN p_partkey % 5 = 0 THEN p_name ELSE p_partkey * 37 || 'a' || p_partkey % 3 END AS name FROM part)))""",
)(
    lambda s, d: _read(s, d, "part")
    .withColumn("name", F.concat(F.when(F.col("p_partkey") % 3 == 0, names.ELECTRIC).otherwise(""), F.when(F.col("p_partkey") % 5 == 0, F.col("p_name")).otherwise(F.concat(F.col("p_partkey") * 37, F.lit("a"), F.col("p_partkey") % 3))))
    .select("p_partkey", names.route_sort_key(F.col("name")).alias("key"))
)
query("service_date_tz", "SELECT event_id, (event_time + INTERVAL 3 HOUR)::DATE AS service_date, isodow((event_time + INTERVAL 3 HOUR)::DATE)::INTEGER AS weekday_iso FROM pings", "pings")(lambda s, d: pings(s, d).select("event_id", when.service_date(F.col("event_time")).alias("service_date")).withColumn("weekday_iso", when.weekday_iso(F.col("service_date"))))
query(
    "clock_shift_backfill",
    """SELECT event_id, (epoch_us(event_time) // 1000000) + greatest(0, m - t) AS shifted FROM pings JOIN (SELECT route, max(epoch_us(event_time) // 1000000) AS t, max(event_id) % 5000 * 1000 + 1700000000 AS m
  FROM pings GROUP BY 1) USING (route)""",
    "pings",
)(
    lambda s, d: rollup.shift_clock(
        pings(s, d), pings(s, d).groupBy("route").agg((F.max("event_id") % 5000 * 1000 + 1_700_000_000).alias("modified")), "route"
    ).select("event_id", "shifted")
)
ROUTE = "route_stops AS (SELECT p_brand AS route, p_partkey AS stop_id, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS stop_order, sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING)::BIGINT AS distance FROM part)"
PARTS["route"] = ROUTE


def route_stops(s, d):
    rows = _read(s, d, "part").select(F.col("p_brand").alias("route"), F.col("p_partkey").alias("stop_id"), F.col("p_size").cast("long").alias("step"))
    return network.cumulative(rows, "route", "stop_id", "step").withColumn("stop_order", F.row_number().over(Window.partitionBy("route").orderBy("stop_id")).cast("long")).drop("step")


query("cumulative_route_distance", "SELECT * FROM route_stops", "route")(route_stops)
query("ride_edges_pairs", "SELECT a.route, a.stop_id AS from_stop, b.stop_id AS to_stop, b.distance - a.distance AS meters FROM route_stops a JOIN route_stops b ON a.route = b.route AND a.stop_order < b.stop_order", "route")(lambda s, d: network.ride_edges(route_stops(s, d)))
query("walk_edges_radius", f"SELECT a.stop_id AS from_stop, b.stop_id AS to_stop FROM (SELECT stop_id, stop_lat AS lat, stop_lon AS lon FROM stops) a, stops b WHERE a.stop_id <> b.stop_id AND {HAVERSINE} <= 300", "stops")(lambda s, d: network.walk_edges(stops(s, d)).select("from_stop", "to_stop"))
ROUND = "r{1} AS (SELECT origin, stop, min(\"at\") AS \"at\" FROM (SELECT * FROM r{0} UNION ALL SELECT origin, to_stop, arr FROM r{0} JOIN links ON stop = from_stop AND dep >= \"at\") GROUP BY ALL)"
PARTS["rounds"] = "r0 AS (SELECT i AS origin, i AS stop, 0::BIGINT AS \"at\" FROM range(20) t(i)),\n" + ",\n".join(ROUND.format(k, k + 1) for k in range(3))
query("earliest_arrival_rounds", "SELECT origin, stop, \"at\" FROM r3", "links", "rounds")(
    lambda s, d: journeys.earliest_journeys(plated(rides(s, d)), origins(s)).select("origin", "stop", "at")
)
query("next_departure_asof", "SELECT from_stop, \"at\", min(dep) AS dep FROM links JOIN (SELECT unnest(range(0, 2400, 100)) AS \"at\") ON dep >= \"at\" GROUP BY ALL", "links")(lambda s, d: network.next_departure(links(s, d).select("from_stop").distinct().crossJoin(F.broadcast(s.range(0, 2400, 100).withColumnRenamed("id", "at"))), links(s, d), ["from_stop"]))
query("skip_stop_interpolation", "SELECT plate, visit_id, missed::BIGINT AS missed, ((a + (n - a) * (missed - stop_order) // (o - stop_order)))::BIGINT AS arrival FROM (SELECT *, unnest(range(stop_order + 1, o)) AS missed FROM (SELECT *, lead(stop_order) OVER w AS o, (epoch_us(lead(entered_at) OVER w) // 1000000) AS n, (epoch_us(exited_at) // 1000000) AS a FROM stays WINDOW w AS (PARTITION BY plate ORDER BY entered_at, visit_id)) WHERE o > stop_order + 1 AND n - a BETWEEN 1 AND 86400)", "stays")(lambda s, d: trips.skipped_stops(stays(s, d), ["plate"], 86400))
query("od_summary", "SELECT from_stop, to_stop, min(arr - dep) AS least, count(*) AS n, sum(arr - dep)::BIGINT AS total FROM links GROUP BY ALL", "links")(lambda s, d: links(s, d).groupBy("from_stop", "to_stop").agg(F.min(F.expr("arr - dep")).alias("least"), F.count("*").alias("n"), F.sum(F.expr("arr - dep")).alias("total")))
query("od_pattern_mode", "SELECT from_stop, arg_max(to_stop, (n, -to_stop)) AS to_stop, max(n) AS n FROM (SELECT from_stop, to_stop, count(*) AS n FROM links GROUP BY ALL) GROUP BY 1", "links")(lambda s, d: links(s, d).groupBy("from_stop", "to_stop").agg(F.count("*").alias("n")).groupBy("from_stop").agg(F.max(F.struct("n", (-F.col("to_stop")).alias("t"), "to_stop")).alias("b")).select("from_stop", F.col("b.to_stop").alias("to_stop"), F.col("b.n").alias("n")))
query("walk_best_nearest", "SELECT place, arg_min(stop, (t, stop)) AS best_stop, min(t)::BIGINT AS best_at, arg_min(stop, (m, stop)) AS nearest_stop FROM (SELECT s_suppkey AS place, r_regionkey AS stop, (s_suppkey * 7 + r_regionkey * 13) % 50 AS m, r_regionkey * 5 + (s_suppkey * 7 + r_regionkey * 13) % 50 AS t FROM supplier, region) GROUP BY 1")(lambda s, d: network.access(_read(s, d, "supplier").crossJoin(F.broadcast(_read(s, d, "region").select("r_regionkey"))).select(F.col("s_suppkey").alias("place"), F.col("r_regionkey").alias("stop"), ((F.col("s_suppkey") * 7 + F.col("r_regionkey") * 13) % 50).alias("meters")), _read(s, d, "region").select(F.col("r_regionkey").alias("stop"), (F.col("r_regionkey") * 5).alias("at")), 1.0))
CELLS = "cells AS (SELECT DISTINCT p_partkey % 97 AS x, p_size::BIGINT AS y FROM part)"
PARTS["cells"] = CELLS
query("grid_dilation_cells", "SELECT DISTINCT x + dx AS x, y + dy AS y FROM cells, (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy) WHERE dx * dx + dy * dy <= 4", "cells")(lambda s, d: network.dilate(_read(s, d, "part").select((F.col("p_partkey") % 97).alias("x"), F.col("p_size").cast("long").alias("y")).distinct(), 2))
query("household_cell_sum", "SELECT p_partkey % 97 AS x, p_size % 10 AS y, sum(greatest(1, p_size))::BIGINT AS flats FROM part GROUP BY ALL")(lambda s, d: _read(s, d, "part").groupBy((F.col("p_partkey") % 97).alias("x"), (F.col("p_size") % 10).alias("y")).agg(F.sum(F.greatest(F.lit(1), F.col("p_size"))).alias("flats")))
query("month_weekday_sum", "SELECT month(service_date)::INTEGER AS month, isodow(service_date)::INTEGER AS weekday_iso, segment_id % 10 AS piece, sum(seconds)::BIGINT AS total, count(*) AS n FROM trips GROUP BY ALL", "trips")(lambda s, d: segment_trips(s, d).groupBy(F.month("service_date").alias("month"), when.weekday_iso(F.col("service_date")).alias("weekday_iso"), (F.col("segment_id") % 10).alias("piece")).agg(F.sum("seconds").alias("total"), F.count("*").alias("n")))
query(
    "same_name_clusters",
    f"""SELECT node AS stop_id, min(other) AS label FROM (WITH RECURSIVE e AS (
  SELECT a.stop_id AS x, b.stop_id AS y FROM (SELECT stop_id, stop_lat AS lat, stop_lon AS lon, stop_id % 3 AS name FROM stops) a, stops b WHERE name = b.stop_id % 3 AND {HAVERSINE} <= 300),
  reach AS (SELECT x AS node, x AS other FROM e UNION SELECT node, y FROM reach JOIN e ON other = x) SELECT * FROM reach) GROUP BY 1""",
    "stops",
)(lambda s, d: network.named_clusters(stops(s, d).withColumn("stop_name", F.concat(F.when(F.col("stop_id") % 2 == 0, " Stop ").otherwise("stop "), F.col("stop_id") % 3)), 300.0))
PARTS["corners"] = """corners AS (SELECT DISTINCT component, x + i AS x, y + j AS y FROM (
  SELECT p_partkey % 5 AS component, p_size::BIGINT AS y, unnest([min(p_partkey % 97), max(p_partkey % 97) + 1]) AS x FROM part GROUP BY 1, 2), (SELECT 0 AS i), (SELECT unnest([0, 1]) AS j))"""
query(
    "contour_hull_area",
    """SELECT component, sum(cross_) / 2.0 AS area FROM (SELECT a.component, (a.x * b.y - a.y * b.x)::DOUBLE AS cross_ FROM corners a JOIN corners b ON a.component = b.component AND (a.x <> b.x OR a.y <> b.y)
  WHERE NOT EXISTS (SELECT 1 FROM corners p WHERE p.component = a.component AND ((b.x - a.x) * (p.y - a.y) - (b.y - a.y) * (p.x - a.x) < 0
  OR ((b.x - a.x) * (p.y - a.y) = (b.y - a.y) * (p.x - a.x) AND ((p.x - a.x) * (p.x - b.x) > 0 OR (p.y - a.y) * (p.y - b.y) > 0))))) GROUP BY 1""",
    "corners",
)(lambda s, d: network.contour_areas(_read(s, d, "part").select((F.col("p_partkey") % 5).alias("component"), (F.col("p_partkey") % 97).alias("x"), F.col("p_size").cast("long").alias("y")).distinct()))


def shortest_links(s, d):
    return rides(s, d).groupBy("from_stop", "to_stop").agg(F.min(F.expr("arr - dep")).cast("double").alias("meters"))


def step_walks(s):
    """A walk of 3 m from every fourth stop to the next."""
    return s.range(0, 20, 4).select(F.col("id").alias("from_stop"), (F.col("id") + 1).alias("to_stop"), F.lit(3.0).alias("meters"))


PARTS["edges"] = "edges AS (SELECT from_stop, to_stop, min(arr - dep)::DOUBLE AS meters FROM links GROUP BY ALL),\nwalks AS (SELECT unnest(range(0, 20, 4)) AS from_stop, from_stop + 1 AS to_stop, 3.0::DOUBLE AS meters)"
PARTS["paths"] = "w0 AS (SELECT DISTINCT from_stop AS origin, from_stop AS stop, [from_stop] AS path, []::BOOLEAN[] AS walked, 0::DOUBLE AS meters, 0 AS rides FROM links),\n" + ",\n".join(
    f"""r_{k} AS (SELECT origin, to_stop AS stop, list_append(path, to_stop) AS path, list_append(walked, false) AS walked, p.meters + e.meters AS meters, rides + 1 AS rides FROM w{k - 1} p JOIN edges e ON stop = from_stop WHERE NOT list_contains(path, to_stop)),
w{k} AS (SELECT * FROM r_{k} UNION ALL SELECT origin, to_stop, list_append(path, to_stop), list_append(walked, true), p.meters + w.meters, rides FROM r_{k} p JOIN walks w ON stop = from_stop WHERE NOT list_contains(path, to_stop))"""
    for k in (1, 2, 3)
) + """,
paths AS (SELECT * FROM (SELECT *, min(meters) OVER (PARTITION BY origin, stop) AS least FROM (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3))
  WHERE meters <= least * 1.5 QUALIFY row_number() OVER (PARTITION BY origin, stop ORDER BY rides, meters, array_to_string(path, '>'), walked) <= 8)"""
NEED["paths"] = ["links", "edges", "paths"]


def static_paths(s, d):
    return network.k_paths(shortest_links(s, d), rides(s, d).select(F.col("from_stop").alias("origin")).distinct(), walks=step_walks(s))


#: Stops two apart count as one place for every fifth stop.
PARTS["clustered"] = """clustered AS (SELECT * FROM (SELECT *, min(meters) OVER (PARTITION BY origin, stop) AS least FROM (
  SELECT origin, stop, path, walked, meters, rides FROM every UNION ALL SELECT origin, to_stop, list_append(path, to_stop), list_append(walked, true), e.meters + 5, rides FROM every e JOIN (SELECT unnest(range(0, 18, 5)) AS from_stop, from_stop + 2 AS to_stop) c ON stop = from_stop WHERE NOT list_contains(path, to_stop)))
  WHERE meters <= least * 1.5 QUALIFY row_number() OVER (PARTITION BY origin, stop ORDER BY rides, meters, array_to_string(path, '>'), walked) <= 8)"""
PARTS["every"] = "every AS (SELECT * FROM w1 UNION ALL SELECT * FROM w2 UNION ALL SELECT * FROM w3)"
query("static_k_paths_clusters", "SELECT origin, stop, array_to_string(path, '>') AS path, meters, rides FROM clustered", "paths", "every", "clustered")(
    lambda s, d: network.k_paths(
        shortest_links(s, d), rides(s, d).select(F.col("from_stop").alias("origin")).distinct(), walks=step_walks(s), clusters=s.range(0, 18, 5).select(F.col("id").alias("from_stop"), (F.col("id") + 2).alias("to_stop"), F.lit(5.0).alias("meters"))
    ).select("origin", "stop", F.array_join("path", ">").alias("path"), "meters", "rides")
)
query("static_k_paths", "SELECT origin, stop, array_to_string(path, '>') AS path, meters, rides FROM paths", "paths")(
    lambda s, d: static_paths(s, d).select("origin", "stop", F.array_join("path", ">").alias("path"), "meters", "rides")
)
query(
    "road_dijkstra",
    """SELECT stop, node, min(meters) AS meters FROM (WITH RECURSIVE e AS (SELECT s_suppkey AS a, s_suppkey % 97 + 1 AS b FROM supplier UNION SELECT s_suppkey % 97 + 1, s_suppkey FROM supplier),
  walk AS (SELECT s_suppkey AS stop, s_suppkey AS node, 0::DOUBLE AS meters FROM supplier UNION SELECT stop, b, meters + 150 FROM walk JOIN e ON node = a WHERE meters + 150 <= 600) SELECT * FROM walk) GROUP BY ALL""",
)(
    lambda s, d: network.road_walks(
        stops(s, d).select(F.col("stop_id").alias("a"), (F.col("stop_id") % 97 + 1).alias("b"), F.lit(150.0).alias("meters")), stops(s, d).select(F.col("stop_id").alias("stop"), F.col("stop_id").alias("node")), 600.0
    )
)
