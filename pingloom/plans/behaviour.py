"""Queries of the core chain, the daily tables and their summaries in all grains, heats, and the read functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chain, containment, packs, rollup, rounds, trips
from .queries import GAP_S, HAVERSINE, NEED, PARTS, _read, line_parts, pings, query, segment_trips, stays, trip_columns, trip_lines, trip_packs

PARTS |= {
    "months": """months AS (SELECT *, date_trunc('month', start_at)::DATE AS day, segment_id % 7 AS route, segment_id // 2 AS physical FROM trips)""",
    "same_day": """same_day AS (SELECT day AS service_date, segment_id, a.route, a.trip_id AS overtaker_id, b.trip_id AS overtaken_id, a.plate AS overtaker, b.plate AS overtaken,
  a.end_at AS overtake_at, a.seconds AS overtaker_s, b.seconds AS overtaken_s FROM months a JOIN months b USING (segment_id, day)
  WHERE a.start_at > b.start_at AND a.end_at < b.end_at AND a.plate <> b.plate)""",
    "same_place": """same_place AS (SELECT day AS service_date, physical, a.trip_id AS overtaker_id, b.trip_id AS overtaken_id, a.plate AS overtaker, b.plate AS overtaken,
  a.end_at AS overtake_at, a.seconds AS overtaker_s, b.seconds AS overtaken_s FROM months a JOIN months b USING (physical, day)
  WHERE a.start_at > b.start_at AND a.end_at < b.end_at AND a.plate <> b.plate)""",
    "route_points": """route_points AS (SELECT 'city' AS route, s_suppkey AS stop_id, s_suppkey % 2 AS direction, s_suppkey // 2 % 12 AS stop_order,
  (557003 + (s_suppkey % 20) * 20)::DOUBLE / 10000 AS stop_lat, (491000 + (s_suppkey % 25) * 20)::DOUBLE / 10000 AS stop_lon
  FROM supplier)""",
    "near": f"""near AS (SELECT r.route, plate % 3 AS plate, event_time, stop_id, direction, event_time::DATE AS service_date, {HAVERSINE} AS distance_m
  FROM pings p JOIN route_points r ON abs(lat - stop_lat) < 0.001 WHERE {HAVERSINE} <= 40)""",
    "chain_visits": f"""marked AS (SELECT *, CASE WHEN (epoch_us(event_time) // 1000000) - (epoch_us(lag(event_time) OVER w) // 1000000) <= {GAP_S} THEN 0 ELSE 1 END AS fresh FROM near
  WINDOW w AS (PARTITION BY service_date, plate, route, stop_id, direction ORDER BY event_time)),
numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY service_date, plate, route, stop_id, direction ORDER BY event_time) AS run FROM marked),
chain_visits AS (SELECT service_date, plate, route, stop_id, direction, min(event_time) AS entered_at, max(event_time) AS exited_at, count(*) AS points,
  floor(min(distance_m) + 0.5)::BIGINT AS least_m, floor(max(distance_m) + 0.5)::BIGINT AS most_m FROM numbered GROUP BY service_date, plate, route, stop_id, direction, run)""",
    "chain_trips": """placed AS (SELECT v.*, stop_order FROM chain_visits v JOIN route_points USING (route, direction, stop_id)),
chain_trips AS (SELECT a.service_date, a.plate, a.route, a.direction, a.stop_id AS from_stop, arg_min(b.stop_id, (b.entered_at, b.stop_id)) AS to_stop,
  a.exited_at AS start_at, min(b.entered_at) AS end_at, min((epoch_us(b.entered_at) // 1000000) - (epoch_us(a.exited_at) // 1000000)) AS seconds
  FROM placed a JOIN placed b ON a.service_date = b.service_date AND a.plate = b.plate AND a.route = b.route AND a.direction = b.direction AND b.stop_order = a.stop_order + 1
  AND b.entered_at > a.exited_at AND (epoch_us(b.entered_at) // 1000000) - (epoch_us(a.exited_at) // 1000000) <= 43200
  GROUP BY a.service_date, a.plate, a.route, a.direction, a.stop_id, a.stop_order, a.exited_at)""",
}
NEED |= {
    "same_day": ["trips", "months", "same_day"],
    "same_place": ["trips", "months", "same_place"],
    "chain_visits": ["pings", "route_points", "near", "chain_visits"],
    "chain_trips": ["pings", "route_points", "near", "chain_visits", "chain_trips"],
}


def route_points(s, d):
    lattice = lambda base, n: ((F.lit(base) + F.col("s_suppkey") % n * 20).cast("double") / 10000)
    return _read(s, d, "supplier").select(
        F.lit("city").alias("route"),
        F.col("s_suppkey").alias("stop_id"),
        (F.col("s_suppkey") % 2).alias("direction"),
        F.expr("s_suppkey div 2 % 12").alias("stop_order"),
        lattice(557003, 20).alias("stop_lat"),
        lattice(491000, 25).alias("stop_lon"),
    )


def chain_visits(s, d):
    return chain.stop_visits(pings(s, d).withColumns({"plate": F.col("plate") % 3, "route": F.lit("city")}), route_points(s, d), 40.0, GAP_S, "UTC")


def chain_trips(s, d):
    context = chain.route_context(route_points(s, d), ("route", "direction"))
    return chain.neighbour_trips(chain_visits(s, d), context, 43_200)


query("stop_visits", "SELECT * FROM chain_visits", "chain_visits")(chain_visits)
query(
    "route_context",
    """SELECT route, stop_id, min(stop_order) OVER w AS min_order, max(stop_order) OVER w AS max_order,
  stop_order IN (min(stop_order) OVER w, max(stop_order) OVER w) AS is_terminal FROM route_points WINDOW w AS (PARTITION BY route, direction)""",
    "route_points",
)(lambda s, d: chain.route_context(route_points(s, d)).select("route", "stop_id", "min_order", "max_order", "is_terminal"))
query("chain_trips", "SELECT * FROM chain_trips", "chain_trips")(chain_trips)
query(
    "chain_overtakes",
    """SELECT service_date, route, direction, from_stop % 4 AS place, a.plate AS overtaker, b.plate AS overtaken, a.end_at AS overtake_at, a.seconds AS overtaker_s, b.seconds AS overtaken_s
  FROM (SELECT *, from_stop % 4 AS place FROM chain_trips) a JOIN (SELECT *, from_stop % 4 AS place FROM chain_trips) b USING (service_date, route, direction, place)
  WHERE a.start_at > b.start_at AND a.end_at < b.end_at AND a.plate <> b.plate""".replace("from_stop % 4 AS place, a.plate", "place, a.plate"),
    "chain_trips",
)(
    lambda s, d: chain.day_overtakes(chain_trips(s, d).withColumn("place", F.col("from_stop") % 4), ["route", "direction", "place"]).select(
        "service_date", "route", "direction", "place", "overtaker", "overtaken", "overtake_at", "overtaker_s", "overtaken_s"
    )
)


def months(s, d):
    found = segment_trips(s, d).withColumn("service_date", F.trunc("start_at", "month"))
    return found.withColumns({"route": F.col("segment_id") % 7, "physical": F.expr("segment_id div 2")})


BUCKET_S = 30 * 86_400


def month_end():
    """A segment's trips of a service date, here a month, start before the next one."""
    return F.add_months("service_date", 1).cast("timestamp")


def same_day(s, d):
    found = trips.overtakes(months(s, d), ["segment_id", "service_date"], BUCKET_S, carry=("seconds",), latest=month_end())
    found = found.withColumnsRenamed({"overtaker_seconds": "overtaker_s", "overtaken_seconds": "overtaken_s"})
    return found.withColumn("route", F.col("segment_id") % 7)


def same_place(s, d):
    found = trips.overtakes(months(s, d), ["physical", "service_date"], BUCKET_S, carry=("seconds",), latest=month_end())
    return found.withColumnsRenamed({"overtaker_seconds": "overtaker_s", "overtaken_seconds": "overtaken_s"})


KEY = "(overtake_at, overtaker_id, overtaken_id)"
DAY_SQL = """SELECT service_date, {cols}, count(*) AS n, max(overtake_at) AS last_at, arg_max(overtaken, (overtake_at, overtaker_id, overtaken_id)) AS last_overtaken,
  floor(avg(overtaker_s) + 0.5)::BIGINT AS overtaker_mean_s, floor(avg(overtaken_s) + 0.5)::BIGINT AS overtaken_mean_s FROM {source} GROUP BY ALL"""


def month_columns(c=F.col):
    return trip_columns(c) | {"service_date": F.trunc(c("o_orderdate"), "month"), "route": c("l_partkey") % 7, "physical": packs.div(c("l_partkey"), 2)}


def overtakes_by_day(s, d, segment, dims):
    # A month is one bucket, as no trip of it starts in the next one.
    within = {"bucket_s": 31 * 86_400, "since": F.col("service_date"), "latest": month_end() - F.expr("INTERVAL 1 MICROSECOND")}
    held = trip_packs(s, d)
    return containment.overtakes_by_day(trip_lines(s, d, held), segment, dims, **within, parts=line_parts(s, d), made=month_columns, packs=held)


def overtakes_by_period(s, d, segment, dims):
    measures = {
        "n": F.sum("n"),
        "days": F.count("*"),
        "per_day": rollup.mean("n"),
        "most": F.max("n"),
        "last_at": F.max("last_at"),
        "last_overtaken": F.max(F.struct("last_at", "service_date", "last_overtaken"))["last_overtaken"],
    }
    return rollup.summary(overtakes_by_day(s, d, segment, dims), dims, measures)


OVERTAKE_GRAINS = {
    "segment": ("same_day", "segment_id", ["segment_id"]),
    "segment_route": ("same_day", "segment_id", ["segment_id", "route"]),
    "segment_vehicle": ("same_day", "segment_id", ["segment_id", "overtaker"]),
    "vehicle": ("same_day", "segment_id", ["overtaker"]),
    "physical_segment": ("same_place", "physical", ["physical"]),
    "physical_segment_vehicle": ("same_place", "physical", ["physical", "overtaker"]),
    "physical_vehicle": ("same_place", "physical", ["overtaker"]),
}
for grain, (source, segment, dims) in OVERTAKE_GRAINS.items():
    day_sql = DAY_SQL.format(cols=", ".join(dims), source=source)
    query(f"overtakes_by_day_{grain}", day_sql, source)(lambda s, d, segment=segment, dims=dims: overtakes_by_day(s, d, [segment], dims))
    query(
        f"overtakes_by_period_{grain}",
        f"""SELECT {", ".join(dims)}, weekday_iso, sum(n)::BIGINT AS n, count(*) AS days, floor(avg(n) * 100 + 0.5) / 100 AS per_day, max(n) AS most, max(last_at) AS last_at,
  arg_max(last_overtaken, (last_at, service_date)) AS last_overtaken FROM (SELECT *, unnest([0, isodow(service_date)::INTEGER]) AS weekday_iso FROM ({day_sql})) GROUP BY {", ".join(dims)}, weekday_iso""",
        source,
    )(lambda s, d, segment=segment, dims=dims: overtakes_by_period(s, d, [segment], dims))

POLICIES = "(SELECT *, 'with' AS terminal_policy FROM stays UNION ALL SELECT *, 'without' FROM stays WHERE NOT is_terminal)"
DWELL_GRAINS = {"stop": ["stop_order"], "stop_route": ["stop_order", "route"], "route": ["route"], "vehicle": ["plate"]}
CENTI = "floor(avg(dwell) * 100 + 0.5)::BIGINT"


def dwell_by_day(s, d, dims):
    centi = rollup.rounded(F.avg("dwell") * 100).cast("long")
    measures = {"total": F.sum("dwell"), "most": F.max("dwell"), "mean_centi": centi, "n": F.count("*")}
    return rollup.daily(rollup.terminal_policies(stays(s, d)), ["terminal_policy", *dims], measures)


def dwell_by_period(s, d, dims):
    measures = {"mean": rollup.rounded(F.avg("mean_centi")) / 100, "days": F.countDistinct("service_date"), "total": F.sum("total")}
    return rollup.summary(dwell_by_day(s, d, dims), ["terminal_policy", *dims], measures)


def long_dwell(s, d, dims):
    rows = stays(s, d).where(rollup.dwell_filter(long=True))
    measures = {"n": F.count("*"), "total": F.sum("dwell"), "most": F.max("dwell"), "mean": rollup.mean("dwell")}
    return rollup.summary(rows, dims, measures)


for grain, dims in DWELL_GRAINS.items():
    cols = ", ".join(dims)
    day_sql = f"SELECT service_date, terminal_policy, {cols}, sum(dwell)::BIGINT AS total, max(dwell) AS most, {CENTI} AS mean_centi, count(*) AS n FROM {POLICIES} GROUP BY ALL"
    query(f"dwell_by_day_{grain}", day_sql, "stays")(lambda s, d, dims=dims: dwell_by_day(s, d, dims))
    query(
        f"dwell_by_period_{grain}",
        f"""SELECT terminal_policy, {cols}, weekday_iso, floor(avg(mean_centi) + 0.5) / 100 AS mean, count(DISTINCT service_date) AS days, sum(total)::BIGINT AS total
  FROM (SELECT *, unnest([0, isodow(service_date)::INTEGER]) AS weekday_iso FROM ({day_sql})) GROUP BY ALL""",
        "stays",
    )(lambda s, d, dims=dims: dwell_by_period(s, d, dims))
    query(
        f"long_dwell_{grain}",
        f"""SELECT {cols}, weekday_iso, count(*) AS n, sum(dwell)::BIGINT AS total, max(dwell) AS most, floor(avg(dwell) * 100 + 0.5) / 100 AS mean
  FROM (SELECT *, unnest([0, isodow(service_date)::INTEGER]) AS weekday_iso FROM stays WHERE dwell > 60) GROUP BY ALL""",
        "stays",
    )(lambda s, d, dims=dims: long_dwell(s, d, dims))

query(
    "dwell_heat",
    """SELECT stop_order, direction, count(*) AS n, sum(dwell)::BIGINT AS total, arg_max(plate, (exited_at, visit_id)) AS plate, arg_max(route, (exited_at, visit_id)) AS route
  FROM stays WHERE dwell > 0 GROUP BY ALL ORDER BY total DESC, stop_order, direction LIMIT 2000""",
    "stays",
)(
    lambda s, d: rollup.heat(
        stays(s, d).where(rollup.dwell_filter()),
        ["stop_order", "direction"],
        {
            "n": F.count("*"),
            "total": F.sum("dwell"),
            "plate": F.max(F.struct("exited_at", "visit_id", "plate"))["plate"],
            "route": F.max(F.struct("exited_at", "visit_id", "route"))["route"],
        },
        [F.desc("total"), F.col("stop_order"), F.col("direction")],
    )
)
LATEST = ["overtaker", "overtaken", "segment_id", "route"]
query(
    "overtake_heat",
    f"""SELECT floor((557000 + segment_id % 400)::DOUBLE / 10000 * 1000 + 0.5)::BIGINT AS y, floor((491000 + segment_id % 300)::DOUBLE / 10000 * 1000 + 0.5)::BIGINT AS x, count(*) AS n,
  {", ".join(f"arg_max({c}, {KEY}) AS {c}" for c in LATEST)} FROM same_day GROUP BY 1, 2 ORDER BY n DESC, y, x LIMIT 500""",
    "same_day",
)(
    lambda s, d: rollup.heat(
        same_day(s, d).withColumns({"lat": (F.lit(557000) + F.col("segment_id") % 400).cast("double") / 10000, "lon": (F.lit(491000) + F.col("segment_id") % 300).cast("double") / 10000})
        .withColumns({"y": rollup.grid("lat", 3), "x": rollup.grid("lon", 3)}),
        ["y", "x"],
        {"n": F.count("*"), **{c: F.max(F.struct("overtake_at", "overtaker_id", "overtaken_id", F.col(c).alias("v")))["v"] for c in LATEST}},
        [F.desc("n"), F.col("y"), F.col("x")],
        500,
    )
)
query("raw_speed_heat", "SELECT floor(lat * 10000 + 0.5)::BIGINT AS y, floor(lon * 10000 + 0.5)::BIGINT AS x, floor(avg(speed) * 100 + 0.5) / 100 AS mean FROM pings GROUP BY ALL", "pings")(
    lambda s, d: pings(s, d).groupBy(rollup.grid("lat", 4).alias("y"), rollup.grid("lon", 4).alias("x")).agg(rollup.mean("speed").alias("mean"))
)

SPEED_GRAINS = {"physical": ["physical"], "segment": ["segment_id"], "route_segment": ["route", "segment_id"], "route": ["route"]}
for grain, dims in SPEED_GRAINS.items():
    cols = ", ".join(dims)
    day_sql = f"SELECT day AS service_date, {cols}, count(*) AS n, floor(avg(seconds) * 100 + 0.5)::BIGINT AS mean_centi, min(seconds) AS least, max(seconds) AS most FROM months GROUP BY ALL"

    def speed_by_day(s, d, dims):
        centi = rollup.rounded(F.avg("seconds") * 100).cast("long")
        return rollup.daily(months(s, d), dims, {"n": F.count("*"), "mean_centi": centi, "least": F.min("seconds"), "most": F.max("seconds")})

    query(f"speed_by_day_{grain}", day_sql, "trips", "months")(lambda s, d, dims=dims: speed_by_day(s, d, dims))
    query(
        f"speed_by_period_{grain}",
        f"""SELECT {cols}, weekday_iso, floor(avg(mean_centi) + 0.5) / 100 AS mean, sum(n)::BIGINT AS n, count(*) AS days
  FROM (SELECT *, unnest([0, isodow(service_date)::INTEGER]) AS weekday_iso FROM ({day_sql})) GROUP BY ALL""",
        "trips",
        "months",
    )(lambda s, d, dims=dims: rollup.summary(speed_by_day(s, d, dims), dims, {"mean": rollup.rounded(F.avg("mean_centi")) / 100, "n": F.sum("n"), "days": F.count("*")}))

for grain, dims in {"route_stop": ["route", "stop_order"], "route": ["route"], "stop": ["stop_order"]}.items():
    cols = ", ".join(dims)
    query(
        f"last_pass_mean_{grain}",
        f"""SELECT {cols}, weekday_iso, floor(avg(hour(t) * 3600 + minute(t) * 60 + second(t)) + 0.5)::BIGINT AS second_of_day, count(*) AS sample_days FROM
  (SELECT *, unnest([0, isodow(service_date)::INTEGER]) AS weekday_iso FROM (SELECT exited_at::DATE AS service_date, {cols}, max(exited_at) AS t FROM stays GROUP BY ALL)) GROUP BY ALL""",
        "stays",
    )(lambda s, d, dims=dims: last_pass_mean(s, d, dims))


def last_pass_mean(s, d, dims):
    from ..functions import when
    from ..operators import visits

    days = visits.last_pass(stays(s, d), dims).withColumn("second", when.second_of_day(F.col("last_pass_at")))
    return rollup.summary(days, dims, {"second_of_day": rollup.rounded(F.avg("second")).cast("long"), "sample_days": F.count("*")})


query(
    "last_pass_stop_with_route",
    "SELECT exited_at::DATE AS service_date, stop_order, max(exited_at) AS last_pass_at, arg_max(route, (exited_at, route)) AS route FROM stays GROUP BY ALL",
    "stays",
)(
    lambda s, d: rollup.daily(stays(s, d).withColumn("service_date", F.to_date("exited_at")), ["stop_order"], {"last_pass_at": F.max("exited_at"), "route": rollup.latest("route", "exited_at")})
)

RIDES = "rides AS (SELECT *, segment_id % 5 AS from_stop, (segment_id + plate) % 5 AS to_stop, segment_id % 7 AS route FROM trips)"
PARTS["rides"] = RIDES
query(
    "wait_ratio",
    """SELECT route, sum(seconds)::BIGINT AS moving_s, sum(wait)::BIGINT AS waiting_s, sum(wait)::DOUBLE / sum(seconds)::DOUBLE AS ratio FROM (
  SELECT *, CASE WHEN lead(from_stop) OVER w = to_stop THEN (epoch_us((lead(start_at) OVER w)::TIMESTAMP) // 1000000) - (epoch_us(end_at::TIMESTAMP) // 1000000) ELSE 0 END AS wait
  FROM rides WINDOW w AS (PARTITION BY plate, route ORDER BY start_at, trip_id)) GROUP BY 1""",
    "trips",
    "rides",
)(
    lambda s, d: trips.wait_ratio(
        segment_trips(s, d).withColumns({"from_stop": F.col("segment_id") % 5, "to_stop": (F.col("segment_id") + F.col("plate")) % 5, "route": F.col("segment_id") % 7}), ["plate", "route"], ["route"]
    )
)
query(
    "run_split",
    """SELECT visit_id, sum(fresh) OVER (PARTITION BY plate ORDER BY entered_at, visit_id)::BIGINT AS run FROM (
  SELECT *, CASE WHEN (epoch_us(entered_at) // 1000000) - (epoch_us(lag(exited_at) OVER w) // 1000000) <= 86400 AND stop_order >= lag(stop_order) OVER w THEN 0 ELSE 1 END AS fresh
  FROM stays WINDOW w AS (PARTITION BY plate ORDER BY entered_at, visit_id))""",
    "stays",
)(lambda s, d: trips.split_runs(stays(s, d), ["plate"], 86_400).select("visit_id", "run"))
query(
    "month_then_year",
    """SELECT year, weekday_iso, piece, floor(sum(mean_centi) / count(*) + 0.5) / 100 AS mean, count(*) AS months FROM (
  SELECT year(service_date)::INTEGER AS year, month(service_date)::INTEGER AS month, isodow(service_date)::INTEGER AS weekday_iso, segment_id % 10 AS piece,
  floor(avg(seconds) * 100 + 0.5)::BIGINT AS mean_centi FROM trips GROUP BY ALL) GROUP BY ALL""",
    "trips",
)(lambda s, d: rollup.month_then_year(segment_trips(s, d).withColumn("piece", F.col("segment_id") % 10), ["piece"], "seconds")[1])
query("colour_scale", "SELECT min(speed) AS least, quantile_disc(speed, 0.9) AS top, max(speed) AS most FROM pings", "pings")(lambda s, d: _colours(s, d))


def _colours(s, d):
    from ..operators import network

    return network.colour_scale(pings(s, d), "speed")


# Read functions: what a dashboard asks for.
LAST = "(SELECT max(service_date) FROM {0})"


def _last_day(df):
    """The newest day of a table, one value: the 'today' of a static table."""
    return df.agg(F.max("service_date")).first()[0]


def api_overtakes(s, d, period, weekday=None):
    # Both the newest day and the answer come from the vehicles' days, counted once.
    measures = {"n": F.count("*"), "last_at": F.max("overtake_at")}
    found = rounds.written(rollup.daily(same_day(s, d), ["segment_id", "overtaker"], measures), "vehicle_days")
    last = _last_day(found)
    rows = found.where(rollup.period_filter(period, last, last, weekday))
    measures = {"n": F.sum("n"), "vehicles": F.countDistinct("overtaker"), "last_at": F.max("last_at")}
    return rows.groupBy("segment_id").agg(*(m.alias(n) for n, m in measures.items()))


WHERE = {
    "previous": f"service_date = {LAST}",
    "all": f"service_date < {LAST}",
    "weekday": f"service_date < {LAST} AND isodow(service_date) = 2",
}
for period, where in WHERE.items():
    query(
        f"api_overtakes_{period}",
        f"SELECT segment_id, count(*) AS n, count(DISTINCT overtaker) AS vehicles, max(overtake_at) AS last_at FROM same_day WHERE {where.format('same_day')} GROUP BY 1",
        "same_day",
    )(lambda s, d, period=period: api_overtakes(s, d, period, 2))
    for policy in ("with-terminals", "without-terminals"):
        query(
            f"api_dwell_{period}_{policy.split('-')[0]}",
            f"SELECT stop_order, route, count(*) AS n, sum(dwell)::BIGINT AS total FROM stays WHERE dwell > 0 AND {where.format('stays')}{' AND NOT is_terminal' if policy[4] == 'o' else ''} GROUP BY ALL",
            "stays",
        )(lambda s, d, period=period, policy=policy: api_dwell(s, d, period, policy))


def api_dwell(s, d, period, policy):
    rows = stays(s, d)
    last = _last_day(rows)
    rows = rows.where(rollup.dwell_filter(policy=policy) & rollup.period_filter(period, last, last, 2))
    return rows.groupBy("stop_order", "route").agg(F.count("*").alias("n"), F.sum("dwell").alias("total"))


query(
    "api_overtake_details",
    """SELECT overtaker_id, overtaken_id, overtake_at, (SELECT count(*) FROM same_day WHERE route = 3) AS total, (SELECT count(*) FROM same_day WHERE route = 3) > 50 AS has_more
  FROM same_day WHERE route = 3 ORDER BY overtake_at DESC, overtaker_id, overtaken_id LIMIT 25 OFFSET 25""",
    "same_day",
)(
    lambda s, d: rollup.page_with_total(same_day(s, d).where(rollup.event_filter(route=3, overtaker=None)), [F.desc("overtake_at"), F.col("overtaker_id"), F.col("overtaken_id")], 2, 25).select(
        "overtaker_id", "overtaken_id", "overtake_at", "total", "has_more"
    )
)
query(
    "api_dwell_details",
    """SELECT visit_id, dwell, (SELECT count(*) FROM stays WHERE dwell > 60) AS total, (SELECT count(*) FROM stays WHERE dwell > 60) > 50 AS has_more
  FROM stays WHERE dwell > 60 ORDER BY dwell DESC, visit_id LIMIT 50""",
    "stays",
)(lambda s, d: rollup.page_with_total(stays(s, d).where(rollup.dwell_filter(long=True)), [F.desc("dwell"), F.col("visit_id")]).select("visit_id", "dwell", "total", "has_more"))
query(
    "api_overtake_timeline",
    "SELECT (epoch_us(overtake_at::TIMESTAMP) // 1000000) // 86400 * 86400 AS bucket, count(*) AS n FROM same_day GROUP BY 1",
    "same_day",
)(lambda s, d: same_day(s, d).groupBy((F.date_diff("overtake_at", F.lit("1970-01-01").cast("date")).cast("long") * 86_400).alias("bucket")).agg(F.count("*").alias("n")))
query(
    "api_traces_window",
    """SELECT plate, event_id FROM (SELECT *, lag(lat) OVER w IS NOT DISTINCT FROM lat AND lag(lon) OVER w IS NOT DISTINCT FROM lon AS same FROM pings
  WHERE (SELECT max(epoch_us(event_time) // 1000000) FROM pings) - (epoch_us(event_time) // 1000000) <= 86400 WINDOW w AS (PARTITION BY plate ORDER BY event_time, event_id))
  WHERE NOT same QUALIFY row_number() OVER (PARTITION BY plate ORDER BY event_time DESC, event_id DESC) <= 100""",
    "pings",
)(lambda s, d: rollup.active_traces(pings(s, d), 100, minutes=1440, keep_repeats=False).select("plate", "event_id"))
query("route_contains", "SELECT event_id FROM pings WHERE route LIKE '%c%'", "pings")(lambda s, d: pings(s, d).where(F.col("route").contains("c")).select("event_id"))
query(
    "affected_days",
    """SELECT visit_id FROM stays WHERE service_date IN (SELECT DISTINCT service_date FROM stays WHERE plate % 50 = 7)""",
    "stays",
)(lambda s, d: _affected(s, d))


def _affected(s, d):
    from ..sources.files import reopened

    found = stays(s, d)
    return reopened(found, found.where("plate % 50 = 7"), "service_date").select("visit_id")
