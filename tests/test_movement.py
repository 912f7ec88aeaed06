import datetime as dt
import itertools
import math

from pingloom.operators import journeys, network, rollup, trips, visits
from pingloom.plans import queries
from pingloom.sources import files, topology, upkeep
from pingloom.streaming import ingest


def at(s):
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)


def test_visit_gap(spark):
    pings = spark.createDataFrame([("p", at(0)), ("p", at(180)), ("p", at(361))], "plate string, ts timestamp")
    for f in (visits.visits_manual, visits.visits_builtin):
        rows = sorted(tuple(r) for r in f(pings, ["plate"], "ts", 180).collect())
        assert [(r[1], r[2], r[3]) for r in rows] == [(at(0), at(180), 2), (at(361), at(361), 1)]


def test_geo_join_equals_cross_join(spark):
    stops = spark.createDataFrame([(i, 55.7 + i * 0.0004, 49.1 + i % 3 * 0.0007) for i in range(20)], "stop_id long, stop_lat double, stop_lon double")
    points = spark.createDataFrame([(i, 55.7 + i * 0.00017, 49.1 + i % 7 * 0.0003) for i in range(60)], "id long, lat double, lon double")
    from pyspark.sql import functions as F

    from pingloom.functions.geo import haversine_m

    near = visits.geo_join(points, stops, 50.0).select("id", "stop_id")
    every = points.join(stops).where(haversine_m(F.col("lat"), F.col("lon"), F.col("stop_lat"), F.col("stop_lon")) <= 50).select("id", "stop_id")
    assert sorted(map(tuple, near.collect())) == sorted(map(tuple, every.collect())) != []


def test_only_strict_containment_overtakes(spark):
    rows = [("s", "a", "A", at(10), at(20)), ("s", "b", "B", at(5), at(25)), ("s", "c", "C", at(10), at(30)), ("s", "d", "B", at(6), at(24))]
    df = spark.createDataFrame(rows, "seg string, trip_id string, plate string, start_at timestamp, end_at timestamp")
    for bucket in (None, 7):
        assert sorted((r.overtaker_id, r.overtaken_id) for r in trips.overtakes(df, ["seg"], bucket).collect()) == [("a", "b"), ("a", "d")]


def test_zero_fill_and_paths(spark):
    df = spark.createDataFrame([(at(0),), (at(1200),)], "ts timestamp")
    assert [r.n for r in rollup.zero_filled(df, "ts", 300).orderBy("bucket").collect()] == [1, 0, 0, 0, 1]
    assert network.hull_area([(0, 0), (2, 0), (0, 2), (1, 0), (0, 1)]) == 2.0
    links = spark.createDataFrame([(1, 2, 0, 5, 7), (2, 3, 6, 9, 7), (1, 3, 1, 20, 8)], "from_stop long, to_stop long, dep long, arr long, plate long")
    best = journeys.earliest_journeys(links, spark.createDataFrame([(1, 1, 0)], "origin long, stop long, at long"))
    assert {r.stop: (r["at"], r.path) for r in best.collect()} == {1: (0, ""), 2: (5, "1-2-0-5-7"), 3: (9, "1-2-0-5-7>2-3-6-9-7")}
    assert [(r.stop, r.board, r.alight, r.legs) for r in journeys.fragments(best).orderBy("stop").collect()] == [(2, 0, 5, 1), (3, 0, 9, 2)]


def test_files_and_stream(spark, tmp_path):
    assert files.select_new_files([(2, "b"), (1, "a"), (2, "a")], (1, "a")) == ([(2, "a"), (2, "b")], (2, "b"))
    assert files.batch_ready([(0, 1)], 3600) and not files.batch_ready([(0, 1)], 10) and not files.batch_ready([], 10)
    spool = tmp_path / "spool"
    spool.mkdir()
    good = '{"internalRouteId":"1","realRouteNumber":"7","latitude":1.0,"longitude":2.0,"speed":3,"plate":"x","timestamp":1700000000}'
    (spool / "a.jsonl").write_text(f"{good}\n{good}\nnot json\n")
    go = lambda: ingest.ingest(spark, str(spool), str(tmp_path / "out"), str(tmp_path / "cp"), bad=str(tmp_path / "bad")).awaitTermination()
    go()
    (spool / "b.jsonl").write_text(f"{good}\n")  # the same ping in a later batch
    go()
    assert ingest.published(spark, str(tmp_path / "out")).count() == 1
    assert [r.value for r in spark.read.text(str(tmp_path / "bad")).collect()] == ["not json"]
    store = upkeep.Store(spark, f"file://{tmp_path}")
    assert len(upkeep.committed_files(store, "cp")) == 2


def all_k_paths(edges, origins, rides=3, most=8, ratio=1.5):
    stops, found = {x for e in edges for x in e}, {}
    for origin, r in itertools.product(origins, range(1, rides + 1)):
        for rest in itertools.permutations(stops - {origin}, r):
            path = (origin, *rest)
            if all(e in edges for e in itertools.pairwise(path)):
                found.setdefault((origin, rest[-1]), []).append((r, sum(edges[e] for e in itertools.pairwise(path)), ">".join(map(str, path))))
    return {(*key, *row) for key, rows in found.items() for row in sorted(x for x in rows if x[1] <= ratio * min(m for _, m, _ in rows))[:most]}


def test_k_paths_against_brute_force(spark, tmp_path):
    edges = {(a, b): float(100 + (a * 7 + b * 13) % 23) for a in range(12) for b in range(12) if a != b and (a + 2 * b) % 9}
    df = spark.createDataFrame([(*e, m) for e, m in edges.items()], "from_stop long, to_stop long, meters double")
    got = network.k_paths(df, spark.range(12).withColumnRenamed("id", "origin"), ratio=4.0).collect()
    assert {(r.origin, r.stop, r.rides, r.meters, ">".join(map(str, r.path))) for r in got} == all_k_paths(edges, range(12), ratio=4.0)
    # the registered query: all origins, three rides
    days = [(a, a + 1, dt.date(2024, 1, 1) + dt.timedelta(days=a)) for a in range(19)]
    spark.createDataFrame([(a, dt.date(2023, 12, 1)) for a, _, _ in days], "o_orderkey long, o_orderdate date").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(a, a, b, day) for a, b, day in days], "l_orderkey long, l_suppkey long, l_partkey long, l_shipdate date").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = queries.Q["static_k_paths"](spark, str(tmp_path)).collect()
    by_ride = {(a, a + k) for a in range(19) for k in (1, 2, 3) if a + k < 20}
    by_walk = {(a, b + 1) for a, b in by_ride if b % 4 == 0}  # its walks go from every fourth stop to the next
    longer = {(a, b) for a, b in {(r.origin, r.stop) for r in rows} - by_ride - by_walk}
    assert by_ride | by_walk <= {(r.origin, r.stop) for r in rows} and all(3 < b - a <= 6 for a, b in longer)


def test_upkeep(spark, tmp_path):
    store = upkeep.Store(spark, f"file://{tmp_path}/t")
    spark.range(100).selectExpr("id % 40 as k", "id").repartition(5).write.parquet(f"{tmp_path}/t/day=1")
    (tmp_path / "t/day=1/broken.parquet").write_bytes(b"PAR1 and no end")
    (tmp_path / "t/_temporary").mkdir()
    (tmp_path / "t/_temporary/x.parquet").write_bytes(b"PAR1PAR1")
    whole = upkeep.whole_parquet(store)
    assert len(whole) == 5 and not upkeep.whole_parquet(store, min_age_s=1e6)
    store.delete("day=1/broken.parquet")
    # a crash after the first move: the backup comes back
    store.move("day=1", "day=1.backup")
    assert upkeep.recover_swap(store, "day=1") and store.exists("day=1")
    assert upkeep.rewrite_small(store, "day=1", keys=["k"]) and not upkeep.rewrite_small(store, "day=1")
    assert spark.read.parquet(f"{tmp_path}/t/day=1").count() == 40 and not store.exists("day=1.backup")
    # manifest windows end at whole lines
    store.write("manifest", b'{"a": 1}\n{"a": 2}\n{"a": 3}\n{"a"')
    assert upkeep.manifest_window(store, "manifest", 0, 2) == ([{"a": 1}, {"a": 2}], 18)
    assert upkeep.manifest_window(store, "manifest", 18) == ([{"a": 3}], 27)
    assert upkeep.manifest_window(store, "manifest", 0, step=5)[1] == 27
    # only handled and old files inside the folder go
    names = ["/r/a", "/r/b", "/r/c", "/x/d", "/r/../e", "/other/r/f", "file:/r/g", "/rr/h"]
    files_ = [(90 if p == "/r/c" else 0, p, 1) for p in names]
    assert upkeep.collectable(files_, {*names} - {"/r/b"}, "/r", 100, 50) == ["/r/a", "file:/r/g"]
    done = {p for _, p, _ in store.files("day=1")}
    assert upkeep.collect(store, done, 0, dry_run=True) and store.files("day=1")
    upkeep.publish_json(store, "view.json", {"b": 1})
    upkeep.publish_json(store, "view.json", {"b": 2})
    assert (tmp_path / "t/view.json").read_text() == '{"b": 2}'
    spool = upkeep.Spool(upkeep.Store(spark, f"file://{tmp_path}/s"), seconds=10, size=1000)
    spool.add({"x": 1}, now=0)
    spool.add({"x": 2}, now=11)
    (tmp_path / "s/open").mkdir(exist_ok=True)
    (tmp_path / "s/open/lost.tmp").write_bytes(b'{"x": 3}\n{"x"')
    assert spool.recover() == 1 and not list((tmp_path / "s/open").glob("*.tmp"))
    assert sorted(r.x for r in spark.read.json(f"{tmp_path}/s/ready").collect()) == [1, 2, 3]


def test_writes(spark, tmp_path):
    rows = spark.createDataFrame([("2024-01-01", 0, "a", 5), ("2024-01-01", 0, "a", 3), ("2024-01-02", 10, "b", 1)], "service_date string, bucket int, k string, v int")
    report = upkeep.dedup_history(rows, ["k"], f"{tmp_path}/h", "service_date", ["v"]).collect()
    assert sorted(map(tuple, report)) == [("2024-01-01", 2, 1), ("2024-01-02", 1, 1)]
    assert sorted((r.k, r.v) for r in spark.read.parquet(f"{tmp_path}/h").collect()) == [("a", 3), ("b", 1)]
    upkeep.overwrite_buckets(rows, f"{tmp_path}/b")
    upkeep.overwrite_buckets(rows.where("bucket = 10").withColumn("v", rows.v * 10), f"{tmp_path}/b")
    assert sorted(r.v for r in spark.read.parquet(f"{tmp_path}/b").collect()) == [3, 5, 10]
    upkeep.overwrite_summary(rows, f"{tmp_path}/o", 1)
    upkeep.backfill(rows, f"{tmp_path}/n")
    try:
        upkeep.backfill(rows, f"{tmp_path}/n")
        raise AssertionError("written over an old folder")
    except Exception as e:
        assert "exists" in str(e).lower()
    files.write_days(rows, f"{tmp_path}/d")
    raw = files.with_source(files.read_table(spark, f"{tmp_path}/d", merge=True)).drop("source_modified")
    seen = raw.where("k = 'b'").select("source_file").distinct()
    compacted = rows.where("k = 'b'")
    assert sorted(r.v for r in files.with_tail(compacted, raw, seen, ["service_date", "k", "v"]).collect()) == [1, 3, 5]


def test_topology_overlay_and_roads(spark):
    one = lambda text: spark.createDataFrame([(text,)], "value string")
    stops, routes, placed = topology.parse_topology(one('{"nbusstop": {"1": ["A", 49.1, 55.7, "a"]}, "bus": {"7": ["x", "10", "", "", "", 1]}, "route": {"k": [7, 1, 0, 3], "q": [8, 1, 0, 1]}}'))
    assert [(r.route_id, r.route, r.stop_id, r.stop_lat, r.stop_order) for r in placed.collect()] == [("7", "Т10", "1", 55.7, 3)] and stops.count() == routes.count() == 1
    # only overlay routes with an id of ours; a known stop keeps its name and place; a base route gets the overlay's stops too
    race = '"races": [{"naviRaceType": "b", "stops": [{"stopId": "s", "name": "S", "lat": 1.0, "lon": 2.0}, {"stopId": " "}, {"stopId": "1", "stopName": "other", "latitude": 9.0, "longitude": 9.0, "order": 7}]}]'
    route = '"mappedFrom": "navi-overlay", "internalRouteId": "%s", "naviRouteNumber": "5", "naviTransportTypeId": %s, ' + race
    text = '{"routes": [{%s}, {%s}, {"mappedFrom": "base", "internalRouteId": "8", %s}, {"mappedFrom": "navi-overlay", "internalRouteId": " ", %s}]}' % (route % ("9", '"2"'), route % ("7", '"9", "displayRouteNumber": "5x"'), race, race)
    over = topology.parse_overlay(one(text))
    assert sorted((r.route_id, r.route, r.transport_type, r.stop_id, r.direction, r.stop_order) for r in over.collect()) == [("7", "5x", 0, "1", 1, 7), ("7", "5x", 0, "s", 1, 0), ("9", "Т5", 1, "1", 1, 7), ("9", "Т5", 1, "s", 1, 0)]
    both = {(r.route_id, r.stop_id): (r.stop_name, r.stop_lat) for r in topology.with_overlay(placed, over).collect()}
    assert both == {("7", "1"): ("A", 55.7), ("9", "1"): ("A", 55.7), ("7", "s"): ("S", 1.0), ("9", "s"): ("S", 1.0)}
    kinds = ["trunk", "platform", "elevator", "raceway", "construction", " "]
    made = ", ".join('{"type": "way", "id": %d, "tags": {"highway": "%s"}, "geometry": [{"lat": 1, "lon": 1}, {"lat": 2, "lon": 2}]}' % (k, x) for k, x in enumerate(kinds))
    assert sorted(r.way for r in topology.parse_ways(one('{"elements": [%s]}' % made)).collect()) == [0, 3]
    ways = topology.parse_ways(one('{"elements": [{"type": "way", "id": 3, "tags": {"highway": "footway"}, "geometry": [{"lat": 55.7, "lon": 49.1}, {"lat": 55.7, "lon": 49.104}]}, {"type": "way", "id": 4, "tags": {"highway": "motorway"}, "geometry": []}]}'))
    pieces = network.road_pieces(ways).orderBy("place").collect()
    assert len(pieces) == 3 and abs(pieces[1].lon - 49.102) < 1e-9
    homes = topology.household_cells(one('[{"lat": 55.7, "lon": 49.1, "flats": 20}, {"lat": 55.7, "lon": 49.1}, {"lon": 1.0}]')).collect()
    assert [(r.x, r.y, r.households) for r in homes] == [(int(49.1 * 111320 * math.cos(math.radians(55.8)) // 250), int(55.7 * 111320 // 250), 21)]


def test_contours_and_clusters(spark):
    cells = spark.createDataFrame([(0, 0, 10, 2), (1, 1, 10, 3), (5, 5, 20, 4)], "x long, y long, minutes long, households long")
    rows = {r.minutes: tuple(r)[1:] for r in network.contours(cells).collect()}
    assert rows[15] == (2, 5, 1, 3.0) and rows[30] == (3, 9, 2, 4.0)
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101)], "a long, b long")
    found = network.connected(edges, spark.range(61).union(spark.range(100, 103)).withColumnRenamed("id", "node"))
    assert {r.node: r.label for r in found.collect()} == {**dict.fromkeys(range(61), 0), 100: 100, 101: 100, 102: 102}
    chain = spark.createDataFrame([(1, 2, 150.0), (2, 3, 150.0), (1, 3, 500.0)], "a long, b long, meters double")
    walks = network.road_walks(chain, spark.createDataFrame([(7, 1)], "stop long, node long"), 400.0)
    assert {r.node: r.meters for r in walks.collect()} == {1: 0.0, 2: 150.0, 3: 300.0}
