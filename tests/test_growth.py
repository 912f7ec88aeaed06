"""Steps whose work grew faster than their input."""

import datetime as dt
import re

from pyspark.sql import functions as F

from pingloom.operators import chain, containment, journeys, network, reads, rounds, trips, visits
from pingloom.plans import rides


def shuffled(spark, run):
    """Rows that the stages of a run shuffled, and its result."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def records():
        found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(found.apply(k).shuffleWriteRecords() for k in range(found.size()))

    before = records()
    result = run()
    return records() - before, result


def long_trips(spark):
    """Sixty trips of years that all start in one month: each lies around the ones after it."""
    month, start = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)
    rows = [("s", month, f"t{k:02d}", f"p{k % 7}", start + dt.timedelta(hours=12 * k), start + dt.timedelta(days=2500 - k), 100 + k) for k in range(60)]
    return spark.createDataFrame(rows, "segment string, service_date date, trip_id string, plate string, start_at timestamp, end_at timestamp, seconds long")


def test_long_trips_go_into_no_bucket_behind_the_last_start(spark):
    found, keys, bucket = long_trips(spark), ["segment", "service_date"], 30 * 86_400
    until = F.add_months("service_date", 1).cast("timestamp")
    want = {(a, b) for a in range(60) for b in range(a) if a % 7 != b % 7}
    moved, pairs = shuffled(spark, lambda: trips.overtakes(found, keys, bucket, latest=until).collect())
    assert {(int(r.overtaker_id[1:]), int(r.overtaken_id[1:])) for r in pairs} == want and moved <= 4 * 60  # 84 buckets a trip otherwise
    moved, days = shuffled(spark, lambda: containment.overtakes_by_day(found, ["segment"], ["overtaker"], bucket_s=bucket, latest=until).collect())
    assert {r.overtaker: r.n for r in days} == {f"p{p}": sum(a % 7 == p for a, _ in want) for p in range(7)} and moved <= 4 * 60


def test_the_last_one_overtaken_comes_with_the_counts(spark):
    """The greatest trip around is another vehicle's, though the vehicle's own lie above it; rows without a vehicle count for nothing."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rows = [("s", "a", "x", 0, 90), ("s", "b", "y", 1, 80), ("s", "d", "z", 2, 70), ("s", "e", "z", 3, 60), ("s", "f", None, 4, 55), ("s", "c", "z", 5, 50), ("r", "g", "x", 6, 40)]
    found = spark.createDataFrame([(g, t, p, at(a), at(b), b - a) for g, t, p, a, b in rows], "segment string, trip_id string, plate string, start_at timestamp, end_at timestamp, seconds long")
    got = {r.trip_id: (r.n, r.overtaken_s, r.last_overtaken) for r in containment.overtake_counts(found, ["segment"]).collect()}
    assert got == {"b": (1, 90, "x"), "d": (2, 169, "y"), "e": (2, 169, "y"), "c": (2, 169, "y")}


def test_views_over_counts_equal_views_over_pairs(spark):
    """A hundred moves of one segment: a row for each that overtakes, not one for each pair."""
    at = lambda s: dt.datetime(2024, 1, 1, 8) + dt.timedelta(seconds=s)
    rows = [(dt.date(2024, 1, 1 + k % 2), f"r{k % 3}/1", "p1" if k % 5 else "p2", f"r{k % 3}", f"v{k % 11:02d}", at(7 * k % 60), at(3000 - 13 * k % 900), 3000 - 13 * k % 900 - 7 * k % 60, 55.7, 49.1 + k % 3 / 1000) for k in range(100)]
    moves = spark.createDataFrame(rows, "service_date date, segment_id string, physical_id string, route string, plate string, start_at timestamp, end_at timestamp, seconds long, lat double, lon double")
    pairs = trips.overtakes(moves.withColumn("trip_id", F.lit(0)), ["service_date", "physical_id"], 900, ("segment_id", "route", "seconds", "lat", "lon"))
    pairs = pairs.withColumnsRenamed({f"overtaker_{c}": c for c in ("segment_id", "route", "lat", "lon")} | {"overtaker_seconds": "overtaker_s", "overtaken_seconds": "overtaken_s"}).select("service_date", "segment_id", "physical_id", "route", "overtaker", "overtaken", "overtake_at", "overtaker_s", "overtaken_s", "lat", "lon").cache()
    counts = reads.counted_overtakes(moves, "physical").cache()
    assert counts.count() < 100 < 5 * 100 < pairs.count()
    asked = {"scope": "physical", "today": "2024-02-01"}
    seen = lambda df: sorted(map(tuple, df.collect()))
    for mode in ("segment", "segmentVehicle", "vehicle", "pointHeatmap"):
        assert seen(reads.overtakes(counts, mode=mode, **asked)) == seen(reads.overtakes(pairs, mode=mode, **asked)) != []
    assert seen(reads.overtake_timeline(counts, **asked)) == seen(reads.overtake_timeline(pairs, **asked)) != []
    columns = ["overtaker", "overtaken", "overtake_at", "overtaker_s", "overtaken_s", "segment_id", "total", "has_more"]
    for page in (1, 3):
        a, b = (reads.overtake_details(e, page=page, size=20, trips=t, segment="p1", **asked).select(columns).collect() for e, t in ((counts, moves), (pairs, None)))
        key = lambda r: tuple(r)[:4]
        assert [key(r) for r in a] == [key(r) for r in b] and len(a) == 20 and a[0].total == b[0].total


def test_a_busy_day_of_a_shared_table_is_split(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100KB")
    try:
        day = F.lit("2024-01-01").cast("date")
        made = rounds.once(spark, (str(tmp_path), "busy"), lambda: spark.range(0, 200_000, 1, 8).select("id", F.xxhash64("id").alias("x"), day.alias("service_date")))
        assert made.count() == 200_000 and len(made.inputFiles()) > 3  # one file, written by one task, before
    finally:
        spark.conf.unset(size)


T = dt.datetime(2024, 1, 1, 8)
PLACED = "route string, direction int, stop_id long, stop_order long, stop_lat double, stop_lon double"


def test_stops_at_one_spot_share_their_visits(spark):
    pings = spark.createDataFrame([("7", "v", T + dt.timedelta(seconds=60 * k + 300 * (k > 24)), 55.7, 49.1) for k in range(50)], "route string, plate string, event_time timestamp, lat double, lon double").coalesce(1)
    rows = [("7", k % 2, k, k, 55.7, 49.1) for k in range(40)] + [("7", 0, 99, 1, 55.7, 49.1), ("7", 0, 99, 2, 55.7001, 49.1)]
    stops = spark.createDataFrame(rows, PLACED).coalesce(1)
    moved, found = shuffled(spark, lambda: chain.stop_visits(pings, stops, 50.0, 180, "UTC").collect())
    assert sorted((r.stop_id, r.points) for r in found) == [(k, 25) for k in range(40) for _ in "ab"] + [(99, 50)] * 2  # both places' pings, as in one run
    assert {(r.least_m, r.most_m) for r in found if r.stop_id == 99} == {(0, 11)} and moved < 40 * 50


def test_next_stop_without_pairs_of_visits(spark):
    visits = [(dt.date(2024, 1, 1), "v", "7", 0, s, T + dt.timedelta(seconds=97 * k * (s + 3) % 4000), T + dt.timedelta(seconds=97 * k * (s + 3) % 4000 + k % 9)) for s in range(6) for k in range(30)]
    found = spark.createDataFrame(visits, "service_date date, plate string, route string, direction int, stop_id long, entered_at timestamp, exited_at timestamp")
    context = chain.route_context(spark.createDataFrame([("7", 0, s, s // 2, 55.7, 49.1) for s in range(6)], PLACED))
    got = chain.neighbour_trips(found, context, 600)
    want = set()
    for _, _, _, _, s, _, left in visits:
        later = [(e, s2) for _, _, _, _, s2, e, _ in visits if s2 // 2 == s // 2 + 1 and e > left]
        if later and (min(later)[0] - left).total_seconds() <= 600:
            want.add((s, left, *min(later)))
    assert {(r.from_stop, r.start_at, r.end_at, r.to_stop) for r in got.collect()} == want and len(want) == got.count() > 50
    assert not re.search(r"Join Inner, .*[<>] ", got._jdf.queryExecution().optimizedPlan().toString())


def test_alike_trips_overtake_as_one(spark):
    rows = [(dt.date(2024, 1, 1), "s", p, T + dt.timedelta(seconds=a), T + dt.timedelta(seconds=b), b - a) for p, a, b in [("x", 0, 5000)] * 30 + [("y", 50, 90)] * 20]
    found = spark.createDataFrame(rows, "service_date date, segment string, plate string, start_at timestamp, end_at timestamp, seconds long").coalesce(1)
    moved, pairs = shuffled(spark, lambda: chain.day_overtakes(found, ["segment"]).collect())
    assert len(pairs) == 600 and {(r.overtaker, r.overtaken, r.overtaker_s, r.overtaken_s) for r in pairs} == {("y", "x", 40, 5000)} and moved < 50


def test_busy_road_nodes_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(network, "STEPS", 8)
    roads = [(0, k, 100.0) for k in range(1, 21)] + [(k, k + 20, 50.0) for k in range(1, 21)]
    got = network.road_walks(spark.createDataFrame(roads, "a long, b long, meters double"), spark.createDataFrame([(k, k) for k in range(41)], "stop long, node long"), 250.0).collect()
    def metres(a, b):
        part = lambda n: (0, 0.0) if n == 0 else ((n - 1) % 20 + 1, 100.0 + 50.0 * (n > 20))
        (i, x), (j, y) = part(a), part(b)
        return abs(x - y) if i == j else x + y
    assert sorted((r.stop, r.node, r.meters) for r in got) == [(a, b, metres(a, b)) for a in range(41) for b in range(41) if metres(a, b) <= 250]


def test_stops_at_one_spot_cluster_as_one(spark):
    rows = [(k, " A " if k % 2 else "a", 55.7, 49.1) for k in range(100, 200)] + [(7, "a", 55.7005, 49.1), (8, "a", 55.8, 49.1), (9, "b", 55.7, 49.1), (5, None, 55.7, 49.1), (6, "a", None, 49.1)]
    rows += [(300, "a", 55.8, 49.1), (300, "c", 55.9, 49.1), (301, "c", 55.9, 49.1)]  # a stop at two places joins them
    stops = spark.createDataFrame(rows, "stop_id long, stop_name string, stop_lat double, stop_lon double").coalesce(1)
    moved, found = shuffled(spark, lambda: network.named_clusters(stops, 180.0).collect())
    assert {r.stop_id: r.label for r in found} == {**dict.fromkeys(range(100, 200), 7), 7: 7, 8: 8, 300: 8, 301: 8, 9: 9, 5: 5, 6: 6}
    assert len(found) == 107 and moved < 100 * 100


def test_journeys_keep_one_trip_of_a_departure(spark):
    trips_ = spark.createDataFrame([(a, a + 1, 10 * a, 10 * a + 5 + k, 500 - k) for a in range(3) for k in range(400)], "from_stop long, to_stop long, dep long, arr long, plate long").coalesce(1)
    moved, found = shuffled(spark, lambda: journeys.earliest_journeys(trips_, spark.createDataFrame([(0, 0, 0)], "origin long, stop long, at long")).collect())
    assert {r.stop: r["at"] for r in found} == {0: 0, 1: 5, 2: 15, 3: 25} and moved < 1200


def test_paths_make_their_edges_once(spark):
    made = spark.sparkContext.accumulator(0)
    pairs = [(a, b, float(100 + (a * 7 + b * 13) % 23)) for a in range(8) for b in range(8) if a != b]

    def seen(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    edges = spark.createDataFrame(pairs, "from_stop long, to_stop long, meters double").coalesce(1)
    network.k_paths(edges.mapInPandas(seen, edges.schema), spark.range(8).withColumnRenamed("id", "origin")).count()
    assert made.value == len(pairs)


def stage_sums(spark, run, field):
    """What a run adds to a figure of its stages, and its result."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def total():
        found = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
        return sum(getattr(found.apply(k), field)() for k in range(found.size()))

    before = total()
    result = run()
    return total() - before, result


def test_counts_shuffle_hardly_more_than_the_trips(spark):
    """Hashes, times as numbers and second copies of the keys are made behind the shuffle: they were two thirds of it."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("k") % 40_000)
    made = spark.range(0, 20_000, 1, 4).select(F.pmod(F.xxhash64("id"), F.lit(10**12)).alias("k"), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(8000)).alias("seconds"))
    made = made.select(F.concat_ws("|", "k", F.lit("1")).alias("trip_id"), (F.col("k") % 500).alias("segment_id"), (F.col("k") % 40).alias("plate"), F.to_date(at).alias("service_date"), at.alias("start_at"), (at + F.expr("make_dt_interval(0, 0, 0, seconds)")).alias("end_at"), "seconds").cache()
    made.count()
    keys, bucket = ["segment_id", "service_date"], 86_400
    plain, _ = stage_sums(spark, lambda: made.repartition(4, *keys).write.format("noop").mode("overwrite").save(), "shuffleWriteBytes")
    moved, rows = stage_sums(spark, lambda: containment.overtake_counts(made, keys, bucket).collect(), "shuffleWriteBytes")
    pairs = trips.overtakes(made, keys, bucket, carry=("seconds",)).groupBy("overtaker_id").agg(F.count("*").alias("n"), F.sum("overtaken_seconds").alias("s"), F.max(F.struct("overtaken_id", "overtaken"))["overtaken"].alias("v"))
    assert {(r.trip_id, r.n, r.overtaken_s, r.last_overtaken) for r in rows} == {tuple(r) for r in pairs.collect()} and len(rows) > 1000
    assert moved < 1.25 * plain, (moved, plain)


def test_large_tables_are_dealt_to_more_tasks(spark, tmp_path, monkeypatch):
    """A task of the orders' join takes in a bounded share of the files, whatever the session's shuffle partitions."""
    from pingloom.plans import behaviour, queries, views

    month = F.lit("2024-01-01").cast("date")
    spark.range(0, 4000, 1, 2).select(F.col("id").alias("o_orderkey"), (F.col("id") * 7 % 90).alias("o_custkey"), F.date_add(month, (F.col("id") % 50).cast("int")).alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    lines = spark.range(0, 12_000, 1, 2).select((F.col("id") % 4000).alias("l_orderkey"), F.col("id").alias("l_linenumber"), (F.col("id") * 13 % 37).alias("l_partkey"), (F.col("id") * 11 % 30).alias("l_suppkey"), F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"), F.date_add(month, (F.col("id") % 50 + F.col("id") % 17).cast("int")).alias("l_shipdate"))
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    asked = {name: lambda made=made: made(spark, str(tmp_path)) for name, made in {"trips": queries.segment_trips, "moves": views.moves, "days": lambda s, d: behaviour.overtakes_by_day(s, d, ["physical"], ["physical"])}.items()}
    seen = lambda df: sorted(map(str, df.collect()))
    want = {name: seen(made()) for name, made in asked.items()}
    assert rounds.file_parts(spark, f"{tmp_path}/lineitem.parquet") is None and all(want.values())
    monkeypatch.setattr(rounds, "TASK_BYTES", 4096)
    dealt = queries.line_parts(spark, str(tmp_path))
    assert dealt > 8
    for name, made in asked.items():
        assert made().select(F.spark_partition_id()).distinct().count() > 4 or name == "days"
        assert seen(made()) == want[name]
    plan = asked["days"]()._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(rf"RepartitionByExpression .*, {dealt}\n", plan)) == 3, plan  # both tables and the buckets


def test_counts_do_without_what_the_segment_tells(spark):
    rows = [(dt.date(2024, 1, 1), "r/1", "p", f"v{k}", T + dt.timedelta(seconds=k), T + dt.timedelta(seconds=100 - k), 100 - 2 * k) for k in range(3)]
    moves = spark.createDataFrame(rows, "service_date date, segment_id string, physical_id string, plate string, start_at timestamp, end_at timestamp, seconds long")
    found = reads.counted_overtakes(moves, "physical")
    assert {(r.overtaker, r.n, r.segment_id) for r in found.collect()} == {("v1", 1, "r/1"), ("v2", 2, "r/1")} and not {"lat", "lon", "route"} & set(found.columns)


def tables(spark, path, n=12_000):
    """Orders of two months, and lines that ship up to ninety days later."""
    month = F.lit("2024-01-01").cast("date")
    at = lambda days: F.date_add(month, days.cast("int")).cast("timestamp_ntz")
    spark.range(0, 4000, 1, 2).select(F.col("id").alias("o_orderkey"), (F.col("id") * 7 % 90).alias("o_custkey"), at(F.col("id") % 60).alias("o_orderdate")).write.parquet(f"{path}/orders.parquet")
    lines = spark.range(0, n, 1, 2).select((F.col("id") % 4000).alias("l_orderkey"), F.col("id").alias("l_linenumber"), (F.col("id") * 13 % 37).alias("l_partkey"), (F.col("id") * 11 % 30).alias("l_suppkey"), F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"), at(F.col("id") % 4000 % 60 + 1 + F.col("id") % 89).alias("l_shipdate"))
    lines.write.parquet(f"{path}/lineitem.parquet")


def test_a_trip_of_a_month_is_shuffled_once_with_its_own_columns(spark, tmp_path):
    from pingloom.plans import behaviour, queries

    tables(spark, tmp_path)
    found = queries.trip_lines(spark, str(tmp_path)).cache()
    assert found.count() == 12_000
    month = behaviour.months(spark, str(tmp_path)).cache()
    bare = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "o_orderdate", "l_shipdate"]
    plain, _ = stage_sums(spark, lambda: found.select(bare).repartition(4, "l_partkey").write.format("noop").mode("overwrite").save(), "shuffleWriteBytes")
    asked = lambda dims: behaviour.overtakes_by_day(spark, str(tmp_path), ["segment_id"], dims)
    plan = asked(["segment_id", "route"])
    moved, rows = stage_sums(spark, plan.collect, "shuffleWriteRecords")
    few = len(rows) * 4  # partial counts of the answer
    assert moved <= 12_000 + few, moved  # lines and orders are small enough to broadcast or are cached
    bytes_, _ = stage_sums(spark, lambda: asked(["segment_id", "route"]).collect(), "shuffleWriteBytes")
    assert bytes_ < 1.6 * plain, (bytes_, plain)
    pairs = trips.overtakes(month, ["segment_id", "service_date"], 30 * 86_400)
    want = {(r.service_date, r.segment_id): r.n for r in pairs.groupBy("service_date", "segment_id").agg(F.count("*").alias("n")).collect()}
    assert {(r.service_date, r.segment_id): r.n for r in rows} == want and len(want) > 50


def test_a_shared_table_is_written_without_a_shuffle_in_the_order_of_days(spark, tmp_path):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 5).cast("int"))
    moved, made = shuffled(spark, lambda: rounds.once(spark, (str(tmp_path), "plain"), lambda: spark.range(0, 1000, 1, 3).select("id", day.alias("service_date"))))
    assert moved == 0 and made.count() == 1000 and len(made.inputFiles()) == 3
    for path in made.inputFiles():
        days = [r.service_date for r in spark.read.parquet(path).coalesce(1).collect()]
        assert days == sorted(days) and len(set(days)) == 5
    nothing = rounds.once(spark, (str(tmp_path), "nothing"), lambda: spark.range(0).select("id", day.alias("service_date")))
    assert nothing.collect() == [] and nothing.columns == ["id", "service_date"]


def test_moves_are_counted_from_the_columns_of_rides(spark, tmp_path):
    """What follows from a ride's columns is made behind the shuffle, and few moves go into two buckets."""
    from pingloom.plans import views

    tables(spark, tmp_path, 24_000)
    fast = views.fast_trips(spark, str(tmp_path)).cache()
    n = fast.count()
    named = fast.select("service_date", "segment_id", "physical_id", "plate", "start_at", "end_at", "seconds")
    for scope in ("route", "physical"):
        held, _ = shuffled(spark, lambda: views.ride_events(spark, str(tmp_path)).write.format("noop").mode("overwrite").save())
        moved, rows = shuffled(spark, lambda scope=scope: views.counted(spark, str(tmp_path), scope).collect())
        assert moved - held < 1.45 * n, (moved, held, n)
        want = reads.counted_overtakes(named, scope).collect()
        key = lambda r: str(sorted(r.asDict().items()))
        assert sorted(map(key, rows)) == sorted(map(key, want)) and len(rows) > 10


def test_tasks_are_dealt_by_size_where_the_session_has_more_partitions_than_needed(spark, tmp_path, monkeypatch):
    """Spark would join the session's many partitions to few large ones."""
    tables(spark, tmp_path)
    monkeypatch.setattr(rounds, "TASK_BYTES", 4096)
    paths = [f"{tmp_path}/{t}.parquet" for t in ("lineitem", "orders")]
    dealt = rounds.file_parts(spark, *paths)
    assert dealt > spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        assert rounds.file_parts(spark, *paths) == dealt
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_large_tables_are_packed_for_their_shuffles(spark, tmp_path, monkeypatch):
    """Lines, orders, trips and hops moved a column of eight bytes for each small number or time: now as few longs as their ranges need."""
    from pingloom.plans import behaviour, views

    tables(spark, tmp_path)
    asked = {"trips": lambda: behaviour.overtakes_by_day(spark, str(tmp_path), ["physical"], ["physical", "overtaker"]), "hops": lambda: views.counted(spark, str(tmp_path), "physical"), "rides": lambda: views.ride_events(spark, str(tmp_path))}
    seen = lambda df: sorted(map(str, df.collect()))
    want = {name: seen(made()) for name, made in asked.items()}
    monkeypatch.setattr(rounds, "TASK_BYTES", 4096)
    for name, made in asked.items():
        df = made()
        assert seen(df) == want[name] and len(want[name]) > 10
        moved = re.findall(r"RepartitionByExpression .*\n[^\n]*Project \[([^\n]*)\]", df._jdf.queryExecution().optimizedPlan().toString())
        assert moved and all("__p0" in x for x in moved), moved


def test_a_route_is_dealt_to_many_tasks(spark, monkeypatch):
    """All pairs of one route came from one task; ties and nulls in the order are no pairs."""
    monkeypatch.setattr(network, "RIDE_STOPS", 4)
    monkeypatch.setattr(network, "RIDE_PAIRS", 8)
    rows = [("r", k // 2 if k < 4 else k, k, 10 * k) for k in range(20)] + [("r", None, 90, 0), (None, 1, 91, 0), (None, 2, 92, 0), ("q", 1, 93, 5)]
    found = network.ride_edges(spark.createDataFrame(rows, "route string, stop_order long, stop_id long, distance long"))
    got = found.withColumn("task", F.spark_partition_id()).collect()
    want = {(a, b, d - c) for r, i, a, c in rows for q, j, b, d in rows if r == q == "r" and None not in (i, j) and i < j}
    assert {(r.from_stop, r.to_stop, r.meters) for r in got} == want and len(got) == len(want) == 188 and len({r.task for r in got}) > 1


def test_walks_to_hanging_nodes_are_not_moved(spark, monkeypatch):
    """Two busy nodes, 60 ends each: the walks, about the square of the ends, were shuffled each round."""
    monkeypatch.setattr(network, "HUNG", 16)
    monkeypatch.setattr(network, "WALKS", 256)
    far = lambda k: 150.0 if k % 2 else 50.0
    roads = [(k % 2, k, far(k)) for k in range(2, 122)] + [(0, 1, 100.0), (1, 0, 120.0), (0, 0, 5.0), (500, 501, 10.0)]
    at = [(k, k) for k in range(122)] + [(700, 2), (700, 3), (800, 500), (900, 999), (901, None)]
    frames = spark.createDataFrame(roads, "a long, b long, meters double").coalesce(1), spark.createDataFrame(at, "stop long, node long").coalesce(1)
    moved, got = shuffled(spark, lambda: network.road_walks(*frames, 300.0).collect())
    home = lambda k: (k, 0.0) if k < 2 else (k % 2, far(k))
    metres = lambda a, b: 0.0 if a == b else home(a)[1] + 100.0 * (home(a)[0] != home(b)[0]) + home(b)[1]
    want = {(a, b): metres(a, b) for a in range(122) for b in range(122)} | {(700, b): min(metres(2, b), metres(3, b)) for b in range(122)}
    want |= {(800, 500): 0.0, (800, 501): 10.0, (900, 999): 0.0, (901, None): 0.0}
    assert {(r.stop, r.node): r.meters for r in got} == {k: m for k, m in want.items() if m <= 300} and len(got) == len({(r.stop, r.node) for r in got})
    assert len(got) > 10_000 and moved < 5000


def test_only_busy_segments_are_dealt_out_by_time(spark, monkeypatch):
    """Trips of years in buckets of a day: each was copied into hundreds of them, also on a segment of few trips."""
    monkeypatch.setattr(trips, "BUSY", 30)
    start = dt.datetime(2020, 1, 1)
    rows = [(g, f"{g}{k:02d}", f"p{k % 7}", start + dt.timedelta(days=k), start + dt.timedelta(days=900 - 2 * k)) for g, n in (("s", 20), ("busy", 60)) for k in range(n)] + [(None, "x", "p", start, start)]
    found = spark.createDataFrame(rows, "segment string, trip_id string, plate string, start_at timestamp, end_at timestamp").coalesce(1)
    want = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[3] > b[3] and a[4] < b[4] and a[2] != b[2]}
    for given in (found, found.repartition("segment")):
        moved, pairs = shuffled(spark, lambda: trips.overtakes(given, ["segment"], 86_400, dealt=given is not found).collect())
        assert {(r.overtaker_id, r.overtaken_id) for r in pairs} == want and len(pairs) == len(want) and moved < 500


def test_the_whole_chain_moves_a_ping_once(spark):
    """Pings went through six shuffles, for each stop near them, and visits were written twice."""
    pings = [(f"r{v % 2}", f"v{v:02d}", T + dt.timedelta(seconds=60 * o + 20 * i + 7 * v), 55.7 + o / 200, 49.1) for v in range(20) for o in range(6) for i in range(2)]
    stops = [(f"r{r}", d, 10 * o + d, o if d == 0 else 5 - o, 55.7 + o / 200, 49.1 + d / 10000) for r in range(2) for d in range(2) for o in range(6)]
    segments = [(r, d, a, b, f"{a}|{b}", f"{a}|{b}", 556.0) for r, d, a, o, *_ in stops for q, e, b, n, *_ in stops if (r, d, o + 1) == (q, e, n)]
    frames = (
        spark.createDataFrame(pings, "route string, plate string, event_time timestamp, lat double, lon double").coalesce(1),
        spark.createDataFrame(stops, PLACED).coalesce(1),
        spark.createDataFrame(segments, "route string, direction int, from_stop long, to_stop long, segment_id string, physical_id string, metres double").coalesce(1),
    )
    moved, found = shuffled(spark, lambda: chain.segment_trips(*frames).collect())
    sure = {(f"v{v:02d}", 10 * o, 10 * o + 10, 40) for v in range(20) for o in range(5)}
    assert {(r.plate, r.from_stop, r.to_stop, r.seconds) for r in found if r.direction == 0 and r.from_stop in (0, 40)} <= sure
    assert moved < len(pings) + 24 * len(stops)
    again = chain.segment_trips(frames[0].repartition("plate"), *frames[1:], dealt=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, found))


def test_a_runs_pings_follow_from_the_number_of_lines(spark, tmp_path):
    """Lines went through a shuffle with five columns to be counted; an order that occurs twice has its lines twice."""
    spark.createDataFrame([(o, k) for o, n in ((1, 3), (2, 12), (3, 4), (9, 1)) for k in range(n)], "l_orderkey long, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 5), (2, 6), (3, 7), (3, 8), (4, 9)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = rides.chain_pings(spark, str(tmp_path)).groupBy("plate", "route", F.round((F.col("lat") - 55.7) * 200).cast("int").alias("k")).count().collect()
    want = {("v1", "p5", k) for k in range(1, 4)} | {("v2", "p6", k) for k in range(1, 10)} | {("v3", f"p{7 + (k + 1) % 2}", k) for k in range(1, 9)}
    assert {(r.plate, r.route, r.k) for r in got} == want and {r["count"] for r in got} == {3}


def test_visits_with_unknown_keys_have_no_other_direction(spark):
    rows = [("v", 1, 0, False), ("v", 1, 1, True), ("v", 1, None, None), (None, 1, 0, False), (None, 1, 1, False), ("w", 2, 1, False), ("w", 2, None, False)]
    found = spark.createDataFrame(rows, "plate string, stop_id int, direction int, is_terminal boolean")
    assert sorted(map(str, visits.direction_safe(found, ["plate", "stop_id"]).collect())) == sorted(map(str, found.collect()[1:2] + found.collect()[3:]))


def test_overtakes_of_a_day_move_a_trip_twice(spark):
    """Once to meet those alike, once to meet its segment; it was written between, and moved for both sides and every bucket that it touches."""
    day = dt.date(2024, 1, 1)
    rows = [(day, "s", f"v{k:02d}", T + dt.timedelta(seconds=10 * k), T + dt.timedelta(seconds=4000 - 10 * k), 4000 - 20 * k) for k in range(60)]
    found = spark.createDataFrame(rows, "service_date date, segment string, plate string, start_at timestamp, end_at timestamp, seconds long").coalesce(1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        moved, pairs = shuffled(spark, lambda: chain.day_overtakes(found, ["segment"]).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert {(r.overtaker, r.overtaken) for r in pairs} == {(f"v{a:02d}", f"v{b:02d}") for a in range(60) for b in range(a)} and len(pairs) == 1770 and moved <= 2 * 60


def test_many_stops_at_few_spots_leave_points_in_place(spark, monkeypatch):
    """With too many stops to send to all tasks, every point was shuffled by its cell, also those near none."""
    monkeypatch.setattr(visits, "BROADCAST_ROWS", 10)
    points = spark.createDataFrame([(k, 55.7 + k % 40 / 1000, 49.1) for k in range(400)], "event_id long, lat double, lon double").coalesce(1)
    for n in (40, 400):  # their rows fit where the cells of ten stops do, or don't
        stops = spark.createDataFrame([(s, 55.7 + s % 4 / 1000, 49.1, f"s{s}") for s in range(n)] + [(990, None, 49.1, "x"), (991, 60.0, 49.1, "y")], "stop_id long, stop_lat double, stop_lon double, name string").coalesce(1)
        moved, found = shuffled(spark, lambda: visits.geo_join(points, stops, 40.0).select("event_id", "stop_id", "name", "distance_m").collect())
        assert sorted((r.event_id, r.stop_id) for r in found) == [(e, s) for e in range(400) for s in range(n) if e % 40 == s % 4] and moved < 200 + 2 * n
        assert all(r.name == f"s{r.stop_id}" and r.distance_m == 0 for r in found)
