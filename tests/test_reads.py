import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pingloom.operators import containment, reads, rollup, trips

T = dt.datetime(2024, 1, 1, 8)


def _trips(spark, rows):
    rows = [(dt.date(2024, 1, 1), seg, f"t{k:05d}", plate, T + dt.timedelta(seconds=a), T + dt.timedelta(seconds=b), b - a) for k, (seg, plate, a, b) in enumerate(rows)]
    return spark.createDataFrame(rows, "service_date date, segment string, trip_id string, plate string, start_at timestamp, end_at timestamp, seconds long")


@pytest.mark.parametrize("chunk, bucket", [(1 << 16, 900), (40, 60), (1, 5000)])
def test_counts_equal_pairs(spark, monkeypatch, chunk, bucket):
    """Ties of starts and ends, a vehicle's own trips, a busy segment, nulls of plate; in chunks of any size."""
    monkeypatch.setattr(containment, "CHUNK", chunk)
    rng = np.random.default_rng(11)
    rows = [("hot" if rng.random() < 0.5 else f"s{rng.integers(0, 9)}", f"p{rng.integers(0, 6)}", a := int(rng.integers(0, 300)) * 10, a + int(rng.integers(1, 90)) * 10) for _ in range(400)]
    found = _trips(spark, rows).repartition(3)
    pairs = trips.overtakes(found, ["segment", "service_date"], 600, carry=("seconds",))
    want = {(r.overtaker_id, r.n, r.s) for r in pairs.groupBy("overtaker_id").agg(F.count("*").alias("n"), F.sum("overtaken_seconds").alias("s")).collect()}
    got = containment.overtake_counts(found, ["segment", "service_date"], bucket)
    assert {(r.trip_id, r.n, r.overtaken_s) for r in got.collect()} == want and len(want) > 100
    for dims in (["segment"], ["overtaker"], ["segment", "overtaker"]):
        by_pair = pairs.groupBy("service_date", *dims).agg(F.count("*").alias("n"), F.max(F.struct("overtake_at", "overtaker_id", "overtaken_id", "overtaken"))["overtaken"].alias("o"), rollup.rounded(F.avg("overtaker_seconds")).cast("long").alias("a"), rollup.rounded(F.avg("overtaken_seconds")).cast("long").alias("b"))
        by_tree = containment.overtakes_by_day(found, ["segment"], dims, bucket_s=bucket)
        assert {tuple(r[d] for d in dims) + (r.n, r.last_overtaken, r.overtaker_mean_s, r.overtaken_mean_s) for r in by_tree.collect()} == {tuple(r[d] for d in dims) + (r.n, r.o, r.a, r.b) for r in by_pair.collect()}


def test_roll_up_makes_no_pairs(spark):
    """500 trips nested in each other: 124,750 pairs, of which no operator puts out more than a few rows a trip."""
    found = _trips(spark, [("s", f"p{k}", k, 2000 - k) for k in range(500)])
    rows = containment.overtakes_by_day(found, ["segment"], ["segment"]).collect()
    assert rows[0].n == 500 * 499 // 2
    counts = containment.overtake_counts(found, ["segment"])
    assert counts.count() == 499 and counts.agg(F.sum("n")).first()[0] == 500 * 499 // 2


EVENTS = "service_date date, segment_id string, physical_id string, route string, overtaker string, overtaken string, overtake_at timestamp, overtaker_s long, overtaken_s long, lat double, lon double"


def _event(day, n, plate="a", segment="s1"):
    return (dt.date(2024, 1, day), segment, "p1", "7", plate, "z", dt.datetime(2024, 1, day, 8, n), 60, 91 + n, 55.7 + n / 1000, 49.1)


def test_overtakes_by_period_scope_and_mode(spark):
    events = spark.createDataFrame([_event(1, 0), _event(1, 7), _event(2, 3, "b", "s2"), _event(8, 1), _event(9, 1)], EVENTS)
    n = lambda **k: {r[0]: (r.n, r.days, r.per_day) for r in reads.overtakes(events, **k).collect()}
    assert n(period="previous", day="2024-01-01") == {"s1": (2, 1, 2.0)}
    assert n(today="2024-01-09") == {"s1": (3, 2, 1.5), "s2": (1, 1, 1.0)}  # the day itself isn't over yet
    assert n(period="weekday", weekday=1, today="2024-01-09", scope="physical") == {"p1": (3, 2, 1.5)}
    assert n(scope="physical", mode="vehicle", today="2024-02-01") == {"a": (4, 3, 1.33), "b": (1, 1, 1.0)}
    assert reads.overtakes(events, mode="pointHeatmap", today="2024-02-01").count() == 4
    page = reads.overtake_details(events, page=2, size=2, plate="a", today="2024-02-01").collect()
    assert [(r.total, r.has_more) for r in page] == [(4, False)] * 2 and page[0].overtake_at.day == 1
    assert sorted((r.bucket.minute, r.n) for r in reads.overtake_timeline(events, segment="s1", period="previous", day="2024-01-01").collect()) == [(0, 1), (5, 1)]
    assert n(today="2020-01-01") == {} and reads.overtakes(events.limit(0), today="2024-02-01").count() == 0


def test_dwell_speed_and_last_pass(spark):
    rows = [(dt.date(2024, 1, 1), p, "7", s, T + dt.timedelta(minutes=m), T + dt.timedelta(minutes=m, seconds=d), d, t, 55.7, 49.1) for p, s, m, d, t in [("a", "1", 0, 30, True), ("a", "2", 6, 90, False), ("b", "2", 9, 60, False), ("b", "1", 20, 0, True)]]
    events = spark.createDataFrame(rows, "service_date date, plate string, route string, stop_id string, entered_at timestamp, exited_at timestamp, dwell long, is_terminal boolean, lat double, lon double")
    n = lambda **k: {r[0]: (r.n, r.total_s, r.most_s) for r in reads.dwell(events, today="2024-02-01", **k).collect()}
    assert n() == {"1": (1, 30, 30), "2": (2, 150, 90)} and n(policy="without-terminals") == {"2": (2, 150, 90)}
    assert n(mode="longClusters") == n(over60=True) == {"2": (1, 90, 90)} and n(mode="vehicle", stop="2") == {"a": (1, 90, 90), "b": (1, 60, 60)}
    assert [r.total for r in reads.dwell_details(events, plate="b", today="2024-02-01").collect()] == [1]
    assert sorted(r.bucket.minute for r in reads.dwell_timeline(events, today="2024-02-01").collect()) == [0, 5]
    best = {r.stop_id: (r.plate, r.dwell, r.second_of_day) for r in reads.last_passes(events, ("stop_id",), today="2024-02-01").collect()}
    assert best == {"1": ("b", 0, 30000), "2": ("b", 60, 8 * 3600 + 600)}
    moved = [(dt.date(2024, 1, d), "s", "p", "7", 0, 55.70, 49.10, 55.702, 49.1, v, T) for d, v in [(1, 10.0), (1, 20.0), (2, 30.0), (2, 0.0), (3, None)]]
    runs = spark.createDataFrame(moved, "service_date date, segment_id string, physical_id string, route string, direction int, from_lat double, from_lon double, to_lat double, to_lon double, speed_kmh double, end_at timestamp")
    assert [tuple(r) for r in reads.speed_map(runs, today="2024-02-01").collect()] == [(55701, 49100, 3, 2, 20.0, 10.0, 30.0)]
    assert [r.mean_kmh for r in reads.speed_map(runs, "route", period="previous", day="2024-01-01").collect()] == [15.0]


def test_clusters_of_one_name(spark):
    stops = spark.createDataFrame([("b", "Park", 55.7, 49.1), ("a", "park ", 55.7005, 49.1), ("c", "Park", 55.8, 49.1), ("d", "Arch", 55.7, 49.1), ("e", None, 55.7, 49.1)], "stop_id string, stop_name string, stop_lat double, stop_lon double")
    assert [(r.label, r.stop_ids, r.names) for r in reads.origin_clusters(stops).collect()] == [("Arch", ["d"], ["Arch"]), ("Park", ["c"], ["Park"]), ("park ", ["a", "b"], ["Park", "park "])]
