import datetime as dt
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from pingloom.operators import journeys, runs

EVENT = "service_date date, pattern string, ride string, from_stop long, to_stop long, dep long, arr long, start_order long, end_order long"
DAY = dt.date(2024, 1, 1)


def _frame(spark, rows, day=DAY):
    return spark.createDataFrame([(day, *r, *[None] * (8 - len(r))) for r in rows], EVENT)


def _asked(spark, rows, day=DAY):
    return spark.createDataFrame([(day, *r) for r in rows], "service_date date, origin long, requested long")


def _brute(events, asked, rides, boardings):
    """Label search over plain lists by the rules of vehicle_runs and run_journeys."""
    by_ride, patterns, board = defaultdict(list), defaultdict(set), defaultdict(list)
    for e in events:
        by_ride[e[1]].append(e)
        for s in (e[2], e[3]):
            patterns[s].add(e[0])
    onward = {}
    for ride, own in by_ride.items():
        own.sort(key=lambda e: (e[4], e[5], e[2], e[3]))
        latest, chain, off = None, [], []
        for e in own:
            (chain if latest is None or e[4] >= latest else off).append(e)
            latest = e[5] if latest is None else max(latest, e[5])
        for e in own:
            i = chain.index(e) + 1 if e in chain else next((k for k, m in enumerate(chain) if m[4] >= e[5]), len(chain))
            rest, last = [], e
            for m in chain[i:]:
                if m[4] - last[5] > 1800:
                    break
                rest.append(m)
                last = m
            onward[e] = rest
    for e in events:
        board[e[2], e[0]].append(e)
    out = {}
    for origin, requested in asked:
        best, moving = {}, {origin: (requested, "")}
        for k in range(1, rides + 1):
            new = {}
            for stop, (at, path) in moving.items():
                for p in patterns[stop]:
                    later = sorted((e for e in board[stop, p] if e[4] >= at), key=lambda e: (e[4], e[5], e[1], e[3]))[:boardings]
                    for e in later:
                        for m in [e, *onward[e]]:
                            text = f"{path}>" * bool(path) + f"{p}-{e[1]}-{stop}-{m[3]}-{e[4]}-{m[5]}"
                            if m[3] != origin and (m[5], text) < new.get(m[3], (1 << 60, "")):
                                new[m[3]] = (m[5], text)
            new = {s: v for s, v in new.items() if v[0] < best.get(s, 1 << 60)}
            for s, v in new.items():
                best[s] = v[0]
                out[origin, requested, s, k] = v
            moving = {s: v for s, v in new.items() if len(patterns[s]) > 1}
    return out


def test_one_bus_is_one_ride(spark):
    """Six stops by one vehicle: one ride to each; after a gap of over half an hour it is another run."""
    line = [("a", "a|1", k, k + 1, 100 + k * 60, 150 + k * 60) for k in range(6)] + [("a", "a|1", 6, 7, 5000, 5100)]
    got = runs.run_journeys(_frame(spark, line), _asked(spark, [(0, 90)])).collect()
    assert {r.stop: (r["at"], r.rides, len(r.legs)) for r in got} == {k: (90 + k * 60, 1, 1) for k in range(1, 7)}


def test_journeys_equal_brute_force_for_many_origins(spark):
    rng, rows = np.random.default_rng(8), []
    for run in range(90):
        pattern, at = int(rng.integers(0, 5)), int(rng.integers(0, 9000))
        stops = [int(x) for x in rng.permutation(np.arange(pattern * 3, pattern * 3 + 7))[: rng.integers(2, 7)]]
        for k, (a, b) in enumerate(zip(stops, stops[1:], strict=False)):
            dep = at + int(rng.integers(0, 90)) + (2500 if rng.random() < 0.05 else 0)
            at = dep + int(rng.integers(30, 400))
            rows.append((f"p{pattern}", f"p{pattern}|{run % 9}", a, b, dep, at, k, k + 1))
    rows = sorted(set(rows))
    asked = [(s, t) for s in range(0, 19, 2) for t in (0, 4000)]
    got = {(r.origin, r.requested, r.stop, r.rides): (r["at"], r.path) for r in runs.run_journeys(_frame(spark, rows), _asked(spark, asked), boardings=2, slot_s=700).collect()}
    want = _brute([r[:6] for r in rows], asked, 3, 2)
    assert got == want and {k[3] for k in want} == {1, 2, 3}


def test_changes_only_where_two_patterns_meet(spark):
    rows = [("a", "a|1", 0, 1, 0, 10), ("a", "a|2", 1, 2, 20, 30), ("b", "b|1", 2, 3, 40, 50), ("a", "a|2", 2, 4, 35, 45)]
    got = {(r.origin, r.stop): r.rides for r in runs.run_journeys(_frame(spark, rows), _asked(spark, [(0, 0), (1, 0)])).collect()}
    assert got == {(0, 1): 1, (1, 2): 1, (1, 4): 1, (1, 3): 2}  # stop 1 has one pattern: nobody changes there, but journeys begin there
    links = spark.createDataFrame([(0, 1, 0, 5, 1), (1, 2, 6, 9, 1)], "from_stop long, to_stop long, dep long, arr long, plate long")
    origins = spark.createDataFrame([(0, 0, 0), (1, 1, 0)], "origin long, stop long, at long")
    none = spark.createDataFrame([], "stop_id long")
    reached = journeys.network_journeys(links, origins, none).collect()
    assert {(r.origin, r.stop) for r in reached} == {(0, 0), (0, 1), (1, 1), (1, 2)}


def test_skipped_stops_are_filled(spark):
    rows = [("a", "a|1", 0, 1, 0, 100, 0, 1), ("a", "a|1", 4, 5, 400, 450, 4, 5)]
    events = _frame(spark, rows)
    table = runs.vehicle_runs(events)
    stops = spark.createDataFrame([("a", k, k) for k in range(6)], "pattern string, stop long, stop_order long")
    filled = runs.filled_stops(events, table, stops)
    assert {(r.to_stop, r.arr) for r in filled.collect()} == {(2, 200), (3, 300)}
    got = runs.run_journeys(events, _asked(spark, [(0, 0), (4, 0)]), skipped=filled).collect()
    assert {(r.origin, r.stop): r["at"] for r in got} == {(0, 1): 100, (0, 2): 200, (0, 3): 300, (0, 5): 450, (4, 5): 450}


def test_fragments_and_counts(spark):
    rows = [("a", "a|1", 0, 1, 10, 20), ("b", "b|1", 1, 2, 25, 40), ("b", "b|1", 2, 3, 41, 60)]
    asked = _asked(spark, [(0, 5), (3, 5)])
    best = runs.run_journeys(_frame(spark, rows), asked)
    parts = [tuple(r) for r in runs.ride_fragments(best.where("stop = 3")).orderBy("fragment").select("rides", "ride", "from_stop", "to_stop", "wait_s", "ride_s").collect()]
    assert parts == [(2, "a|1", 0, 1, 5, 10), (2, "b|1", 1, 3, 5, 35)]
    assert [tuple(r)[1:] for r in runs.request_counts(best, asked, 4).collect()] == [(5, 6, 3, 5, 15 + 35 + 55)]
    assert runs.run_journeys(_frame(spark, []), asked).count() == 0 and [r.reached for r in runs.request_counts(runs.run_journeys(_frame(spark, []), asked), asked, 4).collect()] == [0]


def test_days_are_apart(spark):
    both = _frame(spark, [("a", "a|1", 0, 1, 10, 20)]).unionByName(_frame(spark, [("a", "a|1", 1, 2, 30, 40)], dt.date(2024, 1, 2)))
    got = runs.run_journeys(both, _asked(spark, [(0, 0)]).withColumn("service_date", F.lit(DAY))).collect()
    assert [(r.stop, r.service_date) for r in got] == [(1, DAY)]
