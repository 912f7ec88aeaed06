import heapq

import numpy as np
import pytest
from pyspark.sql import functions as F

from pingloom.operators import network, walks


def _city(seed, n=9):
    """A bent grid of streets some hundred metres apart, a few of them missing."""
    rng = np.random.default_rng(seed)
    place = {i * n + j: (55.7 + i * 0.004 + float(rng.normal()) / 4000, 49.1 + j * 0.006 + float(rng.normal()) / 4000) for i in range(n) for j in range(n)}
    pairs = [(i * n + j, i * n + j + s) for i in range(n) for j in range(n) for s in (1, n) if (s == 1 and j + 1 < n) or (s == n and i + 1 < n)]
    return place, [(a, b, *place[a], *place[b], 480.0 + float(rng.integers(0, 200))) for a, b in pairs if rng.random() < 0.85]


ROAD = "a long, b long, a_lat double, a_lon double, b_lat double, b_lon double, metres double"


@pytest.mark.parametrize("tile_m, share", [(900.0, 500), (4000.0, 2), (1e6, 500)])
def test_tiles_equal_one_search_over_the_whole_graph(spark, monkeypatch, tile_m, share):
    monkeypatch.setattr(walks, "STOPS", share)
    place, roads = _city(1)
    stops = [(s, *place[s]) for s in range(0, 81, 5)]
    joins = [(s, s, 10.0) for s, *_ in stops] + [(0, 1, 300.0), (5, 6, 5000.0)]
    edges = {}
    for a, b, *_, m in roads:
        edges.setdefault(a, []).append((b, m))
        edges.setdefault(b, []).append((a, m))
    want = {}
    for s, *_ in stops:
        todo, best = [(m, n) for t, n, m in joins if t == s], {}
        heapq.heapify(todo)
        while todo:
            d, n = heapq.heappop(todo)
            if d > 2000 or n in best:
                continue
            best[n] = d
            for b, m in edges.get(n, []):
                heapq.heappush(todo, (d + m, b))
        want |= {(s, n): d for n, d in best.items()}
    got = walks.tiled_walks(spark.createDataFrame(roads, ROAD).repartition(3), spark.createDataFrame(stops, "stop long, lat double, lon double"), spark.createDataFrame(joins, "stop long, node long, metres double"), tile_m=tile_m).collect()
    assert len(got) == len(want) and {(r.stop, r.node): round(r.metres, 6) for r in got} == {k: round(v, 6) for k, v in want.items()}
    slow = network.road_walks(spark.createDataFrame([(a, b, m) for a, b, *_, m in roads], "a long, b long, meters double"), spark.createDataFrame([(10, 10)], "stop long, node long"), 1990.0)
    assert {r.node: round(r.meters + 10, 6) for r in slow.collect()}.items() <= {n: round(d, 6) for (s, n), d in want.items() if s == 10}.items()


def test_candidates_and_labels(spark):
    """A street of two pieces between two stops: each piece by its nearer end; the first to arrive need not be the nearest."""
    road = spark.createDataFrame([(7, 1, 2, 55.7, 49.1, 55.7, 49.1006)], "road long, a long, b long, a_lat double, a_lon double, b_lat double, b_lon double")
    pieces = walks.cut_roads(road, 20.0)
    assert [(r.piece.place, round(r.to_a + r.to_b, 6) == round(2 * r.metres, 6)) for r in pieces.orderBy("piece").collect()] == [(0, True), (1, True)]
    found = spark.createDataFrame([(10, 1, 5.0), (10, 2, 40.0), (20, 2, 2.0), (30, 1, 1999.0)], "stop long, node long, metres double")
    near = {(r.piece.place, r.stop): r.metres for r in walks.walk_candidates(found, pieces).collect()}
    half = pieces.first().metres / 2
    assert {k: round(v, 6) for k, v in near.items()} == {k: round(v, 6) for k, v in {(0, 10): 5 + half, (1, 10): 5 + 3 * half, (0, 20): 2 + 3 * half, (1, 20): 2 + half}.items()}
    arrivals = spark.createDataFrame([(10, 100), (20, 600)], "stop long, seconds long")
    best = {r.piece.place: (r.stop, r.nearest_stop, r.nearest_seconds) for r in walks.best_and_nearest(walks.walk_candidates(found, pieces), arrivals).collect()}
    assert best == {0: (10, 10, 100), 1: (10, 20, 600)}


def test_nothing_to_walk_on(spark):
    roads, stops = spark.createDataFrame([], ROAD), spark.createDataFrame([(1, 55.7, 49.1)], "stop long, lat double, lon double")
    joins = spark.createDataFrame([(1, 4, 9.0)], "stop long, node long, metres double")
    assert [tuple(r) for r in walks.tiled_walks(roads, stops, joins).collect()] == [(1, 4, 9.0)]
    assert walks.tiled_walks(roads, stops.limit(0), joins.where(F.lit(False))).count() == 0
