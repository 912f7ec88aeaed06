import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from pingloom.operators import journeys, network


def every_path(edges, walks, clusters, origin, rides):
    """All loop-free paths: after each ride one walk at most, at the end one way inside a cluster."""
    out, front = [], [((origin,), (), 0.0, 0, False)]
    while front:
        path, walked, m, r, after = front.pop()
        if r:
            out.append((path, walked, m, r))
            out += [((*path, b), (*walked, w), m + w, r) for (a, b), w in clusters.items() if a == path[-1] and b not in path]
        if r < rides:
            front += [((*path, b), (*walked, None), m + w, r + 1, False) for (a, b), w in edges.items() if a == path[-1] and b not in path]
        if r and not after:
            front += [((*path, b), (*walked, w), m + w, r, True) for (a, b), w in walks.items() if a == path[-1] and b not in path]
    return out


@pytest.mark.parametrize("seed, most", [(1, 1), (2, 3), (3, 8)])
def test_k_paths_with_walks_and_clusters_equal_brute_force(spark, seed, most):
    """A hub on most of the shortest ways, few lengths (many ties), and small limits, so that cuts matter."""
    rng = np.random.default_rng(seed)
    pairs = [(a, b) for a in range(9) for b in range(9) if a != b]
    edges = {p: float(rng.integers(1, 4)) * (1 if 4 in p else 3) for p in pairs if rng.random() < 0.6}
    walks = {p: float(rng.integers(1, 3)) for p in pairs if rng.random() < 0.12}
    clusters = {p: 1.0 for p in pairs if rng.random() < 0.08}
    frame = lambda e: spark.createDataFrame([(*p, m) for p, m in e.items()], "from_stop long, to_stop long, meters double")
    got = network.k_paths(frame(edges), spark.range(9).withColumnRenamed("id", "origin"), 3, most, 3.0, frame(walks), frame(clusters)).collect()
    want = set()
    for origin in range(9):
        found = every_path(edges, walks, clusters, origin, 3)
        for stop in range(9):
            here = [x for x in found if x[0][-1] == stop]
            near = sorted((x for x in here if x[2] <= 3.0 * min(y[2] for y in here)), key=lambda x: (x[3], x[2], ">".join(map(str, x[0])), [w is not None for w in x[1]]))
            want |= {(origin, stop, p, tuple(w is not None for w in ws), m, r) for p, ws, m, r in near[:most]}
    assert {(r.origin, r.stop, tuple(r.path), tuple(w is not None for w in r.meters_walked), r.meters, r.rides) for r in got} == want


def test_labels_that_are_kept_do_not_grow_with_prefixes():
    """Of many prefixes to a stop a few are kept, and all ways to go on are still open."""
    rng = np.random.default_rng(5)
    labels = [frozenset(rng.choice(40, 3, replace=False).tolist()) | {99} for _ in range(3000)]
    kept = network.undominated(labels, 8, 3)
    assert len(kept) < 60
    for ahead in itertools.islice(itertools.combinations(range(40), 3), 0, 9880, 37):
        free = [k for k, x in enumerate(labels) if not x & set(ahead)][:8]
        assert free == [k for k in kept if not labels[k] & set(ahead)][:8]
    assert network.undominated([frozenset({1, 2})] * 50, 8, 0) == [*range(8)]


def test_replay_rides_shared_prefixes_once(spark):
    paths = spark.createDataFrame([(0, 2, [0, 1, 2], [None, None]), (0, 3, [0, 1, 3], [None, 14.0]), (0, 1, [0, 1], [None])], "origin long, stop long, path array<long>, meters_walked array<double>")
    assert sorted((r.level, r.up, r.node) for r in journeys.path_trie(paths).collect()) == [(1, "", "1:ride"), (2, "1:ride", "1:ride>2:ride"), (2, "1:ride", "1:ride>3:14.0")]
    trips = spark.createDataFrame([(0, 1, 5, 30, 1), (0, 1, 8, 20, 2), (0, 1, 2000, 2010, 1), (1, 2, 19, 21, 1), (1, 2, 25, 40, 1), (1, 2, 1000, 1001, 1)], "from_stop long, to_stop long, dep long, arr long, plate long")
    asked = spark.createDataFrame([(0, 0, 0), (0, 9, 9)], "origin long, at long, requested long")
    for slot in (4, 900):
        got = {(r.requested, r.stop): r["at"] for r in journeys.replay(paths, trips, asked, slot=slot).collect()}
        assert got == {(0, 1): 20, (0, 2): 40, (0, 3): 30, (9, 1): 2010, (9, 3): 2020}
    more = spark.createDataFrame([(0, 0, 2, 35), (0, 9, 2, 7000), (0, 9, 3, 1)], "origin long, requested long, stop long, at long")
    got = {(r.requested, r.stop): r["at"] for r in journeys.replay(paths, trips, asked, fallback=more, least=3).collect()}
    assert got == {(0, 1): 20, (0, 2): 40, (0, 3): 30, (9, 1): 2010, (9, 2): 7000, (9, 3): 1}  # only the request with too few


def test_slots_equal_a_scan(spark):
    rng = np.random.default_rng(7)
    rows = [(int(a), int(b), int(d), int(d + x), int(p)) for a, b, d, x, p in zip(rng.integers(0, 3, 200), rng.integers(0, 3, 200), rng.integers(0, 500, 200), rng.integers(1, 200, 200), rng.integers(0, 9, 200), strict=True)]
    trips = spark.createDataFrame(rows, "from_stop long, to_stop long, dep long, arr long, plate long")
    slots = journeys.arrival_slots(trips, ["from_stop", "to_stop"], 40)
    asked = spark.range(0, 520, 7).withColumnRenamed("id", "at").withColumn("slot", F.floor(F.col("at") / 40).cast("long"))
    soon = F.array_min(F.filter("now", lambda t: t["dep"] >= F.col("at")))
    best = asked.join(slots, "slot").withColumn("b", F.least(F.coalesce(soon, "later"), F.coalesce("later", soon))).where("b is not null")
    got = {(r["at"], r.from_stop, r.to_stop): tuple(r.b) for r in best.collect()}
    want = {}
    for t in range(0, 520, 7):
        for a, b, d, arr, p in rows:
            if d >= t:
                want[t, a, b] = min(want.get((t, a, b), (1 << 40,)), (arr, d, p))
    assert got == want


def test_a_level_does_not_move_trips(spark, monkeypatch):
    """Trips lie in buckets of (from, to, slot): a level's join has no exchange on their side."""
    from pingloom.operators import rounds

    trips = spark.range(1000).selectExpr("id % 7 as from_stop", "id % 5 as to_stop", "id as dep", "id + 3 as arr", "id as plate")
    slots = rounds.written_by(journeys.arrival_slots(trips, ["from_stop", "to_stop"], 900), "slots", ["from_stop", "to_stop", "slot"])
    asked = spark.range(5000).selectExpr("id % 7 as from_stop", "id % 5 as to_stop", "id % 3 as slot", "id as request").repartition(3)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = asked.join(slots, ["from_stop", "to_stop", "slot"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange hashpartitioning(from_stop") + plan.count("Exchange hashpartitioning(to_stop") == 1, plan


def test_a_few_origins_read_a_few_parts(spark, tmp_path):
    paths = spark.range(4000).selectExpr("id % 200 as origin", "id as stop", "array(id) as path")
    network.write_graph(paths, f"{tmp_path}/g", 16)
    graph = spark.read.parquet(f"{tmp_path}/g")
    asked = spark.createDataFrame([(7,), (8,), (7,)], "origin long")
    found = network.read_graph(graph, asked.where("origin > 0"), 16)
    assert {r.origin for r in found.collect()} == {7, 8} and found.count() == 40
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
