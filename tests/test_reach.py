import math

import numpy as np
import pytest

from pingloom.operators import reach

SEG = "a_lat double, a_lon double, b_lat double, b_lon double, metres double, minutes long"


def _pixel(lat, lon, z):
    s = math.sin(math.radians(lat))
    return (lon + 180) / 360 * 256 * 2**z, (0.5 - math.log((1 + s) / (1 - s)) / (4 * math.pi)) * 256 * 2**z


def test_pixels_equal_a_distance_test(spark):
    """Slanted, level, upright, short and zero-length lines over tile borders, thin and wide; where lines cross, the least minutes."""
    rng = np.random.default_rng(6)
    rows = [(55.7 + float(rng.normal()) / 300, 49.1 + float(rng.normal()) / 300, 55.7 + float(rng.normal()) / 300, 49.1 + float(rng.normal()) / 300, 1.0, int(k)) for k in range(12)]
    rows += [(55.7, 49.1, 55.7, 49.104, 1.0, 40), (55.7, 49.1, 55.703, 49.1, 1.0, 41), (55.701, 49.101, 55.701, 49.101, 1.0, 42)]
    widths = {13: 1, 15: 5.5}
    got = {(r.z, r.x * 256 + r.px, r.y * 256 + r.py): r.minutes for r in reach.line_pixels(spark.createDataFrame(rows, SEG), widths).collect()}
    want = {}
    for z, w in widths.items():
        for a, b, c, d, _, m in rows:
            (ax, ay), (bx, by) = _pixel(a, b, z), _pixel(c, d, z)
            for px in range(int(min(ax, bx)) - 5, int(max(ax, bx)) + 6):
                for py in range(int(min(ay, by)) - 5, int(max(ay, by)) + 6):
                    x, y, square = px + 0.5, py + 0.5, (bx - ax) ** 2 + (by - ay) ** 2
                    t = min(1, max(0, ((x - ax) * (bx - ax) + (y - ay) * (by - ay)) / square)) if square else 0
                    if math.hypot(x - ax - t * (bx - ax), y - ay - t * (by - ay)) <= w / 2:
                        want[z, px, py] = min(m, want.get((z, px, py), 1 << 30))
    assert got == want


def _parts(cells):
    left, out = set(cells), []
    while left:
        todo, part = [left.pop()], set()
        while todo:
            x, y = todo.pop()
            part.add((x, y))
            for n in [(x + i, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1)]:
                if n in left:
                    left.remove(n)
                    todo.append(n)
        out.append(part)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_polygons_of_all_thresholds(spark, seed):
    rng = np.random.default_rng(seed)
    cells = {(int(x), int(y)): int(m) for x, y, m in zip(rng.integers(-15, 15, 160), rng.integers(-15, 15, 160), rng.integers(0, 80, 160), strict=True)}
    df = spark.createDataFrame([(x, y, m) for (x, y), m in cells.items()], "x long, y long, minutes long")
    found = reach.threshold_components(df)
    got, want = {}, {}
    for r in found.collect():
        got.setdefault((r.threshold, r.component), set()).add((r.x, r.y))
    for t in reach.THRESHOLDS:
        want[t] = sorted(map(sorted, _parts([c for c, m in cells.items() if m <= t])))
        assert sorted(sorted(v) for (k, _), v in got.items() if k == t) == want[t]
    for r in reach.polygons(found, 10.0).collect():
        part, ring = got[r.threshold, r.component], [*zip(r.xs, r.ys, strict=True)]
        assert r.cells == len(part) and r.area_m2 >= 100 * len(part)
        turn = lambda p, q, c: (q[0] - p[0]) * (c[1] - p[1]) - (q[1] - p[1]) * (c[0] - p[0])
        corners = {(x + i, y + j) for x, y in part for i in (0, 1) for j in (0, 1)}
        assert set(ring) <= corners and all(turn(p, q, c) >= 0 for p, q in zip(ring, ring[1:] + ring[:1], strict=True) for c in corners)
        assert abs(r.lats[0] * 111320 - r.ys[0] * 10.0) < 1e-6


def test_cells_households_and_nothing_in_reach(spark):
    segments = spark.createDataFrame([(55.7, 49.1, 55.7009, 49.1, 100.0, 10), (55.7, 49.1, 55.7, 49.1, 0.0, 50)], SEG)
    cells = reach.reached_cells(segments, 25.0, 250.0)
    rows = cells.collect()
    assert {r.minutes for r in rows} == {10}  # the later one starts where the earlier one is
    disc = sum(math.hypot(i, j) <= 10.25 for i in range(-10, 11) for j in range(-10, 11))
    assert disc < len(rows) < 2 * disc
    homes = spark.createDataFrame([(rows[0].x, rows[0].y, 7), (0, 0, 100)], "x long, y long, households long")
    shapes = reach.polygons(reach.threshold_components(cells), 25.0)
    total = {r.threshold: tuple(r)[1:] for r in reach.reach_totals(cells, shapes, homes).collect()}
    assert total[15][:3] == total[60][:3] == (len(rows), 7, 1) and 0.2 < total[15][3] < 0.4
    none = reach.reached_cells(segments.where("minutes > 99"))
    empty = reach.polygons(reach.threshold_components(none))
    assert [tuple(r)[1:] for r in reach.reach_totals(none, empty, homes).collect()] == [(0, 0, 0, 0.0)] * 3
