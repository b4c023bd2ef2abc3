import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasift.operators import cover as C
from terrasift.operators import spatial as S

EDGE = "poly_id int, poly_ord int, ring_id int, hole boolean, xi double, yi double, xj double, yj double"


def ring(points):
    return [(*a, *b) for a, b in zip(points, [*points[1:], points[0]], strict=True)]


def odd(edges, x, y):
    return sum((yi > y) != (yj > y) and x < (xj - xi) * (y - yi) / (yj - yi) + xi for xi, yi, xj, yj in edges) % 2


def star(rng, n, cx, cy, size):
    return [(cx + size * (0.3 + rng.random()) * math.cos(t), cy + size * (0.3 + rng.random()) * math.sin(t)) for t in (2 * math.pi * k / n for k in range(n))]


def by_cells(cells, e, x, y, box=C.WORLD):
    """What the cover says of a point, and how many edges it looked at."""
    for level, cx, cy, inside, parity, right, low, own in cells:
        n = 1 << level
        if (cx, cy) == (math.floor((x - box[0]) / box[2] * n), math.floor((y - box[1]) / box[3] * n)):
            if inside:
                return 1, 0
            crossed = C._crossed(e[own], np.full(len(own), x), np.full(len(own), y), np.full(len(own), right), np.full(len(own), low)).sum()
            return (parity + crossed) % 2, len(own)
    return 0, 0


@pytest.mark.parametrize("shape", ["star", "lattice", "comb", "crossing", "level"])
def test_cells_tell_what_all_edges_tell(shape):
    """Random places, vertices, middles of edges and places on level and slanting edges; rings that cross themselves too."""
    rng = random.Random(shape)
    if shape == "star":
        pts = star(rng, 300, -93.0, 45.0, 2.0)
    elif shape == "lattice":
        pts = [(-93 + x / 10, 45 + y / 10) for x, y in ((0, 0), (40, 0), (40, 10), (20, 10), (30, 20), (40, 30), (0, 30), (10, 20), (0, 10))]
    elif shape == "comb":
        pts = [p for k in range(60) for p in ((k / 30, 0.0 if k % 2 else 3.0), ((k + 1) / 30, 0.0 if k % 2 else 3.0))] + [(2.0, -1.0), (0.0, -1.0)]
    elif shape == "crossing":
        pts = [(rng.uniform(-3, 3), rng.uniform(-3, 3)) for _ in range(60)]
    else:
        pts = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (3.0, 1.0), (3.0, 0.5), (1.0, 0.5), (1.0, 1.0), (0.0, 1.0)]
    e = np.array(ring(pts))
    cells = list(C.ring_cells(e))
    places = [*pts, *(((a + c) / 2, (b + d) / 2) for a, b, c, d in e)]
    w, s, r, t = e[:, 0].min(), e[:, 1].min(), e[:, 0].max(), e[:, 1].max()
    places += [(rng.uniform(w - 0.1, r + 0.1), rng.uniform(s - 0.1, t + 0.1)) for _ in range(1500)] + [(round(rng.uniform(w, r), 1), round(rng.uniform(s, t), 1)) for _ in range(500)]
    for x, y in places:
        assert by_cells(cells, e, x, y)[0] == odd(e, x, y), (x, y)
    looked = [by_cells(cells, e, x, y)[1] for x, y in places[-2000:]]
    assert np.mean(looked) <= C.EDGES and max(looked) <= 3 * C.EDGES


def test_edges_tested_do_not_grow_with_the_ring():
    """A ring of 20,000 vertices costs a point no more than one of 200."""
    rng, seen = random.Random(4), []
    for n in (200, 20_000):
        e = np.array(ring([(2 * math.cos(t) * (1 + 0.1 * math.sin(40 * t)), math.sin(t)) for t in (2 * math.pi * k / n for k in range(n))]))
        cells = list(C.ring_cells(e))
        index = {(c[0], c[1], c[2]): len(c[7]) for c in cells}
        levels = {c[0] for c in cells}
        at = lambda x, y, k: (k, math.floor((x - C.WORLD[0]) / C.WORLD[2] * (1 << k)), math.floor((y - C.WORLD[1]) / C.WORLD[3] * (1 << k)))
        places = [(rng.uniform(-2.3, 2.3), rng.uniform(-1, 1)) for _ in range(4000)]
        seen.append(np.mean([sum(index.get(at(x, y, k), 0) for k in levels) for x, y in places]))
        assert max(len(c[7]) for c in cells) <= C.EDGES
    assert seen[1] < seen[0] and seen[1] < 1


def test_polygons_with_holes_and_a_hot_place(spark):
    """Overlapping polygons with holes against a loop over all edges; a third of the points stand at one place; the plan has equi-joins only."""
    rng = random.Random(8)
    polygons = []
    for p in range(40):
        x, y = rng.uniform(-95, -93), rng.uniform(44, 46)
        polygons.append((p, 100 - p, ring(star(rng, rng.choice([3, 30, 200]), x, y, 0.4)), ring(star(rng, 8, x, y, 0.05))))
    rows = [(p, o, k, k == 1, *e) for p, o, outer, hole in polygons for k, r in enumerate((outer, hole)) for e in r]
    points = [(i, rng.uniform(-95.5, -92.5), rng.uniform(43.5, 46.5)) for i in range(1500)] + [(1500 + i, -94.0, 45.0) for i in range(700)] + [(9000, None, 1.0), (9001, 400.0, 1.0)]
    found = S.points_in_polygons(spark.createDataFrame(points, "id int, lon double, lat double"), spark.createDataFrame(rows, EDGE))
    got = {r.id: r.poly_id for r in found.collect()}
    want = {}
    for i, x, y in points[:-2]:
        hits = [(o, p) for p, o, outer, hole in polygons if odd(outer, x, y) and not odd(hole, x, y)]
        if hits:
            want[i] = min(hits)[1]
    assert got == want and len(want) > 300
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_no_polygons_and_rings_out_of_the_world(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0)], "id int, lon double, lat double")
    assert S.points_in_polygons(points, spark.createDataFrame([], EDGE)).collect() == []
    with pytest.raises(ValueError, match="beyond"):
        list(C.ring_cells(np.array(ring([(0.0, 0.0), (900.0, 0.0), (0.0, 9.0)]))))
    wide = (-1000.1, -1000.3, 2000.7, 2000.9)
    edge = spark.createDataFrame([(0, 0, 0, False, *e) for e in ring([(0.0, 0.0), (900.0, 0.0), (0.0, 900.0)])], EDGE)
    assert [r.id for r in S.points_in_polygons(points.union(spark.createDataFrame([(2, 100.0, 700.0), (3, 500.0, 500.0)])), edge, box=wide).orderBy("id").collect()] == [1, 2] and F is not None
