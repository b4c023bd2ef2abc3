"""Covers of polygons by cells of a quadtree: most points learn from one look-up whether they lie in a ring, the others test a few edges.

A ring's cover has cells that lie wholly inside, and cells that its edges touch, each with those edges and with the parity of its lower right corner. Other
cells have no row. A point of the second kind goes level to the right border of its cell and then down the border to the corner: the edges crossed on the way change the
corner's parity. Whether it is over or right of an edge is asked with the expression of a plain test of all edges, so points on edges come out the same.
Cells are split until few edges are left, so the edges that a point tests do not grow with the number or size of polygons.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.operators.lineage import cut

#: West, south, width and height of the tree's root for longitudes and latitudes. Borders of cells fall on no round number, so hardly on a place of any data.
WORLD = (-180.0 - math.pi / 7, -90.0 - math.e / 5, 360.0 + math.pi, 180.0 + math.e)
#: Edges in a cell from which it is split, and the deepest level: cells of some 20 m.
EDGES, DEPTH = 12, 21
_CELL = "level int, cx long, cy long, inside boolean, parity int, right double, low double, edges array<struct<xi:double,yi:double,xj:double,yj:double>>"


def _touching(e: np.ndarray, west: np.ndarray, south: np.ndarray, east: np.ndarray, north: np.ndarray) -> np.ndarray:
    """Whether edges meet boxes, a little wider than they are: boxes overlap, and the box's corners are not all on one side of the line."""
    pad_x, pad_y = (east - west) * 1e-9, (north - south) * 1e-9
    west, east, south, north = west - pad_x, east + pad_x, south - pad_y, north + pad_y
    xi, yi, xj, yj = e.T
    over = (np.minimum(xi, xj) <= east) & (np.maximum(xi, xj) >= west) & (np.minimum(yi, yj) <= north) & (np.maximum(yi, yj) >= south)
    dx, dy = xj - xi, yj - yi
    sides = np.stack([dx * (y - yi) - dy * (x - xi) for x in (west, east) for y in (south, north)])
    return over & (sides.min(0) <= 0) & (sides.max(0) >= 0)


def _crossed(e: np.ndarray, x: np.ndarray, y: np.ndarray, right: np.ndarray, low: np.ndarray) -> np.ndarray:
    """How many times (0 to 2) the way from (x, y) level to the border ``right`` and down it to ``low`` crosses edges."""
    xi, yi, xj, yj = e.T
    with np.errstate(divide="ignore", invalid="ignore"):
        at = (xj - xi) * (y - yi) / (yj - yi) + xi
        level = ((yi > y) != (yj > y)) & (x < at) & (at <= right)
        height = (yj - yi) * (right - xi) / (xj - xi) + yi
        down = ((xi > right) != (xj > right)) & (height > low) & (height <= y)
    return level.astype(np.int64) + down


def ring_cells(e: np.ndarray, box: tuple[float, float, float, float] = WORLD, most: int = EDGES, depth: int = DEPTH) -> Iterator[tuple]:
    """Cells of one closed ring, whose edges are rows xi, yi, xj, yj: level, cx, cy, inside, parity, right, low, numbers of edges. All cells of a level at once."""
    x0, y0, wide, high = box

    def borders(level: int, cx: np.ndarray, cy: np.ndarray) -> tuple[np.ndarray, ...]:
        n = 1 << level
        return x0 + wide * cx / n, y0 + high * cy / n, x0 + wide * (cx + 1) / n, y0 + high * (cy + 1) / n

    level, cx, cy = 0, np.zeros(1, np.int64), np.zeros(1, np.int64)
    low, top = np.minimum(e[:, :2], e[:, 2:]).min(0), np.maximum(e[:, :2], e[:, 2:]).max(0)
    if not (low[0] > x0 and low[1] > y0 and top[0] < x0 + wide and top[1] < y0 + high):
        raise ValueError(f"a ring reaches beyond the box {box}")
    while level < depth:  # down to the smallest cell that holds the ring: outside it there is nothing, so its corner is even
        n = 1 << (level + 1)
        a, b = math.floor((low[0] - x0) / wide * n), math.floor((low[1] - y0) / high * n)
        w, s, r, t = borders(level + 1, np.array([a]), np.array([b]))
        if not (low[0] > w[0] and low[1] > s[0] and top[0] < r[0] and top[1] < t[0]):
            break
        level, cx, cy = level + 1, np.array([a]), np.array([b])
    parity, cell, edge = np.zeros(1, np.int64), np.zeros(len(e), np.int64), np.arange(len(e))
    while len(cx):
        w, s, r, t = borders(level, cx, cy)
        count = np.bincount(cell, minlength=len(cx))
        split = (count > most) & (level < depth)
        starts = np.cumsum(count) - count
        order = np.argsort(cell, kind="stable")
        for k in np.flatnonzero(~split & ((count > 0) | (parity == 1))):
            yield level, int(cx[k]), int(cy[k]), bool(count[k] == 0), int(parity[k]), float(r[k]), float(s[k]), edge[order[starts[k] : starts[k] + count[k]]]
        going = split[cell]
        number = np.cumsum(split) - 1
        old, cell, edge = np.flatnonzero(split), number[cell[going]], edge[going]
        parent, own = old[cell], e[edge]
        found = []
        level += 1
        for i, j in ((0, 0), (1, 0), (0, 1), (1, 1)):
            kx, ky = 2 * cx[old] + i, 2 * cy[old] + j
            kw, ks, kr, kt = borders(level, kx, ky)
            crossed = np.bincount(cell, weights=_crossed(own, kr[cell], ks[cell], r[parent], s[parent]), minlength=len(old)).astype(np.int64) if len(old) else np.zeros(0, np.int64)
            here = _touching(own, kw[cell], ks[cell], kr[cell], kt[cell])
            found.append((kx, ky, (parity[old] + crossed) % 2, cell[here], edge[here]))
        shift = np.arange(4) * len(old)
        cx, cy, parity = (np.concatenate([f[k] for f in found]) for k in range(3))
        cell, edge = np.concatenate([f[3] + n for f, n in zip(found, shift, strict=True)]), np.concatenate([f[4] for f in found])


def cover(edge: DataFrame, order: str = "poly_ord", box: tuple[float, float, float, float] = WORLD, most: int = EDGES, depth: int = DEPTH) -> DataFrame:
    """poly_id, order, hole and the cells of every ring of edge (poly_id, order, ring_id, hole, xi, yi, xj, yj). A ring is one geometry's part, so it is one task's."""
    kinds = {f.name: f.dataType.simpleString() for f in edge.schema}
    schema = f"poly_id {kinds['poly_id']}, {order} {kinds[order]}, hole boolean, {_CELL}"
    struct = pa.struct([(c, pa.float64()) for c in ("xi", "yi", "xj", "yj")])

    def run(t: pa.Table) -> pa.Table:
        e = np.stack([t.column(c).to_numpy() for c in ("xi", "yi", "xj", "yj")], 1)
        cells = list(ring_cells(e, box, most, depth))
        take = np.concatenate([np.zeros(0, np.int64), *(c[7] for c in cells)])
        ends = np.concatenate([[0], np.cumsum([len(c[7]) for c in cells])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(e[take, k]) for k in range(4)], names=["xi", "yi", "xj", "yj"]))
        own = lambda c: pa.array([t.column(c)[0].as_py()] * len(cells), t.schema.field(c).type)
        kinds = (pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.float64(), pa.float64())
        columns = [own("poly_id"), own(order), own("hole"), *(pa.array([c[k] for c in cells], kind) for k, kind in enumerate(kinds)), lists.cast(pa.list_(struct))]
        return pa.table(columns, names=[c.strip().split()[0] for c in schema.split(", ")])

    rows = edge.select("poly_id", order, "ring_id", "hole", *(F.col(c).cast("double").alias(c) for c in ("xi", "yi", "xj", "yj")))
    return cut(rows.groupBy("poly_id", order, "ring_id", "hole").applyInArrow(run, schema), "cover")


def points_in_cover(points: DataFrame, cells: DataFrame, key: str = "id", order: str = "poly_ord", box: tuple[float, float, float, float] = WORLD) -> DataFrame:
    """Key, poly_id of the first polygon (by ``order``) that a point (key, lon, lat) lies in: in an outer ring of it and in none of its holes; others have no row.

    A point meets cells by equality, once for each level that the cover has (DEPTH + 1 at most); points outside the root lie nowhere.
    """
    x0, y0, wide, high = box
    levels = sorted(r.level for r in cells.select("level").distinct().collect())
    p = points.select(F.col(key).alias("_id"), F.col("lon").alias("_x"), F.col("lat").alias("_y")).where((F.col("_x") > x0) & (F.col("_x") < x0 + wide) & (F.col("_y") > y0) & (F.col("_y") < y0 + high))
    p = p.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
    n = F.pow(F.lit(2.0), F.col("level"))
    p = p.withColumns({"cx": F.floor((F.col("_x") - x0) / wide * n), "cy": F.floor((F.col("_y") - y0) / high * n)})
    x, y = F.col("_x"), F.col("_y")
    level = lambda e: ((e.yi > y) != (e.yj > y)) & (x < (e.xj - e.xi) * (y - e.yi) / F.nullif(e.yj - e.yi, F.lit(0.0)) + e.xi) & ((e.xj - e.xi) * (y - e.yi) / F.nullif(e.yj - e.yi, F.lit(0.0)) + e.xi <= F.col("right"))
    height = lambda e: (e.yj - e.yi) * (F.col("right") - e.xi) / F.nullif(e.xj - e.xi, F.lit(0.0)) + e.yi
    down = lambda e: ((e.xi > F.col("right")) != (e.xj > F.col("right"))) & (height(e) > F.col("low")) & (height(e) <= y)
    odd = F.col("inside") | ((F.col("parity") + F.size(F.filter("edges", lambda e: F.coalesce(level(e), F.lit(False)))) + F.size(F.filter("edges", lambda e: F.coalesce(down(e), F.lit(False))))) % 2 == 1)
    found = p.join(cells, ["level", "cx", "cy"]).where(odd)
    inside = found.groupBy("_id", "poly_id", order).agg(F.bool_or(~F.col("hole")).alias("outer"), F.bool_or("hole").alias("holed")).where("outer AND NOT holed")
    return inside.groupBy("_id").agg(F.min_by("poly_id", order).alias("poly_id")).withColumnRenamed("_id", key)
