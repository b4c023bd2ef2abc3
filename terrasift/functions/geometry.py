"""Geometry as Column expressions. Longitude first; R is the sphere's radius in metres."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

R = 6_371_000.0


def local_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres on a plane that is true at the mean latitude."""
    x = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return R * F.sqrt(x * x + F.pow(F.radians(lat2 - lat1), 2))


def in_box(lon: Column, lat: Column, box: tuple[float, float, float, float]) -> Column:
    """F11 for points: closed on all sides."""
    return lon.between(box[0], box[2]) & lat.between(box[1], box[3])


def boxes_overlap(a: tuple[Column, ...], b: tuple[Column, ...]) -> Column:
    """closed intervals (xmin, ymin, xmax, ymax)."""
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def points_box(points: Column) -> Column:
    """Struct of the extremes of an array of struct(x, y); null for none."""
    x, y = F.transform(points, lambda p: p.x), F.transform(points, lambda p: p.y)
    return F.when(F.size(points) > 0, F.struct(F.array_min(x).alias("xmin"), F.array_min(y).alias("ymin"), F.array_max(x).alias("xmax"), F.array_max(y).alias("ymax")))


def mean_point(points: Column) -> Column:
    """The mean of the vertices, a closing one counted again."""
    add = F.aggregate(points, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), lambda a, p: F.struct((a.x + p.x).alias("x"), (a.y + p.y).alias("y")))
    n = F.size(points)
    return F.when(n > 0, F.struct((add.x / n).alias("x"), (add.y / n).alias("y")))


def clean_points(points: Column) -> Column:
    """Points with two finite coordinates."""
    return F.filter(points, lambda p: p.x.isNotNull() & p.y.isNotNull() & ~F.isnan(p.x) & ~F.isnan(p.y) & (F.abs(p.x) < float("inf")) & (F.abs(p.y) < float("inf")))


def signed_area(ring: Column) -> Column:
    """Shoelace sum; negative is clockwise, an outer ring in the ring order of Esri."""
    nxt = F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0)))
    return F.aggregate(F.zip_with(F.slice(ring, 1, F.greatest(F.size(ring) - 1, F.lit(0))), nxt, lambda a, b: a.x * b.y - b.x * a.y), F.lit(0.0), lambda s, v: s + v) / 2


def edges(polygons: DataFrame, poly: str = "poly_id", ring: str = "ring_id", points: str = "points") -> DataFrame:
    """Edge table of closed rings: poly, ring, xi, yi, xj, yj."""
    at = polygons.select(poly, ring, F.posexplode(points).alias("i", "a"), F.col(points).alias("p"))
    b = F.get("p", F.pmod(F.col("i") + 1, F.size("p")))
    return at.select(poly, ring, F.col("a.x").alias("xi"), F.col("a.y").alias("yi"), b.x.alias("xj"), b.y.alias("yj"))


def orient(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def segments_intersect(p: tuple[Column, ...], q: tuple[Column, ...]) -> Column:
    """two segments (x1, y1, x2, y2) cross or touch, collinear touch included."""
    (ax, ay, bx, by), (cx, cy, dx, dy) = p, q
    o1, o2 = orient(ax, ay, bx, by, cx, cy), orient(ax, ay, bx, by, dx, dy)
    o3, o4 = orient(cx, cy, dx, dy, ax, ay), orient(cx, cy, dx, dy, bx, by)
    box = (F.least(ax, bx) <= F.greatest(cx, dx)) & (F.least(cx, dx) <= F.greatest(ax, bx)) & (F.least(ay, by) <= F.greatest(cy, dy)) & (F.least(cy, dy) <= F.greatest(ay, by))
    return box & (o1 * o2 <= 0) & (o3 * o4 <= 0)
