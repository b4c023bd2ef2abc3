"""Queries over features whose places come from integer keys, the same in both engines (spatial operators)."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.operators import spatial as S
from terrasift.plans.registry import query, table

LON, LAT = "-97.0D + (({k} * 7919) % 80000) / 10000.0D", "43.0D + (({k} * 6271) % 60000) / 10000.0D"
SQL_LON, SQL_LAT = "(-97.0::DOUBLE + (({k} * 7919) % 80000) / 10000.0::DOUBLE)", "(43.0::DOUBLE + (({k} * 6271) % 60000) / 10000.0::DOUBLE)"


def places(spark: SparkSession, sf_dir: str, name: str, key: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.col(key).alias("id"), F.expr(LON.format(k=key)).alias("lon"), F.expr(LAT.format(k=key)).alias("lat"), *more)


def _sql_places(name: str, key: str, *more: str) -> str:
    return f"SELECT {key} AS id, {SQL_LON.format(k=key)} AS lon, {SQL_LAT.format(k=key)} AS lat{''.join(', ' + m for m in more)} FROM {name}"


@query("bbox_clip", f"WITH p AS ({_sql_places('customer', 'c_custkey')}) SELECT id, CAST(round(lon * 10000) AS BIGINT) AS lon4, CAST(round(lat * 10000) AS BIGINT) AS lat4 FROM p WHERE lon BETWEEN -96.0 AND -92.0 AND lat BETWEEN 44.0 AND 47.5")
def bbox_clip(spark, sf_dir):
    p = places(spark, sf_dir, "customer", "c_custkey").where(G.in_box(F.col("lon"), F.col("lat"), (-96.0, 44.0, -92.0, 47.5)))
    return p.select("id", F.round(F.col("lon") * 10000).cast("long").alias("lon4"), F.round(F.col("lat") * 10000).cast("long").alias("lat4"))


@query(
    "tile_grid_counts",
    f"""WITH p AS ({_sql_places("customer", "c_custkey")})
    SELECT CAST(least(floor((lat - 43.0) / 0.75), 7) * 11 + least(floor((lon + 97.0) / 0.75), 10) AS BIGINT) AS tile, count(*) AS n
    FROM p WHERE lon BETWEEN -97.0 AND -89.0 AND lat BETWEEN 43.0 AND 49.0 GROUP BY 1""",
)
def tile_grid_counts(spark, sf_dir):
    p = places(spark, sf_dir, "customer", "c_custkey")
    tile = S.tile_of(F.col("lon"), F.col("lat"), (-97.0, 43.0, -89.0, 49.0), 0.75)
    return p.withColumn("tile", tile).where("tile IS NOT NULL").groupBy(F.col("tile").cast("long").alias("tile")).agg(F.count("*").alias("n"))


@query(
    "proximity_candidates",
    f"""WITH a AS ({_sql_places("customer", "c_custkey")}), b AS ({_sql_places("supplier", "(s_suppkey + 17)")}),
    d AS (SELECT a.id AS a_id, b.id AS b_id,
                 6371000.0::DOUBLE * sqrt(pow(radians(b.lon - a.lon) * cos(radians((a.lat + b.lat) / 2)), 2) + pow(radians(b.lat - a.lat), 2)) AS d
          FROM a JOIN b ON abs(floor(a.lon / 0.02) - floor(b.lon / 0.02)) <= 1 AND abs(floor(a.lat / 0.02) - floor(b.lat / 0.02)) <= 1)
    SELECT a_id, b_id, CAST(round(d) AS BIGINT) AS metres FROM d WHERE d < 1501""",
)
def proximity_candidates(spark, sf_dir):
    b = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") + 17).alias("k")).select(F.col("k").alias("id"), F.expr(LON.format(k="k")).alias("lon"), F.expr(LAT.format(k="k")).alias("lat"))
    return S.near_pairs(places(spark, sf_dir, "customer", "c_custkey"), b, 1500.0).select("a_id", "b_id", F.round("d").cast("long").alias("metres"))


@query("greedy_match")
def greedy_match(spark, sf_dir):
    b = table(spark, sf_dir, "part").select((F.col("p_partkey") + 17).alias("k")).select(F.col("k").alias("id"), F.expr(LON.format(k="k")).alias("lon"), F.expr(LAT.format(k="k")).alias("lat"))
    return S.greedy_match(S.near_pairs(places(spark, sf_dir, "customer", "c_custkey"), b, 1500.0)).select("a_id", "b_id", F.round("d").cast("long").alias("metres"))


#: Octagons around a point for each nation, each with a square hole; whole numbers of ten-thousandths of a degree.
_RING = [(9000, 0), (6364, 6364), (0, 9000), (-6364, 6364), (-9000, 0), (-6364, -6364), (0, -9000), (6364, -6364)]
_HOLE = [(2000, 2000), (-2000, 2000), (-2000, -2000), (2000, -2000)]


def nation_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("poly_id"), F.expr("-970000 + (n_nationkey * 29327) % 80000").alias("cx"), F.expr("430000 + (n_nationkey * 17431) % 60000").alias("cy"))
    ring = lambda pts: F.array(*(F.struct(((F.col("cx") + x) / 10000.0).alias("x"), ((F.col("cy") + y) / 10000.0).alias("y")) for x, y in pts))
    rings = n.select("poly_id", F.explode(F.array(F.struct(F.lit(0).alias("ring_id"), F.lit(False).alias("hole"), ring(_RING).alias("points")), F.struct(F.lit(1).alias("ring_id"), F.lit(True).alias("hole"), ring(_HOLE).alias("points")))).alias("r")).select("poly_id", "r.*")
    e = G.edges(rings)
    return e.withColumn("hole", F.col("ring_id") == 1).withColumn("poly_ord", F.col("poly_id"))


def _sql_edges() -> str:
    rows = []
    for ring, pts in ((0, _RING), (1, _HOLE)):
        rows += [f"({ring}, {a[0]}, {a[1]}, {b[0]}, {b[1]})" for a, b in zip(pts, pts[1:] + pts[:1], strict=True)]
    return f"""SELECT n_nationkey AS poly_id, ring_id, (cx + ax) / 10000.0::DOUBLE AS xi, (cy + ay) / 10000.0::DOUBLE AS yi, (cx + nx) / 10000.0::DOUBLE AS xj, (cy + ny) / 10000.0::DOUBLE AS yj
        FROM (SELECT n_nationkey, -970000 + (n_nationkey * 29327) % 80000 AS cx, 430000 + (n_nationkey * 17431) % 60000 AS cy FROM nation),
             (VALUES {", ".join(rows)}) AS v(ring_id, ax, ay, nx, ny)"""


@query(
    "pip_region_assign",
    f"""WITH p AS ({_sql_places("customer", "c_custkey")}), e AS ({_sql_edges()}),
    r AS (SELECT id, poly_id, ring_id FROM p JOIN e ON (yi > lat) <> (yj > lat) AND lon < (xj - xi) * (lat - yi) / (yj - yi) + xi
          GROUP BY ALL HAVING count(*) % 2 = 1),
    i AS (SELECT id, poly_id FROM r GROUP BY ALL HAVING count(*) FILTER (ring_id = 0) = 1 AND count(*) FILTER (ring_id = 1) = 0)
    SELECT id, CAST(min(poly_id) AS BIGINT) AS poly_id FROM i GROUP BY id""",
)
def pip_region_assign(spark, sf_dir):
    return S.points_in_polygons(places(spark, sf_dir, "customer", "c_custkey"), nation_edges(spark, sf_dir))


def _segments(spark, sf_dir, name, key, dx, dy):
    p = places(spark, sf_dir, name, key)
    return p.select("id", F.col("lon").alias("x1"), F.col("lat").alias("y1"), (F.col("lon") + dx).alias("x2"), (F.col("lat") + dy).alias("y2"))


@query(
    "edge_cross",
    f"""WITH a AS ({_sql_places("supplier", "s_suppkey")}), b AS ({_sql_places("customer", "c_custkey")}),
    s AS (SELECT a.id AS a_id, b.id AS b_id, a.lon AS ax, a.lat AS ay, a.lon + 0.25 AS bx, a.lat + 0.125 AS by_, b.lon AS cx, b.lat AS cy, b.lon + 0.125 AS dx, b.lat - 0.25 AS dy FROM a, b
          WHERE a.lon <= b.lon + 0.125 AND b.lon <= a.lon + 0.25 AND a.lat <= b.lat AND b.lat - 0.25 <= a.lat + 0.125)
    SELECT a_id, b_id FROM s
    WHERE ((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax)) * ((bx - ax) * (dy - ay) - (by_ - ay) * (dx - ax)) <= 0
      AND ((dx - cx) * (ay - cy) - (dy - cy) * (ax - cx)) * ((dx - cx) * (by_ - cy) - (dy - cy) * (bx - cx)) <= 0""",
)
def edge_cross(spark, sf_dir):
    return S.crossing_segments(_segments(spark, sf_dir, "supplier", "s_suppkey", 0.25, 0.125), _segments(spark, sf_dir, "customer", "c_custkey", 0.125, -0.25), 0.25)


@query(
    "theta_overlap_join",
    f"""WITH a AS ({_sql_places("supplier", "s_suppkey")}), b AS ({_sql_places("nation", "n_nationkey")})
    SELECT a.id AS a_id, CAST(b.id AS BIGINT) AS b_id FROM a JOIN b ON a.lon <= b.lon + 1.5 AND a.lon + 0.5 >= b.lon AND a.lat <= b.lat + 1.5 AND a.lat + 0.5 >= b.lat""",
)
def theta_overlap_join(spark, sf_dir):
    def boxes(name, key, side):
        return places(spark, sf_dir, name, key).select(F.col("id").cast("long").alias("id"), F.col("lon").alias("xmin"), F.col("lat").alias("ymin"), (F.col("lon") + side).alias("xmax"), (F.col("lat") + side).alias("ymax"))

    from terrasift.operators.joins import overlapping_boxes

    return overlapping_boxes(boxes("supplier", "s_suppkey", 0.5), boxes("nation", "n_nationkey", 1.5), 0.5)


@query(
    "compare_delta",
    """WITH j AS (SELECT c_custkey AS id, c_acctbal AS a, s_acctbal AS b FROM customer JOIN supplier ON s_suppkey = c_custkey),
    p AS (SELECT *, CASE WHEN a <> 0 AND b <> 0 THEN abs(a - b) / greatest(abs(a), abs(b)) * 100 END AS pct FROM j)
    SELECT id, a <> 0 AND b <> 0 AS compared, coalesce(pct > 5, false) AS differs, CASE WHEN pct > 5 THEN CAST(round(pct) AS BIGINT) END AS pct FROM p""",
)
def compare_delta(spark, sf_dir):
    c, s = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    j = c.join(s, c["c_custkey"] == s["s_suppkey"])
    pct = S.compare_numbers(F.col("c_acctbal"), F.col("s_acctbal"))
    return j.select(F.col("c_custkey").alias("id"), ((F.col("c_acctbal") != 0) & (F.col("s_acctbal") != 0)).alias("compared"), pct.isNotNull().alias("differs"), F.round(pct).cast("long").alias("pct"))


def ring_edges(spark: SparkSession, vertices: int) -> DataFrame:
    """A wavy ring of many vertices around the area's middle."""
    i = spark.range(vertices).select("id", (F.col("id") * (2 * 3.141592653589793 / vertices)).alias("t"), ((F.col("id") + 1) % vertices * (2 * 3.141592653589793 / vertices)).alias("u"))
    at = lambda t: (F.lit(-93.0) + (2.5 + 0.5 * F.sin(F.col(t) * 40)) * F.cos(t), F.lit(46.0) + (2.0 + 0.4 * F.sin(F.col(t) * 40)) * F.sin(t))
    (xi, yi), (xj, yj) = at("t"), at("u")
    return i.select(F.lit(0).alias("poly_id"), F.lit(0).alias("poly_ord"), F.lit(0).alias("ring_id"), F.lit(False).alias("hole"), xi.alias("xi"), yi.alias("yi"), xj.alias("xj"), yj.alias("yj"))


def line_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("k")).distinct()


def clip_ring(keys: DataFrame, vertices: int) -> DataFrame:
    """the points of keys k that lie in a ring of so many vertices."""
    p = keys.select(F.col("k").alias("id"), F.expr(LON.format(k="k")).alias("lon"), F.expr(LAT.format(k="k")).alias("lat"))
    box = G.in_box(F.col("lon"), F.col("lat"), (-96.0, 43.6, -90.0, 48.4))
    return S.points_in_polygons(p.where(box), ring_edges(keys.sparkSession, vertices))


@query(
    "clip_ring_10k",
    """WITH k AS (SELECT DISTINCT l_orderkey * 7 + l_linenumber AS id FROM lineitem),
    p AS (SELECT id, -97.0::DOUBLE + (id * 7919) % 80000 / 10000.0::DOUBLE AS lon, 43.0::DOUBLE + (id * 6271) % 60000 / 10000.0::DOUBLE AS lat FROM k),
    t AS (SELECT i, i * (2 * 3.141592653589793::DOUBLE / 10000) AS t FROM range(10000) r(i)),
    v AS (SELECT i, -93.0::DOUBLE + (2.5::DOUBLE + 0.5::DOUBLE * sin(t * 40)) * cos(t) AS x, 46.0::DOUBLE + (2.0::DOUBLE + 0.4::DOUBLE * sin(t * 40)) * sin(t) AS y FROM t),
    e AS (SELECT a.x AS xi, a.y AS yi, b.x AS xj, b.y AS yj, least(a.y, b.y) AS low, greatest(a.y, b.y) AS high FROM v a JOIN v b ON b.i = (a.i + 1) % 10000)
    SELECT id, CAST(0 AS INT) AS poly_id FROM p JOIN e ON low <= lat AND lat < high WHERE lon < (xj - xi) * (lat - yi) / (yj - yi) + xi GROUP BY id HAVING count(*) % 2 = 1""",
)
def clip_ring_10k(spark, sf_dir):
    """F10 on a point for each row of lineitem and a ring of 10,000 vertices."""
    return clip_ring(line_keys(spark, sf_dir), 10_000)


def clip_ring_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The case whose cost is published, for bench.py: 100,000 points and the same ring."""
    return clip_ring(line_keys(spark, sf_dir).orderBy("k").limit(100_000), 10_000)
