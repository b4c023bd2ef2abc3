"""Queries over whole builds: sources made from the tables, fetched, merged, clipped, counted and cross-matched."""

from pyspark.sql import functions as F

from terrasift import reconcile as R
from terrasift.catalog import Catalog, parse_aoi
from terrasift.functions.geometry import in_box
from terrasift.plans.geo import LAT, LON, SQL_LAT, SQL_LON
from terrasift.plans.registry import query, table

BOX = (-95.5, 43.5, -90.5, 48.0)
STATES = {"MN": ("27", (-97.5, 43.0, -89.0, 49.5))}
#: Two layers of one entity, one of lines, and a source that is gone.
SOURCES = [
    {"id": "shops", "layer": "shops", "entity": "place", "table": "customer", "key": "c_custkey", "half": 3},
    {"id": "depots", "layer": "depots", "entity": "place", "table": "supplier", "key": "s_suppkey", "half": 1},
    {"id": "roads", "layer": "roads", "entity": "place", "table": "nation", "key": "n_nationkey", "half": 1},
    {"id": "gone", "layer": "gone", "entity": "place", "table": "none", "key": "k", "half": 1},
]


def features(spark, sf_dir, spec):
    """Each row of a table twice, the second time under the id that it shares with the ``half`` - 1 rows after it."""
    if spec["table"] == "none":
        raise FileNotFoundError(spec["id"])
    k = F.col(spec["key"]).cast("long")
    both = table(spark, sf_dir, spec["table"]).select(F.explode(F.array(F.struct(k.alias("k"), (k * 2).alias("ord")), F.struct((k - k % spec["half"]).alias("k"), (k * 2 + 1).alias("ord")))).alias("x")).select("x.*")
    at = both.withColumn("lon", F.expr(LON.format(k="k"))).withColumn("lat", F.expr(LAT.format(k="k")))
    line = spec["layer"] == "roads"
    where = F.to_json(F.array(F.array("lon", "lat"), F.array(F.col("lon") + 0.01, F.col("lat")))) if line else F.to_json(F.array("lon", "lat"))
    return at.select(
        "ord", F.col("k").alias("id"), F.col("k").cast("string").alias("source_id"), F.concat(F.lit(f"{spec['id']} "), "k").alias("name"), F.lit("LineString" if line else "Point").alias("geom_type"), where.alias("coordinates"),
        F.create_map(F.lit("class"), F.concat(F.lit("c"), F.col("k") % 3)).alias("properties"), "lon", "lat", F.lit(None).cast("string").alias("shape"), (F.col("k") % 50).cast("double").alias("beds"),
    )


def built(spark, sf_dir):
    catalog = Catalog.load([("state", "us", {"defaults": {"driver": "table", "license": "PD"}, "sources": SOURCES})])
    return R.build(catalog, parse_aoi("MN", STATES), lambda s: features(spark, sf_dir, s), lambda df: df.where(in_box(F.col("lon"), F.col("lat"), BOX)))


_ROWS = " UNION ALL ".join(f"""SELECT '{s["layer"]}' AS layer, k, {SQL_LON.format(k="k")} AS lon, {SQL_LAT.format(k="k")} AS lat FROM (SELECT {s["key"]} AS k FROM {s["table"]} UNION ALL SELECT {s["key"]} - {s["key"]} % {s["half"]} FROM {s["table"]})""" for s in SOURCES[:3])


@query(
    "build_counts",
    f"""WITH r AS ({_ROWS}), d AS (SELECT DISTINCT layer, k, lon, lat FROM r), i AS (SELECT * FROM d WHERE lon BETWEEN {BOX[0]} AND {BOX[2]} AND lat BETWEEN {BOX[1]} AND {BOX[3]}),
    c AS (SELECT layer, count(*) AS n FROM r GROUP BY 1), m AS (SELECT layer, count(*) AS n FROM d GROUP BY 1), o AS (SELECT layer, count(*) AS n FROM i GROUP BY 1)
    SELECT layer, c.n AS rows_in, c.n - m.n AS merged, m.n - coalesce(o.n, 0) AS outside, coalesce(o.n, 0) AS features, false AS failed FROM c JOIN m USING (layer) LEFT JOIN o USING (layer) UNION ALL SELECT 'gone', NULL, NULL, NULL, NULL, true""",
)
def build_counts(spark, sf_dir):
    """What a build over three tables counts, and a source that fails."""
    _, rows = built(spark, sf_dir)
    return R.as_table(spark, rows).select("layer", "rows_in", "merged", "outside", "features", F.col("error").isNotNull().alias("failed"))


@query("build_matches")
def build_matches(spark, sf_dir):
    """Which pairs of a build's layers are cross-matched (not those with lines), and what is found."""
    layers, rows = built(spark, sf_dir)
    found = [f.withColumn("pair", F.lit(f"{a['layer']}/{b['layer']}")) for a, b, f in R.cross_match(SOURCES, layers, 1500.0)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.groupBy("pair", "side").agg(F.count("*").alias("n"), F.sum("n_diffs").alias("n_diffs"))
