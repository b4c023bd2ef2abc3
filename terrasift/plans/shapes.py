"""Queries over shapes, elements, documents of packs and their inventories, on tables derived from the driver's."""

from pyspark.sql import functions as F

from terrasift.functions import geometry as G
from terrasift.functions import labels as L
from terrasift.functions import scalar as X
from terrasift.operators import inventory as I
from terrasift.operators import joins as J
from terrasift.operators import spatial as S
from terrasift.plans.registry import query, table
from terrasift.sinks import packs as W
from terrasift.sources import osm

#: An area with a bay and a hole.
AREA = [(False, [(2.005, 1.005), (7.005, 1.005), (7.005, 5.005), (4.505, 5.005), (4.505, 3.005), (2.005, 3.005)]), (True, [(5.005, 1.505), (6.005, 1.505), (6.005, 2.505), (5.005, 2.505)])]
_EDGES = ", ".join(f"({a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for _, ring in AREA for a, b in zip(ring, [*ring[1:], ring[0]], strict=True))


@query(
    "clip_shapes",
    f"""WITH f AS (SELECT c_custkey k, (c_custkey * 37 % 1000) / 100.0::DOUBLE x, (c_custkey * 53 % 700) / 100.0::DOUBLE y, CASE WHEN c_custkey % 50 = 2 THEN 9 ELSE 1 END s FROM customer),
    v AS (SELECT k, x, y, 0 i FROM f UNION ALL SELECT k, x + 1, y + 0.5, 1 FROM f WHERE k % 3 = 1 UNION ALL SELECT k, x + s, y, 1 FROM f WHERE k % 3 = 2
          UNION ALL SELECT k, x + s, y + s, 2 FROM f WHERE k % 3 = 2 UNION ALL SELECT k, x, y + s, 3 FROM f WHERE k % 3 = 2 UNION ALL SELECT k, x, y, 4 FROM f WHERE k % 3 = 2),
    e(xi, yi, xj, yj) AS (VALUES {_EDGES}),
    c AS (SELECT a.k, a.x ax, a.y ay, b.x bx, b.y b_y, xi, yi, xj, yj FROM v a JOIN v b ON b.k = a.k AND b.i = a.i + 1 CROSS JOIN e),
    touching AS (SELECT k FROM v JOIN e ON (yi > y) <> (yj > y) AND x < (xj - xi) * (y - yi) / (yj - yi) + xi GROUP BY k, i HAVING count(*) % 2 = 1
      UNION SELECT k FROM c WHERE ((bx - ax) * (yi - ay) - (b_y - ay) * (xi - ax)) * ((bx - ax) * (yj - ay) - (b_y - ay) * (xj - ax)) <= 0 AND ((xj - xi) * (ay - yi) - (yj - yi) * (ax - xi)) * ((xj - xi) * (b_y - yi) - (yj - yi) * (bx - xi)) <= 0
        AND least(ax, bx) <= greatest(xi, xj) AND least(xi, xj) <= greatest(ax, bx) AND least(ay, b_y) <= greatest(yi, yj) AND least(yi, yj) <= greatest(ay, b_y)
      UNION SELECT k FROM f WHERE k % 3 = 2 AND x < 2.005 AND 2.005 < x + s AND y < 1.005 AND 1.005 < y + s)
    SELECT k AS id, CASE k % 3 WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' ELSE 'Polygon' END AS geom_type FROM touching""",
)
def clip_shapes(spark, sf_dir):
    """F10 on points, lines and polygons, one of them around the whole area."""
    f = table(spark, sf_dir, "customer").selectExpr("c_custkey AS id", "(c_custkey * 37 % 1000) / 100.0D AS x", "(c_custkey * 53 % 700) / 100.0D AS y", "CASE WHEN c_custkey % 50 = 2 THEN 9 ELSE 1 END AS s")
    made = f.selectExpr(
        "id",
        "CASE id % 3 WHEN 0 THEN 'Point' WHEN 1 THEN 'LineString' ELSE 'Polygon' END AS geom_type",
        "CASE id % 3 WHEN 0 THEN to_json(array(x, y)) WHEN 1 THEN to_json(array(array(x, y), array(x + 1, y + 0.5D))) ELSE to_json(array(array(array(x, y), array(x + s, y), array(x + s, y + s), array(x, y + s), array(x, y)))) END AS coordinates",
    )
    return S.clip_shapes(made, AREA, cell=1.0).select("id", "geom_type")


@query(
    "feature_names",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 7 > 0 THEN c_mktsegment ELSE '' END WHEN c_custkey % 3 = 0 THEN c_name || ' (' || c_custkey % 90 || '.5 MW)'
              WHEN c_custkey % 3 = 1 THEN c_name || CASE WHEN c_custkey % 2 = 0 THEN ' (69 kV)' ELSE ' (34.5 kV)' END ELSE c_name END AS name FROM customer""",
)
def feature_names(spark, sf_dir):
    k = F.col("c_custkey")
    name = L.feature_name(None, F.when(k % 5 == 0, " ").otherwise(F.col("c_name")), F.when(k % 3 == 0, k % 90 + 0.5), F.when(k % 3 == 1, F.when(k % 2 == 0, 69.0).otherwise(34.5)), F.when(k % 7 > 0, F.col("c_mktsegment")))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"))


@query("shape_boxes", "SELECT l_orderkey, min(l_quantity) AS xmin, CAST(min(l_linenumber) AS DOUBLE) AS ymin, max(l_quantity) AS xmax, CAST(max(l_linenumber) AS DOUBLE) AS ymax, avg(l_quantity) AS x, avg(l_linenumber) AS y FROM lineitem GROUP BY 1")
def shape_boxes(spark, sf_dir):
    p = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.struct(F.col("l_quantity").alias("x"), F.col("l_linenumber").cast("double").alias("y"))).alias("p"))
    return p.select("l_orderkey", G.points_box(F.col("p")).alias("b"), G.mean_point(F.col("p")).alias("m")).select("l_orderkey", "b.*", "m.*")


@query("ring_areas", "SELECT p_partkey, CAST(5 AS INT) AS n, CASE WHEN p_partkey % 2 = 0 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END * p_size * p_size AS area FROM part")
def ring_areas(spark, sf_dir):
    """Squares in both directions, some with places that are none."""
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    z, s = F.lit(0), F.col("p_size")
    first, second = F.when(F.col("p_partkey") % 2 == 0, s).otherwise(z), F.when(F.col("p_partkey") % 2 == 0, z).otherwise(s)
    odd = F.when(F.col("p_partkey") % 3 == 0, F.lit(float("nan"))).when(F.col("p_partkey") % 3 == 1, F.lit(float("inf")))
    ring = G.clean_points(F.array(at(z, z), at(first, second), at(odd, z), at(s, s), at(second, first), at(z, z)))
    return table(spark, sf_dir, "part").select("p_partkey", F.size(ring).alias("n"), G.signed_area(ring).alias("area"))


@query(
    "placemark_xml",
    """SELECT p_partkey, '<Placemark><name>' || p_name || ' &lt;' || p_partkey || '&gt;</name><styleUrl>#s' || p_size % 3 || '</styleUrl><ExtendedData><Data name="kind &amp; size"><value>' || p_type || '</value></Data><Data name="n"><value>' || p_size
              || '</value></Data></ExtendedData><Point><coordinates>' || p_partkey % 180 || '.500000,-' || p_partkey % 90 || '.250000,0</coordinates></Point></Placemark>' AS xml FROM part WHERE p_partkey % 4 > 0""",
)
def placemark_xml(spark, sf_dir):
    k = F.col("p_partkey")
    where = F.when(k % 4 > 0, F.concat(F.lit("["), k % 180, F.lit(".5,-"), k % 90, F.lit(".25]")))
    df = table(spark, sf_dir, "part").withColumns({"geom_type": F.lit("Point"), "coordinates": where})
    fields = F.array(*(F.struct(F.lit(n).alias("label"), F.col(c).cast("string").alias("value")) for n, c in (("kind & size", "p_type"), ("n", "p_size"), ("b", "p_brand"))))
    return W.placemarks(df, F.concat("p_name", F.lit(" <"), k, F.lit(">")), fields, F.concat(F.lit("s"), F.col("p_size") % 3), most=2).select("p_partkey", "xml")


@query(
    "layer_documents",
    """WITH f AS (SELECT p_type AS doc, p_brand AS b, count(*) AS n, '<Folder><name>' || p_brand || ' (' || count(*) || ')</name>' || string_agg('<p>' || p_partkey || '</p>', '' ORDER BY p_partkey) || '</Folder>' AS xml FROM part GROUP BY 1, 2)
    SELECT doc, CAST(sum(n) AS BIGINT) AS n, doc = 'ECONOMY' AS hidden, md5('<?xml version="1.0" encoding="UTF-8"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>' || doc || '</name><visibility>' || CASE WHEN doc = 'ECONOMY' THEN '0' ELSE '1' END
           || '</visibility>' || string_agg(xml, '' ORDER BY b) || '</Document></kml>') AS digest FROM f GROUP BY doc""",
)
def layer_documents(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select(F.col("p_type").alias("doc"), F.col("p_brand").alias("bucket"), F.col("p_brand").alias("place"), F.col("p_partkey").alias("ord"), F.concat(F.lit("<p>"), "p_partkey", F.lit("</p>")).alias("xml"))
    return W.documents(W.folders(rows), hidden=F.col("doc") == "ECONOMY").select("doc", "n", "hidden", F.md5("kml").alias("digest"))


@query("licence_groups", "SELECT CASE p_size % 4 WHEN 1 THEN 'ODbL 1.0' WHEN 2 THEN 'PD' ELSE 'unspecified' END AS license, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS layers, p_size % 4 = 1 AS odbl FROM part GROUP BY 1, 3")
def licence_groups(spark, sf_dir):
    licence = F.expr("CASE p_size % 4 WHEN 0 THEN ' ' WHEN 1 THEN 'ODbL 1.0' WHEN 2 THEN 'PD' END")
    return W.attribution(table(spark, sf_dir, "part").select(licence.alias("license"), F.col("p_type").alias("layer"))).select("license", F.array_join("layers", ", ").alias("layers"), "odbl")


@query("geojson_rows", """SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || p_size || ',2]},"properties":{"id":' || p_partkey || ',"name":"' || p_name || '"}}' AS value FROM part WHERE p_partkey % 4 = 0""")
def geojson_rows(spark, sf_dir):
    where = F.expr("CASE p_partkey % 4 WHEN 0 THEN concat('[', p_size, ',2]') WHEN 1 THEN '[NaN,2]' WHEN 2 THEN '[]' END")
    df = table(spark, sf_dir, "part").withColumns({"geom_type": F.lit("Point"), "coordinates": where})
    return W.geojson_lines(df, F.struct(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


@query(
    "merged_places",
    """WITH r AS (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'a.kmz' ELSE 'b.kmz' END AS path, p_partkey AS ord, p_name AS name, p_size % 5 AS lon, p_size % 3 AS lat, CASE WHEN p_size % 4 = 0 THEN ' ' ELSE p_brand END AS brand FROM part WHERE p_partkey % 11 > 0)
    SELECT path, ord, name, CASE WHEN brand = ' ' THEN '(not recorded)' ELSE brand END AS bucket FROM r QUALIFY row_number() OVER (PARTITION BY name, lon, lat, brand ORDER BY path, ord) = 1""",
)
def merged_places(spark, sf_dir):
    """Placemarks of two packs, repeated within and between them; unreadable packs' rows are left out."""
    rows = table(spark, sf_dir, "part").selectExpr(
        "CASE WHEN p_partkey % 2 = 0 THEN 'a.kmz' ELSE 'b.kmz' END AS path", "p_partkey AS ord", "p_name AS name", "CAST(p_size % 5 AS DOUBLE) AS lon", "CAST(p_size % 3 AS DOUBLE) AS lat",
        "map('brand', CASE WHEN p_size % 4 = 0 THEN ' ' ELSE p_brand END) AS fields", "CASE WHEN p_partkey % 11 = 0 THEN 'no zip' END AS error",
    )
    return W.merge_packs(rows, folder_by="brand").select("path", "ord", "name", "bucket")


@query(
    "osm_shapes",
    """WITH e AS (SELECT s_suppkey AS id, s_suppkey % 4 AS k FROM supplier)
    SELECT CASE k WHEN 0 THEN 'node' WHEN 3 THEN 'relation' ELSE 'way' END AS osm_type, id AS osm_id, CASE WHEN k > 0 THEN 'marker' END AS shape, 'Point' AS geom_type,
           CASE k WHEN 0 THEN '[' || id || '.5, 1.5]' WHEN 1 THEN '[' || id + 2 || '.5, 2.5]' WHEN 2 THEN '[' || id + 1 || '.5, 2.5]' END AS coordinates FROM e
    UNION ALL SELECT CASE k WHEN 3 THEN 'relation' ELSE 'way' END, id, 'shape', CASE k WHEN 2 THEN 'LineString' ELSE 'Polygon' END,
           CASE k WHEN 1 THEN '[[[' || id || '.5, 0.5], [' || id || '.5, 5.5], [' || id + 5 || '.5, 5.5], [' || id + 5 || '.5, 0.5], [' || id || '.5, 0.5]]]' WHEN 2 THEN '[[' || id || '.5, 1.5], [' || id + 2 || '.5, 3.5]]' END FROM e WHERE k > 0""",
)
def osm_shapes(spark, sf_dir):
    """Nodes, closed and open ways, and relations whose ring is cut in two."""
    x = F.col("s_suppkey") + 0.5
    pt = lambda dx, y: F.struct(F.lit(y).alias("lat"), (x + dx).alias("lon"))
    square = [pt(0, 0.5), pt(0, 5.5), pt(5, 5.5), pt(5, 0.5), pt(0, 0.5)]
    member = lambda pts: F.struct(F.lit("way").alias("type"), F.lit("outer").alias("role"), F.array(*pts).alias("geometry"))
    k = F.col("s_suppkey") % 4
    e = table(spark, sf_dir, "supplier").select(
        F.when(k == 0, "node").when(k == 3, "relation").otherwise("way").alias("type"),
        F.col("s_suppkey").alias("id"),
        F.when(k == 0, 1.5).alias("lat"),
        F.when(k == 0, x).alias("lon"),
        F.when(k == 1, F.create_map(F.lit("building"), F.lit("yes"))).when(k == 3, F.create_map(F.lit("type"), F.lit("multipolygon"))).otherwise(F.create_map(F.lit("highway"), F.lit("track"))).alias("tags"),
        F.when(k == 1, F.array(*square)).when(k == 2, F.array(pt(0, 1.5), pt(2, 3.5))).alias("geometry"),
        F.when(k == 3, F.array(member(square[:3]), member(square[:1:-1]))).alias("members"),
    )
    out = osm.features(e, represent="both")
    return out.select("osm_type", "osm_id", "shape", "geom_type", F.when(F.col("osm_type") != "relation", F.col("coordinates")).alias("coordinates"))


@query(
    "osm_rows",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name WHEN c_custkey % 3 = 1 THEN c_mktsegment ELSE '(unnamed)' END AS name, CASE WHEN c_custkey % 4 = 0 THEN '555' WHEN c_custkey % 4 = 1 THEN '777' END AS phone,
              CASE WHEN c_custkey % 5 = 0 THEN c_nationkey || ' Main St, Elk' WHEN c_custkey % 5 = 1 THEN 'Main St' WHEN c_custkey % 5 = 2 THEN 'Elk' END AS address FROM customer""",
)
def osm_rows(spark, sf_dir):
    tags = F.expr("""map('name', CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE ' ' END, 'operator', CASE WHEN c_custkey % 3 = 1 THEN c_mktsegment END, 'contact:phone', CASE WHEN c_custkey % 4 = 0 THEN ' 555' END, 'telephone', CASE WHEN c_custkey % 4 < 2 THEN '777' END,
        'addr:housenumber', CASE WHEN c_custkey % 5 = 0 THEN CAST(c_nationkey AS STRING) END, 'addr:street', CASE WHEN c_custkey % 5 < 2 THEN 'Main St' END, 'addr:city', CASE WHEN c_custkey % 5 IN (0, 2) THEN 'Elk' END)""")
    return osm.row_projection(table(spark, sf_dir, "customer").select("c_custkey", tags.alias("tags"))).select("c_custkey", "name", "phone", "address")


@query(
    "pack_issues",
    """WITH p AS (SELECT c_name AS path, c_mktsegment AS family, c_custkey % 50 AS mtime, c_custkey // 2 AS sha, c_custkey % 9 AS n, c_custkey % 13 AS src, c_custkey % 17 = 0 AS bad FROM customer), f AS (SELECT * FROM p WHERE NOT bad)
    SELECT path, 'BROKEN' AS kind, 'no zip' AS detail FROM p WHERE bad
    UNION ALL SELECT path, 'DUPLICATE', first FROM f JOIN (SELECT sha, min(path) AS first FROM f GROUP BY sha) USING (sha) WHERE path <> first
    UNION ALL SELECT path, 'STALE', family FROM f JOIN (SELECT family, max(mtime) AS latest FROM f GROUP BY family) USING (family) WHERE mtime < latest
    UNION ALL SELECT path, 'EMPTY', '' FROM f WHERE n = 0 UNION ALL SELECT path, 'NO SOURCE', '' FROM f WHERE src = 0""",
)
def pack_issues(spark, sf_dir):
    packs = table(spark, sf_dir, "customer").selectExpr(
        "c_name AS path", "c_mktsegment AS family", "c_custkey % 50 AS mtime", "CAST(c_custkey DIV 2 AS STRING) AS sha", "c_custkey % 9 AS n_placemarks", "CASE WHEN c_custkey % 13 > 0 THEN 'feed' END AS provenance", "CASE WHEN c_custkey % 17 = 0 THEN 'no zip' END AS error"
    )
    none = packs.limit(0).selectExpr("path AS inner", "path AS outer")
    return I.pack_problems(packs, none).select("path", "kind", "detail")


@query(
    "widening_hints",
    """WITH r AS (SELECT p_size, p_name || ' of ' || p_brand || ' the ' || p_type AS name FROM part), w AS (SELECT p_size, ' ' || trim(regexp_replace(lower(name), '[^a-z0-9'']+', ' ', 'g')) || ' ' AS words FROM r),
    h AS (SELECT split_part(p_name, ' ', 2) AS hint FROM part UNION SELECT p_name FROM part UNION SELECT p_name || ' OF  ' || p_brand || ' the' FROM part WHERE p_partkey % 3 = 0
          UNION SELECT 'the ' || p_type FROM part UNION SELECT p_name || ' of ' || p_brand || ' the nothing' FROM part WHERE p_partkey % 5 = 0 UNION SELECT 'nowhere')
    SELECT hint, count(DISTINCT p_size) AS groups FROM h LEFT JOIN w ON contains(words, ' ' || trim(regexp_replace(lower(hint), '[^a-z0-9'']+', ' ', 'g')) || ' ') GROUP BY hint""",
)
def widening_hints(spark, sf_dir):
    """A12, with hints of one to ten words."""
    p = table(spark, sf_dir, "part")
    hints = p.selectExpr("split_part(p_name, ' ', 2) AS hint").union(p.select("p_name")).union(p.where("p_partkey % 3 = 0").selectExpr("p_name || ' OF  ' || p_brand || ' the'"))
    hints = hints.union(p.selectExpr("'the ' || p_type")).union(p.where("p_partkey % 5 = 0").selectExpr("p_name || ' of ' || p_brand || ' the nothing'")).union(p.limit(1).select(F.lit("nowhere"))).distinct()
    return I.widening(p.selectExpr("p_size", "p_name || ' of ' || p_brand || ' the ' || p_type AS name"), hints, group="p_size", name="name")


@query("county_names", "SELECT c_custkey FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 2 = 0 OR n_name IS NULL")
def county_names(spark, sf_dir):
    c, n = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    records = c.join(n, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", F.col("c_nationkey").alias("geoid"), F.when(F.col("c_custkey") % 2 == 0, "Sheriff").otherwise(F.concat(F.lit("Sheriff of "), F.upper("n_name"))).alias("name"))
    return I.names_of_county(records, n.select(F.col("n_nationkey").alias("geoid"), F.col("n_name").alias("county"))).select("c_custkey")


@query("station_scope", "SELECT s_suppkey, coalesce(s_suppkey % 3 = 0, false) AS own, s_suppkey % 3 = 0 OR s_suppkey % 4 = 0 AS coverage FROM supplier")
def station_scope(spark, sf_dir):
    own = F.expr("CASE s_suppkey % 3 WHEN 0 THEN ' mn' WHEN 1 THEN 'WI' END")
    counties = F.expr("CASE WHEN s_suppkey % 4 = 0 THEN array(named_struct('st', 'WI'), named_struct('st', 'Mn ')) WHEN s_suppkey % 4 = 1 THEN array(named_struct('st', CAST(NULL AS STRING))) END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", L.in_state(own, counties, "MN", False).alias("own"), L.in_state(own, counties, "MN", True).alias("coverage"))


@query("redacted_urls", "SELECT event_id, 'https://h/q?api_key=***&b=' || user_id || '&Token=***' AS url FROM events")
def redacted_urls(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", X.redact(F.concat(F.lit("https://h/q?api_key=s3"), "event_id", F.lit("&b="), "user_id", F.lit("&Token=x"), "event_type")).alias("url"))


@query("valid_places", "SELECT c_custkey, c_custkey % 7 IN (0, 1, 2) AS valid FROM customer")
def valid_places(spark, sf_dir):
    lon = F.expr("CASE c_custkey % 7 WHEN 0 THEN '180' WHEN 1 THEN '-93.5' WHEN 2 THEN '0' WHEN 3 THEN '180.01' WHEN 4 THEN 'NaN' WHEN 5 THEN '' ELSE '1' END")
    lat = F.expr("CASE c_custkey % 7 WHEN 0 THEN '-90' WHEN 6 THEN '90.5' ELSE '45' END")
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(X.valid_lonlat(lon, lat), F.lit(False)).alias("valid"))


@query("code_labels", "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE o_orderstatus END AS status FROM orders")
def code_labels(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", J.lookup(F.col("o_orderstatus"), {"O": "open", "F": "filled"}).alias("status"))


@query("land_areas", "SELECT p_partkey, round(p_partkey * 1000003.0::DOUBLE / 2589988.110336::DOUBLE, 1) AS square_miles FROM part")
def land_areas(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", L.square_miles(F.col("p_partkey") * 1000003.0).alias("square_miles"))


@query(
    "tone_counts",
    """WITH t AS (SELECT p_name, CASE p_partkey % 4 WHEN 0 THEN '114.8' WHEN 1 THEN 'd 47' WHEN 2 THEN '' ELSE CAST(p_size AS VARCHAR) || '.7' END AS tone, p_partkey % 4 AS k FROM part)
    SELECT CASE k WHEN 0 THEN 'ctcss' WHEN 1 THEN 'dcs' WHEN 2 THEN 'none' ELSE 'unrecognised' END AS kind, CASE WHEN k = 3 THEN tone END AS value,
           CASE WHEN k < 3 THEN '' WHEN length(tone) = 3 THEN 'not a CTCSS tone, DCS code or DMR colour code' ELSE 'not a CTCSS tone - looks like a frequency' END AS note, count(*) AS n, CASE WHEN k = 3 THEN min(p_name) END AS example FROM t GROUP BY 1, 2, 3, k""",
)
def tone_counts(spark, sf_dir):
    t = F.expr("CASE p_partkey % 4 WHEN 0 THEN ' 114.8' WHEN 1 THEN 'd 47' WHEN 2 THEN NULL ELSE concat(p_size, '.7') END")
    return I.tone_report(table(spark, sf_dir, "part").select("p_name", t.alias("tone")), "tone", "p_name")
