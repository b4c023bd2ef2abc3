"""Queries over state packs' records, on tables derived from the driver's (operators of packs, feeds and health)."""

from pyspark.sql import functions as F

from terrasift.operators import packs as K
from terrasift.plans.registry import query, table
from terrasift.sources import feeds

STATES = {"MN": ("27", "Minnesota"), "WI": ("55", "Wisconsin"), "CA": ("06", "California")}


@query(
    "raw_and_canonical",
    """SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'name=' || p_type || ';size=' || p_size || ';src_name=' || p_name WHEN p_partkey % 3 = 1 THEN 'name=' || p_name || ';size=' || p_size
              ELSE 'kv=1;name=' || p_name || ';size=' || p_size END AS props FROM part""",
)
def raw_and_canonical(spark, sf_dir):
    k = F.col("p_partkey")
    raw = F.create_map(F.lit("name"), F.col("p_name"), F.lit("size"), F.col("p_size").cast("string"))
    canonical = F.create_map(F.lit("name"), F.when(k % 3 == 0, F.col("p_type")).when(k % 3 == 1, F.col("p_name")), F.lit("kv"), F.when(k % 3 == 2, "1"))
    both = K.with_canonical(raw, canonical)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(F.array_sort(F.map_entries(both)), lambda e: F.concat(e.key, F.lit("="), e.value)), ";").alias("props"))


@query("shape_points", "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 4 END AS points, CASE s_suppkey % 3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 6 END AS edges, CASE s_suppkey % 3 WHEN 2 THEN 2 ELSE 0 END AS rings FROM supplier")
def shape_points(spark, sf_dir):
    k = F.col("s_suppkey")
    ring, line = "[[0,0],[0,{0}],[{0},{0}],[0,0]]", "[[0,0],[1,1],[2,0]]"
    kind = F.when(k % 3 == 0, "Point").when(k % 3 == 1, "LineString").otherwise("Polygon")
    where = F.when(k % 3 == 0, F.lit("[1,2]")).when(k % 3 == 1, F.lit(line)).otherwise(F.lit(f"[{ring.format(9)},{ring.format(1)}]"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.size(K.sample_points(kind, where)).alias("points"), F.size(K.segments(kind, where)).alias("edges"), F.size(K.rings(kind, where)).alias("rings"))


@query("ring_parity", "SELECT c_custkey, (c_custkey % 10) + 0.5 < 6 AND (c_custkey % 7) + 0.25 < 4 AS inside FROM customer")
def ring_parity(spark, sf_dir):
    ring = F.from_json(F.lit("[[0,0],[6,0],[6,4],[0,4]]"), "array<array<double>>")
    return table(spark, sf_dir, "customer").select("c_custkey", K.in_ring(F.col("c_custkey") % 10 + 0.5, F.col("c_custkey") % 7 + 0.25, ring).alias("inside"))


@query(
    "rescale_box",
    """WITH p AS (SELECT s_suppkey, (s_suppkey * 37 % 1000) / 10.0::DOUBLE AS x, (s_suppkey * 53 % 700) / 10.0::DOUBLE AS y FROM supplier), b AS (SELECT min(x) x0, max(x) x1, min(y) y0, max(y) y1 FROM p),
    k AS (SELECT *, least(4 * 0.88::DOUBLE / (x1 - x0), 2 * 0.88::DOUBLE / (y1 - y0)) AS k FROM b)
    SELECT s_suppkey, CAST(round(round(-94 + (x - (x0 + x1) / 2) * k, 6) * 1e4) AS BIGINT) AS x, CAST(round(round(45 + (y - (y0 + y1) / 2) * k, 6) * 1e4) AS BIGINT) AS y FROM p, k""",
)
def rescale_box(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "(s_suppkey * 37 % 1000) / 10.0D AS x", "(s_suppkey * 53 % 700) / 10.0D AS y")
    return K.rescaled(p, "x", "y", (-96.0, 44.0, -92.0, 46.0)).select("s_suppkey", *(F.round(F.col(c) * 1e4).cast("long").alias(c) for c in "xy"))


@query(
    "plant_popup",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 > 0 THEN 'Nameplate capacity: ' || p_size || '.0 MW; ' ELSE '' END || CASE WHEN p_partkey % 5 > 0 THEN 'Max summer capacity: ' || p_partkey % 90 || '.5 MW; ' ELSE '' END || 'Primary fuel: ' || p_type
              || CASE WHEN p_partkey % 6 = 0 THEN '; coal: 1.0 MW; wind: 2.5 MW' ELSE '' END AS popup FROM part""",
)
def plant_popup(spark, sf_dir):
    k = F.col("p_partkey")
    fields = {"Install_MW": F.when(k % 4 > 0, F.col("p_size").cast("string")).otherwise(" "), "Total_MW": F.when(k % 5 > 0, k % 90 + 0.5), "PrimSource": F.col("p_type"), "Utility_Na": F.lit(" "), "Coal_MW": F.when(k % 6 == 0, "1").otherwise("0"), "Wind_MW": F.when(k % 6 == 0, "2.5").otherwise(""), "Solar_MW": F.lit("n/a")}
    rows = K.plant_record(fields)
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.transform(rows, lambda r: F.concat(r.label, F.lit(": "), r.value)), "; ").alias("popup"))


@query(
    "station_popup",
    """SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN '162.550 MHz' ELSE '162.600 MHz' END AS listen, CASE WHEN s_suppkey % 3 = 0 THEN s_name ELSE s_name || ' (Hill)' END AS site,
              CASE WHEN s_suppkey % 4 = 0 THEN '' ELSE CAST(1 + CAST(s_suppkey % 5 = 0 AS INT) AS VARCHAR) END AS alerted, s_suppkey % 2 = 1 AS off_channel FROM supplier""",
)
def station_popup(spark, sf_dir):
    k = F.col("s_suppkey")
    county = lambda same, st: F.struct(same.alias("same"), F.lit("C").alias("county"), F.lit(st).alias("st"))
    counties = F.when(k % 4 == 0, F.array(county(F.lit(" "), "MN"))).otherwise(F.array(county(F.lit("027053"), "mn"), county(F.when(k % 5 == 0, "127053").otherwise(""), "MN"), county(F.lit("055001"), "WI")))
    freq = F.when(k % 2 == 0, " 162.550").otherwise("162.600")
    rows = K.station_record("MN", freq, F.lit("300"), F.lit(None), F.col("s_name"), F.when(k % 3 == 0, F.upper("s_name")).otherwise("Hill"), F.lit("A|MN"), counties)
    at = lambda i: F.get(rows, F.lit(i))["value"]
    return table(spark, sf_dir, "supplier").select("s_suppkey", at(0).alias("listen"), at(3).alias("site"), at(5).alias("alerted"), K.off_channel(freq).alias("off_channel"))


@query("style_dimension", "SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'bolt' WHEN 1 THEN 'sun' ELSE 'dot' END AS glyph, 'ff00' AS color, CASE WHEN p_size >= 40 THEN 'k_r0' WHEN p_size >= 20 THEN 'k_r1' ELSE 'k' END AS style, p_size % 3 <> 1 AS visible FROM part")
def style_dimension(spark, sf_dir):
    d = spark.sql("SELECT * FROM VALUES ('power', 'bolt', 'ffff'), ('solar', 'sun', CAST(NULL AS STRING)) AS t(layer, glyph, color)")
    p = table(spark, sf_dir, "part").withColumn("layer", F.when(F.col("p_size") % 3 == 0, "power").when(F.col("p_size") % 3 == 1, "solar").otherwise("other"))
    out = K.styled(p, d, {"color": "ff00"}, {"glyph": "dot"})
    return out.select("p_partkey", "glyph", "color", K.style_key("k", [F.col("p_size") >= 40, F.col("p_size") >= 20]).alias("style"), K.visible(F.col("layer"), off={"solar"}).alias("visible"))


@query("provenance_block", "SELECT n_nationkey, '<![CDATA[source: ' || n_name || ' &amp; co<br/>url: u<br/>license: PD<br/>retrieved: 2024' || CASE WHEN n_nationkey % 2 = 0 THEN '<br/>note: x &lt; y' ELSE '' END || ']]>' AS text FROM nation")
def provenance_block(spark, sf_dir):
    note = F.when(F.col("n_nationkey") % 2 == 0, "x < y").otherwise(" ")
    return table(spark, sf_dir, "nation").select("n_nationkey", K.provenance_text(F.concat("n_name", F.lit(" & co")), F.lit("u"), F.lit("PD"), F.lit("2024"), note).alias("text"))


@query("state_codes", "SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN '27' WHEN 1 THEN '55' WHEN 2 THEN '06' WHEN 3 THEN '06' END AS code FROM customer")
def state_codes(spark, sf_dir):
    said = F.expr("CASE c_custkey % 5 WHEN 0 THEN ' mn ' WHEN 1 THEN 'wisconsin' WHEN 2 THEN '6' WHEN 3 THEN 'CA' ELSE 'XX' END")
    return table(spark, sf_dir, "customer").select("c_custkey", K.state_code(said, STATES).alias("code"))


@query("county_enrichment", "SELECT n_nationkey AS geoid, n_name AS seat, CASE WHEN n > 5 THEN n END AS le FROM nation LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) ON s_nationkey = n_nationkey WHERE n_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def county_enrichment(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    counties = K.without_known(n.select(F.col("n_nationkey").alias("geoid")), n.where("n_regionkey = 2").select(F.col("n_nationkey").alias("geoid")), ["geoid"])
    le = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("geoid")).agg(F.count("*").alias("le")).where("le > 5")
    return K.enriched(counties, n.select(F.col("n_nationkey").alias("geoid"), F.col("n_name").alias("seat")), le)


@query("gazetteer_lookup", "WITH g AS (SELECT n_regionkey AS s, lower(n_name) AS k, min(n_nationkey) AS c FROM nation GROUP BY 1, 2) SELECT n_nationkey, CASE WHEN n_nationkey % 4 > 0 THEN lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(c AS VARCHAR), 3, '0') END AS geoid FROM nation JOIN g ON s = n_regionkey AND k = lower(n_name)")
def gazetteer_lookup(spark, sf_dir):
    code = F.lpad(F.col("n_regionkey").cast("string"), 2, "0")
    n = table(spark, sf_dir, "nation")
    g = n.select(code.alias("state_code"), F.col("n_nationkey").cast("string").alias("county_code"), F.concat("n_name", F.lit(" County")).alias("name"), F.col("n_nationkey").alias("ord"))
    wanted = n.select("n_nationkey", code.alias("state_code"), F.when(F.col("n_nationkey") % 4 > 0, F.upper("n_name")).otherwise("nowhere").alias("county"))
    return K.find_counties(wanted, g).select("n_nationkey", "geoid")


@query("element_order", "WITH e AS (SELECT event_type AS type, user_id AS id, min(event_id) AS ord FROM events GROUP BY 1, 2) SELECT *, CAST(row_number() OVER (PARTITION BY type ORDER BY id) AS INT) AS place FROM e")
def element_order(spark, sf_dir):
    return K.distinct_elements(table(spark, sf_dir, "events").select(F.col("event_type").alias("type"), F.col("user_id").alias("id"), F.col("event_id").alias("ord")))


@query("named_places", "SELECT p_partkey, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY lower(p_type), CAST(p_partkey AS VARCHAR)) AS INT) AS place FROM part")
def named_places(spark, sf_dir):
    return K.named_order(table(spark, sf_dir, "part").withColumn("name", F.when(F.col("p_partkey") % 2 == 0, F.col("p_type")).otherwise(F.lower("p_type"))), ["p_brand"], ident="p_partkey").select("p_partkey", "place")


@query("status_summary", "SELECT count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'gone') AS gone, count(*) FILTER (event_type = 'error' AND user_id % 2 = 0) AS recovered FROM events")
def status_summary(spark, sf_dir):
    return K.status_summary(table(spark, sf_dir, "events").withColumn("status", F.col("event_type")).withColumn("recovered", (F.col("event_type") == "error") & (F.col("user_id") % 2 == 0)), ["view", "gone"])


@query("merged_boundary", "SELECT s_nationkey AS k, CAST(sum(CASE s_suppkey % 3 WHEN 0 THEN 1 WHEN 1 THEN 2 ELSE 0 END) AS BIGINT) AS parts FROM supplier WHERE s_suppkey % 3 < 2 GROUP BY 1")
def merged_boundary(spark, sf_dir):
    ring = "[[0,0],[0,1],[1,1],[0,0]]"
    k = F.col("s_suppkey")
    shapes = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k"), k.alias("ord"), F.when(k % 3 == 0, "Polygon").when(k % 3 == 1, "MultiPolygon").otherwise("Point").alias("geom_type"), F.when(k % 3 == 0, f"[{ring}]").when(k % 3 == 1, f"[[{ring}],[{ring}]]").otherwise("[0,0]").alias("coordinates"))
    out = K.merged_boundary(shapes, "k")
    return out.select("k", F.size(F.from_json("coordinates", "array<array<array<array<double>>>>")).cast("long").alias("parts"))


@query("capacity_sums", "SELECT c_mktsegment, count(*) AS n, count(*) FILTER (c_custkey % 3 > 0) AS n_known, CAST(sum(c_nationkey) FILTER (c_custkey % 3 > 0) AS BIGINT) AS total FROM customer GROUP BY 1")
def capacity_sums(spark, sf_dir):
    return K.sizes(table(spark, sf_dir, "customer").withColumn("mw", F.when(F.col("c_custkey") % 3 > 0, F.col("c_nationkey"))), "c_mktsegment", "mw")


@query("shared_values", "SELECT o_custkey, array_to_string(list_sort(list_intersect(list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'O'), list(DISTINCT o_orderpriority) FILTER (o_orderstatus = 'F'))), ',') AS shared FROM orders GROUP BY 1 HAVING bool_or(o_orderstatus = 'O') AND bool_or(o_orderstatus = 'F')")
def shared_values(spark, sf_dir):
    of = lambda s: F.collect_set(F.when(F.col("o_orderstatus") == s, F.col("o_orderpriority")))
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(of("O").alias("a"), of("F").alias("b"))
    return o.where("size(a) > 0 AND size(b) > 0").select("o_custkey", F.array_join(K.common_values(F.col("a"), F.col("b")), ",").alias("shared"))


@query("union_conflicts", "SELECT c_mktsegment AS key, arg_min(c_nationkey % 3, c_custkey) AS value, count(DISTINCT c_nationkey % 3) > 1 AS conflict FROM customer GROUP BY 1")
def union_conflicts(spark, sf_dir):
    return K.union_first_wins(table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("key"), (F.col("c_nationkey") % 3).alias("value"), F.col("c_custkey").alias("ord")), "key", "value", "ord")


@query("class_folders", "WITH k(layer, label, place) AS (VALUES ('view', 'Views', 1), ('click', 'Clicks & more', 2), ('gone', 'Gone', 3)) SELECT layer, place, count(event_id) AS n, '<Folder><name>' || replace(label, '&', '&amp;') || ' (' || count(event_id) || ')</name>' AS head FROM k LEFT JOIN events ON event_type = layer GROUP BY layer, label, place")
def class_folders(spark, sf_dir):
    classes = spark.sql("SELECT * FROM VALUES ('view', 'Views', 1), ('click', 'Clicks & more', 2), ('gone', 'Gone', 3) AS t(layer, label, place)")
    return K.class_folders(table(spark, sf_dir, "events").withColumnRenamed("event_type", "layer"), classes).select("layer", "place", "n", "head")


@query("sheriff_names", "SELECT c_custkey, c_custkey % 3 < 2 AS sheriff FROM customer")
def sheriff_names(spark, sf_dir):
    name = F.expr("CASE c_custkey % 3 WHEN 0 THEN concat(c_name, ' SHERIFF') WHEN 1 THEN 'County Sherrif office' ELSE c_name END")
    return table(spark, sf_dir, "customer").select("c_custkey", K.is_sheriff(name).alias("sheriff"))


@query("state_features", "SELECT c_custkey, lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '00' || CAST(c_nationkey % 10 AS VARCHAR) AS geoid FROM customer WHERE c_custkey % 7 > 0 AND c_custkey % 100 = 27")
def state_features(spark, sf_dir):
    code = F.concat(F.lpad((F.col("c_custkey") % 100).cast("string"), 2, "0"), F.when(F.col("c_custkey") % 7 > 0, "00").otherwise("x"), (F.col("c_nationkey") % 10).cast("string"))
    return feeds.of_state(table(spark, sf_dir, "customer").withColumn("properties", F.create_map(F.lit("GEOID"), code)), "27").select("c_custkey", "geoid")


@query("web_mercator", "SELECT s_suppkey, CAST(round(degrees((s_suppkey * 1000.0::DOUBLE) / 6378137) * 1e6) AS BIGINT) AS lon, CAST(round(degrees(2 * atan(exp((s_suppkey * 500.0::DOUBLE) / 6378137)) - pi() / 2) * 1e6) AS BIGINT) AS lat FROM supplier")
def web_mercator(spark, sf_dir):
    lon, lat = feeds.to_lonlat(F.col("s_suppkey") * 1000.0, F.col("s_suppkey") * 500.0, "EPSG:3857")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(lon * 1e6).cast("long").alias("lon"), F.round(lat * 1e6).cast("long").alias("lat"))


@query(
    "acs_rows",
    "SELECT lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS geoid, CASE WHEN n_nationkey % 4 > 0 THEN n_nationkey * 1000 END AS population, 'ACS' AS source, '2023' AS vintage FROM nation",
)
def acs_rows(spark, sf_dir):
    """The API's answer made from nation: a header row, then a row each, suppressed values negative."""
    row = F.array(F.col("n_name"), F.when(F.col("n_nationkey") % 4 > 0, (F.col("n_nationkey") * 1000).cast("string")).otherwise("-666666666"), F.lpad(F.col("n_regionkey").cast("string"), 2, "0"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    rows = table(spark, sf_dir, "nation").agg(F.collect_list(row).alias("r"))
    head = F.array(F.array(*map(F.lit, ("NAME", "B01003_001E", "state", "county"))))
    return feeds.acs_table(rows.select(F.to_json(F.concat(head, "r")).alias("value")), {"population": "B01003_001E"}, "ACS", "2023")


@query("county_seats", "SELECT lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS geoid, arg_min(s_name, s_suppkey) AS seat FROM supplier WHERE s_suppkey % 5 > 0 GROUP BY 1")
def county_seats(spark, sf_dir):
    each = F.struct(F.struct(F.lpad(F.col("s_nationkey").cast("string"), 5, "0").alias("value")).alias("fips"), F.struct(F.when(F.col("s_suppkey") % 5 > 0, F.col("s_name")).otherwise("Q123").alias("value")).alias("seatLabel"))
    rows = table(spark, sf_dir, "supplier").agg(F.array_sort(F.collect_list(F.struct("s_suppkey", each.alias("b")))).alias("l"))
    return feeds.seats(rows.select(F.to_json(F.struct(F.struct(F.col("l.b").alias("bindings")).alias("results"))).alias("value")))
