"""Queries over packs' and counties' records (inventory and label operators)."""

from pyspark.sql import functions as F

from terrasift.functions import labels as L
from terrasift.operators import inventory as I
from terrasift.operators.lineage import scratch_folder
from terrasift.plans.geo import SQL_LAT, SQL_LON, places
from terrasift.plans.registry import query, table
from terrasift.sinks import packs as W
from terrasift.sinks.archives import write_archives
from terrasift.sources import files


@query("geoid_codes", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN lpad(CAST(c_nationkey AS VARCHAR), 5, '2') WHEN c_custkey % 3 = 1 THEN lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 500 AS VARCHAR), 3, '0') END AS geoid FROM customer")
def geoid_codes(spark, sf_dir):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    five = F.when(k % 3 == 0, F.lpad(n.cast("string"), 5, "2")).otherwise("x")
    return table(spark, sf_dir, "customer").select("c_custkey", L.geoid(five, F.when(k % 3 == 1, n), k % 500).alias("geoid"))


@query("county_labels", "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN n_name WHEN 1 THEN upper(n_name) WHEN 2 THEN n_name || ' County' ELSE 'Unknown' END AS label, round(n_nationkey * 1000000 / 2589988.110336, 1) AS sq_mi FROM nation")
def county_labels(spark, sf_dir):
    k, n = F.col("n_nationkey"), F.col("n_name")
    label = L.county_label(F.when(k % 4 == 0, n), F.when(k % 4 == 1, F.upper(n)).otherwise(" "), F.when(k % 4 == 2, n))
    return table(spark, sf_dir, "nation").select("n_nationkey", label.alias("label"), L.square_miles(k * 1000000.0).alias("sq_mi"))


@query("name_template", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_brand ELSE p_name || ' - ' || p_brand END || CASE WHEN p_partkey % 2 = 0 THEN ' (' || p_size || ' MW)' ELSE '' END AS name FROM part")
def name_template(spark, sf_dir):
    k = F.col("p_partkey")
    fields = {"name": F.when(k % 3 != 0, F.col("p_name")), "brand": F.col("p_brand"), "mw": F.when(k % 2 == 0, F.col("p_size"))}
    return table(spark, sf_dir, "part").select("p_partkey", L.name_template("{name} - {brand} ({mw} MW)", fields).alias("name"))


@query("field_fill", "WITH e AS (SELECT p_brand AS source, 'size' AS key FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_brand, 'type' FROM part) SELECT key, source, count(*) AS n FROM e GROUP BY 1, 2 UNION ALL SELECT key, NULL, count(*) FROM e GROUP BY 1")
def field_fill(spark, sf_dir):
    fields = F.create_map(F.lit("size"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(" "), F.lit("type"), F.col("p_type"))
    return I.field_fill(table(spark, sf_dir, "part").select(F.col("p_brand").alias("source"), fields.alias("fields")), "fields", "source")


@query("field_coverage", "SELECT field, n, n_rows, round(100.0 * n / n_rows, 1) AS percent FROM (SELECT 'phone' AS field, count(*) FILTER (c_custkey % 4 = 0 OR c_custkey % 6 = 0) AS n, count(*) AS n_rows FROM customer)")
def field_coverage(spark, sf_dir):
    k = F.col("c_custkey")
    return I.coverage(table(spark, sf_dir, "customer"), {"phone": [F.when(k % 4 == 0, "1").otherwise(" "), F.when(k % 6 == 0, "2")]})


@query("edition_newest", "SELECT c_mktsegment AS family, CASE WHEN count(*) FILTER (m = t) = 1 THEN min(c_name) FILTER (m = t) END AS newest, count(*) - 1 AS others, CAST(sum(c_nationkey) AS BIGINT) AS size FROM (SELECT *, c_custkey // 7 AS t, max(c_custkey // 7) OVER (PARTITION BY c_mktsegment) AS m FROM customer) GROUP BY 1")
def edition_newest(spark, sf_dir):
    f = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("family"), F.col("c_name").alias("path"), F.expr("c_custkey div 7").alias("mtime"), F.col("c_nationkey").alias("size"))
    return I.newest_editions(f)


@query("two_way_missing", "SELECT n_nationkey AS k, 'a' AS only FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000) UNION ALL SELECT DISTINCT s_nationkey + 100, 'b' FROM supplier WHERE s_acctbal <= 0")
def two_way_missing(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    b = s.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k")).union(s.where("s_acctbal <= 0").select((F.col("s_nationkey") + 100).alias("k")))
    return I.two_way_missing(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k")), b, "k")


@query("vintage_years", "SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN CAST(year(o_orderdate) AS INT) ELSE 2019 END AS y FROM orders")
def vintage_years(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", L.vintage(F.when(F.col("o_orderkey") % 2 == 0, F.unix_millis(F.col("o_orderdate").cast("timestamp"))), F.lit("Census 2019, was 2010")).alias("y"))


@query("legacy_prefix", """SELECT DISTINCT a.c_name || '_' || a.c_nationkey AS name, b.c_name AS family FROM customer a JOIN customer b ON starts_with(a.c_name || '_' || a.c_nationkey, b.c_name) WHERE a.c_custkey % 2 = 0 AND length(b.c_name) >= 9""")
def legacy_prefix(spark, sf_dir):
    """Files that were named before editions were, of all customers' names and those of the even ones with a number behind."""
    c = table(spark, sf_dir, "customer")
    return I.legacy_of(c.where("c_custkey % 2 = 0").select(F.concat("c_name", F.lit("_"), "c_nationkey").alias("name")), c.select(F.col("c_name").alias("family")), 9)


@query(
    "map_packs",
    f"""WITH p AS (SELECT c_custkey, c_mktsegment AS doc, n_name, n_nationkey, c_name, {SQL_LON.format(k="c_custkey")} AS lon, {SQL_LAT.format(k="c_custkey")} AS lat FROM customer JOIN nation ON n_nationkey = c_nationkey)
    SELECT doc, row_number() OVER (PARTITION BY doc ORDER BY n_nationkey, c_custkey) - 1 AS ord, n_name || ' (' || count(*) OVER (PARTITION BY doc, n_nationkey) || ')' AS folder, c_name || ' & co' AS name,
           CAST(round(lon * 10000) AS BIGINT) AS lon4, CAST(round(lat * 10000) AS BIGINT) AS lat4, n_name AS nation FROM p""",
)
def map_packs(spark, sf_dir):
    """An archive for each market segment, with a folder for each nation, written by many tasks and read back."""
    rows = places(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    shaped = rows.withColumn("geom_type", F.lit("Point")).withColumn("coordinates", F.to_json(F.array("lon", "lat")))
    fields = F.array(F.struct(F.lit("nation").alias("label"), F.col("n_name").alias("value")))
    marks = W.placemarks(shaped, F.concat("c_name", F.lit(" & co")), fields, F.lit("s"))
    path = scratch_folder(spark, "map-packs")
    write_archives(marks.select(F.col("c_mktsegment").alias("doc"), F.col("n_name").alias("bucket"), F.col("n_nationkey").alias("place"), F.col("id").alias("ord"), "xml"), path)
    back = files.kml(spark, path)
    return back.select(F.regexp_extract("path", r"([^/]+)\.kmz$", 1).alias("doc"), "ord", "folder", "name", F.round(F.col("lon") * 10000).cast("long").alias("lon4"), F.round(F.col("lat") * 10000).cast("long").alias("lat4"), F.col("fields")["nation"].alias("nation"))
