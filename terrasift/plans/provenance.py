"""Queries over trees of layers, vintages, sourced values and county records made from the tables."""

from pyspark.sql import functions as F

from terrasift.operators import provenance as P
from terrasift.plans.registry import query, table

_LAYERS = """SELECT c_custkey % 7 AS service, c_custkey // 7 AS id, CASE WHEN c_custkey % 4 = 3 THEN ' ' ELSE c_name END AS name,
 CASE WHEN c_custkey % 7 = 3 THEN -1 WHEN (c_custkey // 7) % 50 = 17 THEN c_custkey // 7 + 5 WHEN (c_custkey // 7) % 10 = 0 THEN NULL ELSE (c_custkey // 7) - 1 - c_custkey % 3 END AS parent FROM customer"""


def _layers(spark, sf_dir):
    k, i = F.col("c_custkey"), F.expr("c_custkey div 7")
    parent = F.when(k % 7 == 3, -1).when(i % 50 == 17, i + 5).when(i % 10 == 0, None).otherwise(i - 1 - k % 3)
    return table(spark, sf_dir, "customer").select((k % 7).alias("service"), i.alias("id"), F.when(k % 4 == 3, " ").otherwise(F.col("c_name")).alias("name"), parent.cast("long").alias("parent"))


@query(
    "layer_roots",
    f"""WITH RECURSIVE l AS ({_LAYERS}), p AS (SELECT l.service, l.id, q.id AS up FROM l LEFT JOIN l q ON q.service = l.service AND q.id = l.parent AND q.id <> l.id),
    w AS (SELECT service, id, id AS at, id AS under, 0 AS steps FROM p UNION ALL SELECT w.service, w.id, p.up, w.at, w.steps + 1 FROM w JOIN p ON p.service = w.service AND p.id = w.at WHERE p.up IS NOT NULL AND w.steps < 400),
    r AS (SELECT w.service, w.id, w.at AS root, w.under, w.steps FROM w JOIN p ON p.service = w.service AND p.id = w.at WHERE p.up IS NULL)
    SELECT l.service, l.id, root, under, CAST(steps AS BIGINT) AS steps FROM l LEFT JOIN r USING (service, id)""",
)
def layer_roots(spark, sf_dir):
    """Every layer's root, with loops and parents that are not there."""
    return P.climbed(_layers(spark, sf_dir), "service")


@query(
    "layer_vintages",
    f"""WITH l AS ({_LAYERS}), g AS (SELECT service, bool_or(EXISTS (SELECT 1 FROM l q WHERE q.service = l.service AND q.id = l.parent)) AS grouped FROM l GROUP BY 1),
    y AS (SELECT n_nationkey AS service, regexp_extract(n_name || ' of 19' || (50 + n_nationkey) || ' or 2020', '((?:19|20)[0-9][0-9])', 1) AS year FROM nation WHERE n_nationkey % 2 = 1)
    SELECT l.service, l.id, CASE WHEN q.id IS NOT NULL THEN coalesce(nullif(trim(q.name), ''), 'unknown') WHEN grouped THEN 'Current' ELSE coalesce(year, 'unknown') END AS vintage
    FROM l LEFT JOIN l q ON q.service = l.service AND q.id = l.parent JOIN g ON g.service = l.service LEFT JOIN y ON y.service = l.service""",
)
def layer_vintages(spark, sf_dir):
    n = F.col("n_nationkey")
    words = F.concat("n_name", F.lit(" of 19"), n + 50, F.lit(" or 2020"))
    services = table(spark, sf_dir, "nation").select(n.cast("long").alias("service"), F.when(n % 2 == 0, "no year in 12345").alias("name"), F.when(n % 2 == 1, words).alias("description"))
    return P.layer_vintages(_layers(spark, sf_dir), services)


_VALUES = """SELECT o_custkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderstatus END AS value, o_orderpriority AS source, year(o_orderdate) AS vintage, o_orderkey FROM orders"""


@query(
    "sourced_values",
    f"""WITH v AS ({_VALUES}), f AS (SELECT * FROM v WHERE value <> ''), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY vintage DESC, o_orderkey) AS place FROM f)
    SELECT k, coalesce(b.value || '  [' || b.source || ' ' || b.vintage || ']', '') AS shown, CAST(greatest((SELECT count(DISTINCT value) FROM f WHERE f.k = a.k) - 1, 0) AS INT) AS others FROM (SELECT DISTINCT k FROM v) a LEFT JOIN b USING (k) WHERE b.place IS NULL OR b.place = 1""",
)
def sourced_values(spark, sf_dir):
    """Each customer's newest order status that is one, with where it comes from."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select(F.col("o_custkey").alias("k"), F.when(k % 3 == 0, "").when(k % 7 == 0, None).otherwise(F.col("o_orderstatus")).alias("value"), F.col("o_orderpriority").alias("source"), F.year("o_orderdate").alias("vintage"), k)
    best = P.best_sourced(rows, ["k"], [-F.col("vintage"), F.col("o_orderkey")])
    return best.select("k", P.rendered(F.col("best")).alias("shown"), "others")


@query(
    "county_records",
    """WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal > 0 THEN CAST(floor(c_acctbal * 100) AS BIGINT) END AS people, CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment || ' & co' END AS seat, c_nationkey FROM customer)
    SELECT c_custkey, 'County: <b>' || c_name || '</b> <font color="#888888">[TIGER ' || c_nationkey || ']</font><br/>'
     || CASE WHEN people IS NOT NULL THEN 'Population: <b>' || format('{:,}', people) || '</b> <font color="#888888">[ACS]</font><br/>' ELSE '' END
     || CASE WHEN seat IS NOT NULL THEN 'Seat: <b>' || replace(seat, '&', '&amp;') || '</b><br/>' ELSE '' END
     || CASE WHEN people IS NULL OR seat IS NULL THEN '<br/><font color="#888888"><i>No data for: ' || concat_ws(', ', CASE WHEN people IS NULL THEN 'Population' END, CASE WHEN seat IS NULL THEN 'Seat' END) || '</i></font><br/>' ELSE '' END AS body,
     CAST((people IS NULL)::INT + (seat IS NULL)::INT AS INT) AS n_missing FROM c""",
)
def county_records(spark, sf_dir):
    """With the fields that are absent."""
    c = table(spark, sf_dir, "customer")
    none = F.lit(None).cast("string")
    people = F.when(F.col("c_acctbal") > 0, F.floor(F.col("c_acctbal") * 100))
    seat = F.when(F.col("c_custkey") % 4 == 0, F.concat("c_mktsegment", F.lit(" & co"))).otherwise("")
    record = P.county_record([("County", P.sourced(F.col("c_name"), F.lit("TIGER"), F.col("c_nationkey"))), ("Population", P.sourced(people, F.lit("ACS"), none)), ("Seat", P.sourced(seat, none, none))])
    return c.select("c_custkey", record.alias("r")).select("c_custkey", "r.body", F.size("r.missing").alias("n_missing"))
