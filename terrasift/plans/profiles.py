"""Queries over the tables' own columns: figures, candidate keys and references between tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.operators import profiles as P
from terrasift.plans.registry import query, table

COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "customer": ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
}
_VALUE = "nullif(trim(CAST({c} AS VARCHAR)), '')"


@query(
    "column_figures",
    " UNION ALL ".join(
        f"""SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS n_rows, count(v) AS n, min(length(v)) AS shortest, max(length(v)) AS longest,
        CASE WHEN count(try_cast(v AS DOUBLE)) = count(v) THEN min(try_cast(v AS DOUBLE)) END AS least, CASE WHEN count(try_cast(v AS DOUBLE)) = count(v) THEN max(try_cast(v AS DOUBLE)) END AS most FROM (SELECT {_VALUE.format(c=c)} AS v FROM {t})"""
        for t, cs in COLUMNS.items()
        for c in cs
        if c not in ("s_acctbal", "c_acctbal", "p_retailprice")
    ),
)
def column_figures(spark, sf_dir):
    """What one pass tells of every column but those of doubles, which the engines print differently."""
    parts = [P.profile(table(spark, sf_dir, t).select(*(c for c in cs if c not in ("s_acctbal", "c_acctbal", "p_retailprice")))).withColumn("table", F.lit(t)) for t, cs in COLUMNS.items()]
    return reduce(DataFrame.unionByName, parts).select("table", "column", "n_rows", "n", "shortest", "longest", "least", "most")


@query(
    "candidate_keys",
    " UNION ALL ".join(
        f"""SELECT * FROM (SELECT '{t}' AS "table", '{c}' AS "column", count(*) AS n_rows, coalesce(count(try_cast(v AS DOUBLE)) = count(v) AND min(try_cast(v AS DOUBLE)) IN (0, 1) AND max(try_cast(v AS DOUBLE)) - min(try_cast(v AS DOUBLE)) + 1 = count(*), false) AS serial
        FROM (SELECT {_VALUE.format(c=c)} AS v FROM {t}) HAVING count(*) > 0 AND count(DISTINCT v) = count(*))"""
        for t, cs in COLUMNS.items()
        for c in cs
    ),
)
def candidate_keys(spark, sf_dir):
    """The keys of five tables, with those that only count rows."""
    return reduce(DataFrame.unionByName, [P.candidate_keys(table(spark, sf_dir, t)).withColumn("table", F.lit(t)) for t in COLUMNS]).select("table", "column", "n_rows", "serial")


_KEYS = [("region", "r_regionkey"), ("nation", "n_nationkey"), ("nation", "n_name"), ("supplier", "s_suppkey"), ("customer", "c_custkey"), ("part", "p_partkey")]
_EXACT = {t: [c for c in cs if c not in ("s_acctbal", "c_acctbal", "p_retailprice")] for t, cs in COLUMNS.items()}


@query(
    "column_references",
    "WITH v AS ("
    + " UNION ALL ".join(f"""SELECT DISTINCT '{t}' AS "table", '{c}' AS "column", {_VALUE.format(c=c)} AS v FROM {t} WHERE {_VALUE.format(c=c)} IS NOT NULL""" for t, cs in _EXACT.items() for c in cs)
    + """), k AS (SELECT "table" AS key_table, "column" AS key_column, v FROM v WHERE """
    + " OR ".join(f"""("table" = '{t}' AND "column" = '{c}')""" for t, c in _KEYS)
    + """), n AS (SELECT "table", "column", count(*) AS n_values FROM v GROUP BY ALL)
    SELECT v."table", v."column", key_table, key_column, any_value(n_values) AS n_values, count(*) AS n_found FROM v JOIN k ON k.v = v.v AND (v."table" <> key_table OR v."column" <> key_column) JOIN n ON n."table" = v."table" AND n."column" = v."column" GROUP BY ALL""",
)
def column_references(spark, sf_dir):
    """Which columns of five tables hold values of which keys."""
    return P.references({t: table(spark, sf_dir, t).select(*cs) for t, cs in _EXACT.items()}, _KEYS)
