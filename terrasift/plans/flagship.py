"""The flagship query: customers as dirty map features, clipped, deduplicated and counted by class."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.functions.geometry import in_box
from terrasift.operators.rows import counts_with_zeros, first_by_key
from terrasift.plans.registry import query, table

AOI = (-96.0, 43.5, -90.0, 48.5)


@query(
    "segment_reconcile_lite",
    """
    WITH f AS (
        SELECT c_custkey AS ord, c_mktsegment AS segment, c_custkey // 2 AS source_id,
               -97.0 + ((c_custkey * 7919) % 80000) / 10000.0 AS lon,
               43.0 + ((c_custkey * 6271) % 60000) / 10000.0 AS lat
        FROM customer),
    clipped AS (SELECT * FROM f WHERE lon BETWEEN -96.0 AND -90.0 AND lat BETWEEN 43.5 AND 48.5),
    kept AS (SELECT * FROM clipped QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY ord) = 1)
    SELECT d.segment, count(k.ord) AS n_features, CAST(sum(k.ord) AS BIGINT) AS sum_keys
    FROM (SELECT DISTINCT c_mktsegment AS segment FROM customer) d
    LEFT JOIN kept k ON k.segment = d.segment
    GROUP BY d.segment
    """,
)
def segment_reconcile_lite(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    f = c.select(
        F.col("c_custkey").alias("ord"),
        F.col("c_mktsegment").alias("segment"),
        F.expr("c_custkey div 2").alias("source_id"),
        F.expr("-97.0D + ((c_custkey * 7919) % 80000) / 10000.0D").alias("lon"),
        F.expr("43.0D + ((c_custkey * 6271) % 60000) / 10000.0D").alias("lat"),
    )
    kept = first_by_key(f.where(in_box(F.col("lon"), F.col("lat"), AOI)), [F.col("source_id")], [F.col("ord")])
    counts = counts_with_zeros(kept, c.select(F.col("c_mktsegment").alias("segment")).distinct(), "segment", F.sum("ord").alias("sum_keys"))
    return counts.withColumnRenamed("n", "n_features")
