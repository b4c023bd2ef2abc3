from pyspark.sql import functions as F

from terrasift.llm.quality_rules import quality_rules

SF = "/root/testdata/sf0.1"


def test_outliers_against_labels(spark):
    """What the distance rejects beyond the base rules, by label."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality").dropDuplicates(["doc_id"])
    rows = quality_rules(docs).where("NOT base_failed").join(labels, "doc_id").groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()
    by = {r.quality: r for r in rows}
    assert by[0].n > 200 and by[0].kept < 0.05 * by[0].n
    assert by[1].n > 2000 and by[1].kept > 0.999 * by[1].n
