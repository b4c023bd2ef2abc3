"""A corpus from raw documents to token ids: classify, apply rules, drop near-duplicates, mix sources, encode.

Each stage takes (spark, docs, sf_dir) and returns the columns of docs, but for the last, which returns ids of tokens. A stage's
result is written and read again as the next one's docs. Stages that only judge rows pass the rows through, so that texts
are not shuffled; the two that compare or sample documents join their decisions back by doc_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.llm.common import cut, table
from terrasift.llm.mixing import mix
from terrasift.llm.near_dedup import near_groups
from terrasift.llm.piece_codec import encode
from terrasift.llm.quality_classifier import classify
from terrasift.llm.quality_rules import quality_rules
from terrasift.operators.lineage import drop_scratch, scratch_tables


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns c0, c1, ..., which clash with no operator's, and what each name became."""
    of = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*of.values()), of


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose predicted quality is 1."""
    rows, of = _plain(docs)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias(of["doc_id"]), "quality")
    out = classify(rows, labels, id_col=of["doc_id"], text_col=of["text"], keep=tuple(of.values()))
    return out.where("predicted = 1").select(*of.values()).toDF(*of)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the outlier test keep."""
    rows, of = _plain(docs)
    judged = quality_rules(rows, of["doc_id"], of["text"], of["lang"], of["source"], keep=tuple(c for c in of.values() if c != of["doc_id"]))
    return judged.where("kept").select(*of.values()).toDF(*of)


def _once(rows: DataFrame, decided: DataFrame, of: dict[str, str]) -> DataFrame:
    """Rows whose key is decided, those of equal id and text once; of their other columns those whose JSON is least. Both are brought together by key, so a row is shuffled once."""
    found = rows.join(decided, "key")
    rest = F.struct(*(F.col(c) for c in found.columns if c not in ("key", of["doc_id"], of["text"])))
    return found.groupBy("key", of["doc_id"], of["text"]).agg(F.min_by(rest, F.to_json(rest)).alias("rest")).select("key", of["doc_id"], of["text"], "rest.*")


def _key(doc_id: Column, text_hash: Column) -> Column:
    """The id as it is, and the text's hash: only texts of one id can be mistaken for each other."""
    return F.concat(F.coalesce(F.concat(F.lit("v"), doc_id.cast("string")), F.lit("n")), F.lit(":"), text_hash.cast("string"))


def _keyed(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """As _plain, with key, of id and text."""
    rows, of = _plain(docs)
    return rows.withColumn("key", _key(F.col(of["doc_id"]), F.xxhash64(of["text"]))), of


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id, once."""
    rows, of = _keyed(docs)
    found = near_groups(rows, shingle=5, percent=80, id_col=of["doc_id"], text_col=of["text"]).where("first")
    kept = found.select(_key(F.col(of["doc_id"]), F.col("text_hash")).alias("key")).distinct()
    return _once(rows, kept, of).select(*of.values()).toDF(*of)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows of equal id and text as often as they are taken together."""
    rows, of = _keyed(docs)
    taken = mix(rows, id_col="key", text_col=of["text"], source_col=of["source"]).groupBy("key").agg(F.sum("copies").cast("int").alias("copies")).where("copies > 0")
    return _once(rows, taken, of).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*of.values()).toDF(*of)


def piece_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every copy."""
    return encode(docs).select("doc_id", "ids", "n_ids")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("piece_codec", piece_codec),
]

#: SQL can express neither the classifier nor the sample; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), scratch_tables()
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), name)
        drop_scratch(before, last=1)  # a stage's own tables, and its input, once its result is written
    return STAGES[-1][1](spark, docs, sf_dir)
