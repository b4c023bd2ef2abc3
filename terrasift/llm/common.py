"""What several operators share: reading tables, words, and the engine's way of cutting lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrasift.operators.lineage import cut, drop_scratch, release, scratch_folder, shared_dir  # noqa: F401

#: Characters that separate words in every contract of this package: space and tab to carriage return.
SPACES = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; none for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))


def ascii_lower(text: Column) -> Column:
    """Lower-case A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
