"""Feeds as streams: deduplication within a watermark, and keyed upserts batch by batch. The batch operators stay the ones that decide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrasift.operators.joins import upsert


def first_within(stream: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """D01 on a stream: the first row of a key, for keys that come again within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def upsert_into(path: str, keys: list[str], overwrite: bool = False, order: str | None = None):
    """K11 on a stream: for foreachBatch; each batch writes a new version of the table from the one before, so that a batch that is run again gives the same version.

    Of a batch's rows with one key the last by ``order`` counts, else the largest by all its columns, whatever order they arrive in. If a
    version is missing although batches came before, that is an error: going on from nothing would lose what it held.
    """

    def run(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fs_path = spark._jvm.org.apache.hadoop.fs.Path
        fs = fs_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        old = f"{path}/version-{number - 1}"
        row = F.struct(*(F.col(f"`{c}`") for c in batch.columns))
        new = batch.groupBy(*keys).agg(F.max_by(row, F.struct(order, F.to_json(row)) if order else F.to_json(row)).alias("_r")).select("_r.*")
        if number and not fs.exists(fs_path(old)):
            raise FileNotFoundError(f"{old} is missing: batch {number} can't be applied")
        whole = upsert(spark.read.parquet(old), new, keys, overwrite) if number else new
        whole.write.mode("overwrite").parquet(f"{path}/version-{number}")

    return run
