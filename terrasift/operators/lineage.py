"""Cutting a plan's lineage by a table in the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where it names none: one of this machine if Spark runs on this machine alone, else an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="terrasift-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def cut(df: DataFrame, name: str = "part") -> DataFrame:
    """Write df as a table in the shared folder and read it back: its lineage ends there, and a lost executor costs no recomputation.

    The table is removed when the driver's Python ends, as a returned DataFrame may still read it until then, or by drop_scratch().
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/terrasift/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _scratch.append((spark, path))
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for files that are not tables; it is removed as the tables of cut() are."""
    path = f"{shared_dir(spark)}/terrasift/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def _remove(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(df: DataFrame) -> None:
    """Remove the table behind a DataFrame that cut() returned: nothing may read it any more. Others are left alone."""
    path = df.__dict__.get("scratch_path")
    for k, (spark, found) in enumerate(_scratch):
        if found == path:
            del _scratch[k]
            return _remove(spark, path)


def scratch_tables() -> int:
    """How many tables of cut() there are."""
    return len(_scratch)


def drop_scratch(keep: int = 0, last: int = 0) -> None:
    """Remove the tables that cut() wrote, but for the first ``keep`` and the latest ``last``."""
    gone = _scratch[keep : len(_scratch) - last]
    _scratch[keep : len(_scratch) - last] = []
    for spark, path in reversed(gone):
        try:
            _remove(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before
            return


atexit.register(drop_scratch)
