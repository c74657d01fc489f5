"""Intermediate tables in the folder that the cluster shares (spark.checkpoint.dir)."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_kept: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only in local mode, where that may be unset (as in tests), one of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` as a Parquet table in the shared folder and read it again.

    Cuts the lineage: the table outlives any executor. It goes when `release` is given the
    DataFrame, or at the end of the process.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    _kept.append((spark, path))
    if not partition_by:
        out = spark.read.schema(schema).parquet(path)
    else:
        out = spark.read.parquet(path)
    out._scratch_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the table behind a DataFrame of `materialize` that nothing reads any more."""
    path = getattr(df, "_scratch_path", None)
    if path:
        _delete(df.sparkSession, path)
        _kept[:] = [x for x in _kept if x[1] != path]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _delete_all() -> None:
    for spark, path in _kept:
        if spark.sparkContext._jsc is None:
            continue
        try:
            _delete(spark, path)
        except Exception:  # the session's JVM may be gone already; the folder is temporary
            return
