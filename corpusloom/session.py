"""Session construction and table access shared by the whole library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def build_session(app: str = "corpusloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` overrides any setting (dots written as `__`)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.parquet.compression.codec": "zstd",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables below `sf_dir`, any store that Spark reads."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, per_core: int = 32 << 20) -> DataFrame:
    """`df` dealt to all cores if, by the planner's estimate, it has under `per_core` bytes for each; as it is otherwise.

    A small table may be one row group, which one core reads: what follows then has all of them. A large one
    is split by its files and is never shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * per_core else df
