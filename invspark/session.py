"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# Settings the jobs are written for. On a cluster they belong in spark-defaults.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, name: str = "invspark", **conf) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in {**RECOMMENDED, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the one the cluster names in ``spark.checkpoint.dir``.

    Without that setting a session uses its warehouse, if that is set or all runs on one machine; else there is no folder
    that all executors reach.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local") and not context.getConf().contains("spark.sql.warehouse.dir"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_work")
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}")


def mounted_dir(spark: SparkSession, name: str) -> str:
    """The same as a path of a mounted folder, for jobs that walk a tree or write in place."""
    place = shared_dir(spark, name)
    if place.startswith("file:"):
        return "/" + place.removeprefix("file:").lstrip("/")
    if "://" in place:
        raise RuntimeError(f"{place} is not a mounted folder")
    return place


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """Rows dealt by columns to as many tasks as shuffles have.

    For rows that name files: they are small and their work is not, so the number of tasks must not follow from their bytes, as
    after ``repartition`` by columns alone, where adaptive execution gives a megabyte of names to one task. Rows go by a hash of the
    columns: by the columns themselves Spark would leave a grouping by them as it is, and coalesce that.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64(*columns))


#: Rows that a task of ``spread`` gets, about.
SPREAD_ROWS = 500_000


def spread(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """``df`` of about ``rows`` rows dealt by columns to as many tasks as shuffles have, or to more, so that none gets many more than ``SPREAD_ROWS``.

    For groupings that hold next to every row, as of distinct rows: their tables take the memory of a task in proportion to its rows, on
    either side of a shuffle. Behind this they have no side before it, and the number of tasks follows from the input.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, -(-rows // SPREAD_ROWS)), *columns)


@contextmanager
def shuffles_for(spark: SparkSession, rows: int):
    """Jobs run within it shuffle to a partition per ``SPREAD_ROWS`` of ``rows``, if those are more than the session's; adaptive execution joins small ones."""
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(int(before), -(-rows // SPREAD_ROWS))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialise(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once as parquet and read it back: a stable cut in the lineage."""
    target = path or shared_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(target)
    return df.sparkSession.read.schema(df.schema).parquet(target)
