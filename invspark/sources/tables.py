"""CSV and parquet tables with fixed schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..functions import names, times, units


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str) -> DataFrame:
    """One file, a glob, or a list of paths."""
    where = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("header", True).option("escape", '"').csv(where)


def write_csv(df: DataFrame, path: str, append: bool = False) -> None:
    """Part files below ``path``."""
    df.write.mode("append" if append else "overwrite").option("header", True).option("escape", '"').csv(path)


def read_upload_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Upload log with nulls for ``n/a``, microsecond times, and rows without size or times dropped."""
    raw = read_csv(spark, path, schemas.UPLOAD_LOG.replace("UPLOAD_TIME double", "UPLOAD_TIME string"))
    return typed_log(raw)


def typed_log(raw: DataFrame) -> DataFrame:
    stamp = lambda name: times.micros(times.parse_stamp(F.col(name)))
    return raw.withColumns({
        "start_us": stamp("UPLOAD_START"),
        "end_us": stamp("UPLOAD_END"),
        "UPLOAD_TIME": F.col("UPLOAD_TIME").try_cast("double"),
        "FILES_PER_ZIP": F.col("FILES_PER_ZIP").try_cast("bigint"),
    }).dropna(subset=["start_us", "end_us", "FILE_SIZE"])


def transfers(log: DataFrame, site_labels: dict[str, str] | None = None) -> DataFrame:
    """Log rows with type, compression flag, site, workers, threads and rates derived from names."""
    run, kind = F.col("BUCKET_NAME"), names.transfer_type(F.col("LOCAL_PATH"))
    return log.withColumns({
        "kind": kind,
        "compressed": names.compression_used(kind, run),
        "site": names.relabel(names.site(run), site_labels or {}),
        "workers": names.workers(run),
        "threads": names.threads(run),
        "gibit_s": units.gibit_rate(F.col("FILE_SIZE"), F.col("UPLOAD_TIME")),
        "rate": units.milli_rate(F.col("FILE_SIZE"), F.col("end_us") - F.col("start_us")),
    })


def write_plan(df: DataFrame, path: str, schema: str) -> None:
    """Parquet hand-off between jobs, cast to its declared schema."""
    from pyspark.sql.types import StructType

    fields = StructType.fromDDL(schema).fields
    df.select([F.col(f.name).cast(f.dataType) for f in fields]).write.mode("overwrite").parquet(path)


def read_plan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Add a job's rows to the upload log in one commit."""
    rows.write.mode("append").parquet(path)
