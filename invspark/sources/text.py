"""Text logs, manifests and export files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import paths


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, line_no, value): line_no grows down a file and is unique in it, without being dense.

    A line's number is the offset of its split plus its position in the split.
    Every line takes at least a byte, so numbers of one split stay below those
    of the next, and files are read in parallel whatever their size.
    """
    where = [path] if isinstance(path, str) else list(path)
    raw = spark.read.text(where).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_id"),
        "value",
    )
    first = raw.groupBy("file", "_start").agg(F.min("_id").alias("_first"))
    return raw.join(first, ["file", "_start"]).select("file", (F.col("_start") + F.col("_id") - F.col("_first")).alias("line_no"), "value")


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    """(zip_key, text) of the manifests (``*.metadata``) below ``root``; the key is the path from ``root`` without the suffix.

    White space at the ends of a manifest does not belong to its members.
    """
    raw = spark.read.text(root, wholetext=True, recursiveFileLookup=True, pathGlobFilter="*.metadata")
    # File paths are URIs: decoded, and cut behind the root whatever scheme it was given with.
    below = "/" + root.split(":", 1)[-1].strip("/") + "/"
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    key = F.substring(path, F.locate(below, path) + len(below), F.length(path))
    return raw.select(F.regexp_replace(key, "[.]metadata$", "").alias("zip_key"), F.regexp_replace("value", r"^\s+|\s+$", "").alias("text"))


def export_paths(lines: DataFrame, base: str = "", value: str = "value") -> DataFrame:
    """Paths named on the ``path:`` lines of an export file."""
    found = paths.line_path(F.col(value), base + "/" if base else "")
    return lines.withColumn("path", found).filter(F.col("path").isNotNull()).drop(value)
