"""Rows of the upload log, as the sending jobs append them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import manifests, paths


def _stamp(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def _rows(sent: DataFrame, bucket: str, key: str, contents: Column, count: Column, unknown: str) -> DataFrame:
    start, end = F.col("start_us"), F.col("end_us")
    known = start.isNotNull() & end.isNotNull()
    seconds = F.format_string("%.6f", (end - start) / 1e6)
    return sent.select(
        paths.parent_dir(F.col("path")).alias("LOCAL_FOLDER"),
        F.col("path").alias("LOCAL_PATH"),
        F.col("size").alias("FILE_SIZE"),
        F.lit(bucket).alias("BUCKET_NAME"),
        F.col(key).alias("DESTINATION_KEY"),
        F.col("md5").alias("CHECKSUM"),
        contents.alias("ZIP_CONTENTS"),
        count.alias("FILES_PER_ZIP"),
        F.when(known, seconds).otherwise(unknown).alias("UPLOAD_TIME"),
        F.when(known, _stamp(start)).otherwise(unknown).alias("UPLOAD_START"),
        F.when(known, _stamp(end)).otherwise(unknown).alias("UPLOAD_END"),
    )


def file_rows(sent: DataFrame, bucket: str) -> DataFrame:
    """One row per single file (path, object_name, size, md5, start_us, end_us); what is unknown reads ``n/a``."""
    return _rows(sent, bucket, "object_name", F.lit("n/a"), F.lit("n/a"), "n/a")


def archive_rows(sent: DataFrame, bucket: str) -> DataFrame:
    """One row per archive (path, zip_key, size, md5, members, start_us, end_us): up to five member names, and their number."""
    return _rows(sent, bucket, "zip_key", manifests.abbreviate(F.col("members")), F.size("members").cast("string"), "")


def packed_rows(packed: DataFrame, root: str, bucket: str) -> DataFrame:
    """Log rows of what ``archive.pack_files`` returned for archives below ``root``, with its own start and end times."""
    names = F.filter(F.split("members", "[|]"), lambda name: name != "")
    return archive_rows(packed.select(F.concat(F.lit(root + "/"), "zip_key").alias("path"), "zip_key", "size", "md5", names.alias("members"), "start_us", "end_us"), bucket)
