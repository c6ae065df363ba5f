"""Large objects in segments: cutting them for upload, and auditing them by a two-level checksum."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, functions as F

from ..functions import values
from ..session import dealt

SEGMENT = 2 * 1024**3


def segments(objects: DataFrame, segment: int = SEGMENT, threshold: int | None = None, key: str = "key", size: str = "size") -> DataFrame:
    """Byte ranges of each object; one range for objects up to ``threshold``."""
    limit = segment if threshold is None else threshold
    count = F.when(F.col(size) > limit, F.ceil(F.col(size) / F.lit(segment))).otherwise(1).cast("long")
    rows = objects.select(key, size, count.alias("n_segments"), F.explode(F.sequence(F.lit(0).cast("long"), count - 1)).alias("_i"))
    whole = F.col("n_segments") == 1
    return rows.select(
        key, "n_segments", (F.col("_i") + 1).alias("segment"),
        (F.col("_i") * segment).alias("start"),
        F.when(whole, F.col(size)).otherwise(F.least((F.col("_i") + 1) * segment, F.col(size))).alias("end"),
    )


def digests(ranges: DataFrame) -> DataFrame:
    """(key, segment, start, end, md5, error) of byte ranges (key, segment, start, end, path), read block by block.

    Segments of one object are dealt over all tasks. A range that the file does not reach, or that cannot be read, has an
    ``error`` and no digest.
    """
    # The archive jobs cut by segments as well, so they import this module.
    from .archive import BLOCK, open_path

    def digest(batches):
        for batch in batches:
            found, failed = [], []
            for path, start, end in batch[["path", "start", "end"]].itertuples(index=False):
                md5, left = hashlib.md5(), end - start
                try:
                    system, name = open_path(path)
                    with system.open_input_file(name) as source:
                        source.seek(start)
                        while left and (block := source.read(min(left, BLOCK))):
                            md5.update(block)
                            left -= len(block)
                    error = "EndsEarly" if left else None
                except OSError as problem:
                    error = type(problem).__name__
                found.append(None if error else md5.hexdigest())
                failed.append(error)
            yield batch[["key", "segment", "start", "end"]].assign(md5=found, error=failed)

    rows = dealt(ranges.select("key", "segment", "start", "end", "path"), "key", "segment")
    return rows.mapInPandas(digest, "key string, segment long, start long, end long, md5 string, error string")


def two_level(parts: DataFrame) -> DataFrame:
    """(key, n_segments, etag) from (key, segment, md5): the checksum that a store gives an object sent in these segments.

    A list holds the digests of one object, so its length is bounded by the object's size over the segment's. An object with a
    missing digest has none itself.
    """
    listed = parts.groupBy("key").agg(F.count("md5").alias("_known"), F.count(F.lit(1)).alias("n_segments"), F.array_sort(F.collect_list(F.struct("segment", "md5"))).alias("_held"))
    etag = values.joined_etag(F.transform("_held", lambda part: part["md5"]), F.col("n_segments"))
    return listed.select("key", "n_segments", F.when(F.col("_known") == F.col("n_segments"), etag).alias("etag"))


def compare(logged: DataFrame, stored: DataFrame) -> DataFrame:
    """(key, segment, start, end, logged_md5, md5, error): the logged segments (key, segment, start, end, md5), and the same ranges of the
    stored objects (key, path) as they are now. Objects that are not stored have the error ``missing``."""
    sent = logged.withColumnRenamed("md5", "logged_md5")
    found = digests(sent.join(stored.select("key", "path"), "key")).drop("start", "end")
    return sent.join(found, ["key", "segment"], "left").select(
        "key", "segment", "start", "end", "logged_md5", "md5", F.when(F.col("md5").isNull(), F.coalesce("error", F.lit("missing"))).alias("error")
    )


def differing(compared: DataFrame) -> DataFrame:
    """The segments to send again: those that differ, and those that could not be read."""
    return compared.filter(~F.col("logged_md5").eqNullSafe(F.col("md5")))


def audit(compared: DataFrame, stored: DataFrame) -> DataFrame:
    """One verdict per logged object, from what ``compare`` returned (a written table) and the store's listing (key, size, etag).

    (key, n_segments, n_differing, logged_etag, etag, verdict). Contents are compared segment by segment in the logged cut, so a store
    may have cut the object anew. Verdicts: ``missing``; ``unreadable``; ``altered`` when a segment or the size differs; with equal
    contents ``same`` when the store's etag is the two-level checksum of the log, ``re-cut`` when it counts other segments, else
    ``etag differs`` (cut at other places, or a wrong etag).
    """
    same = F.col("logged_md5") == F.col("md5")
    sums = compared.groupBy("key").agg(
        F.count_if(~F.coalesce(same, F.lit(False))).alias("n_differing"), F.max("end").alias("_logged_size"),
        F.count_if(F.col("error").isNotNull() & ~F.col("error").isin("missing", "EndsEarly")).alias("_unread"),
    )
    logged = two_level(compared.select("key", "segment", F.col("logged_md5").alias("md5"))).withColumnRenamed("etag", "logged_etag")
    verdict = (
        F.when(F.col("size").isNull(), "missing")
        .when(F.col("_unread") > 0, "unreadable")
        .when((F.col("n_differing") > 0) | (F.col("size") != F.col("_logged_size")), "altered")
        .when(F.col("etag") == F.col("logged_etag"), "same")
        .when(values.segment_count(F.col("etag")) != F.col("n_segments"), "re-cut")
        .otherwise("etag differs")
    )
    there = stored.select("key", F.coalesce("size", F.lit(-1).cast("long")).alias("size"), "etag")
    return logged.join(sums, "key").join(there, "key", "left").select("key", "n_segments", "n_differing", "logged_etag", "etag", verdict.alias("verdict"))
