"""Filters over listings and object keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import names, paths
from . import ordered


def split_links(listing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links and regular files."""
    return listing.filter("is_link"), listing.filter(~F.col("is_link"))


def exclude_folders(listing: DataFrame, folders: DataFrame, folder: str = "folder", subtree: bool = False, spread: str = "ord") -> DataFrame:
    """Drop files whose folder is in ``folders``; with ``subtree`` also those anywhere below.

    Subtrees are decided once per distinct folder, not once per file.
    """
    if subtree:
        known = listing.select(folder).distinct()
        above = known.withColumn("_above", F.explode(paths.ancestors(F.col(folder))))
        hits = folders.select(F.col(folder).alias("_above")).distinct()
        folders = above.join(hits, "_above", "left_semi").select(folder)
    marked = folders.select(folder).distinct().withColumn("_excluded", F.lit(True))
    return ordered.attach(listing, marked, [folder], spread).filter(F.col("_excluded").isNull()).select(*listing.columns)


def remaining(keys: DataFrame, key: str = "key") -> DataFrame:
    """Objects that are neither an archive nor a manifest."""
    return keys.filter(~names.is_zip(F.col(key)) & ~names.is_manifest(F.col(key)))


def downloadable(keys: DataFrame, key: str = "key") -> DataFrame:
    """Everything but manifests, with a flag for archives to expand."""
    return keys.filter(~names.is_loose_manifest(F.col(key))).withColumn("expand", names.is_loose_zip(F.col(key)))


def root_logs(keys: DataFrame, key: str = "key", **suffixes) -> DataFrame:
    """Log tables at the root of a bucket, with their class."""
    return (
        keys.filter(~F.contains(F.col(key), F.lit("/")))
        .withColumn("log_class", names.log_class(F.col(key), **suffixes))
        .filter(F.col("log_class").isNotNull())
    )


def log_state(key: Column, log: Column, previous: Column) -> Column:
    """Aggregate: 2 when the log is present, 1 when only its previous name is, else 0."""
    return F.coalesce(F.max(F.when(key == log, 2).when(key == previous, 1)), F.lit(0))


def limited(keys: DataFrame, order: str, limit: int) -> DataFrame:
    """The first ``limit`` rows by ``order``; 0 means all."""
    return keys.orderBy(order).limit(limit) if limit else keys


def head(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(order).asc()).limit(n)


def tail(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.col(order).desc()).limit(n)
