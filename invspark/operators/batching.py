"""Routing files and packing small ones into archives by size and count."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from ..functions import paths

ROWS_PER_PART = 100_000
IDS_PER_PART = 1_000_000
MAX_ARCHIVE = 1024**3


def members_limit(workers: int, open_files: int = 10_000, margin: int = 10, least: int = 50) -> int:
    """Most members per archive so that all workers together stay within the open-file budget."""
    return max(least, open_files // workers - margin)


def route(size: Column, max_size: int, collate: bool = True) -> Column:
    """``zip`` for files up to half an archive (inclusive), else ``file``."""
    if not collate:
        return F.lit("file")
    return F.when(size <= F.lit(max_size / 2), "zip").otherwise("file")


def _next_fit(sizes: np.ndarray, max_size: int, max_count: int) -> np.ndarray:
    """Archive number of each row: a new one starts when the row would not fit.

    An archive that holds no bytes yet takes any row, so leading empty files
    share an archive with an oversize one.
    """
    total = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(len(sizes), dtype=np.int64)
    start, number = 0, 0
    while start < len(sizes):
        end = int(np.searchsorted(total, total[start] + max_size, side="right")) - 1
        if total[end] == total[start]:
            end += 1
        end = min(end, start + max_count, len(sizes))
        out[start:end] = number
        start, number = end, number + 1
    return out


def assign_batches(
    df: DataFrame, max_size: int, max_count: int, rows_per_part: int = ROWS_PER_PART,
    ord_col: str = "ord", size_col: str = "size",
) -> DataFrame:
    """Add ``part``, ``batch`` (within the part) and ``id`` (over all parts).

    The fold is sequential only inside a part, and a part covers
    ``rows_per_part`` consecutive ``ord`` values, so a group never holds more
    rows than that and parts run in parallel.
    """
    # A size that could not be read counts as 0.
    sized = df.withColumn(size_col, F.coalesce(F.col(size_col), F.lit(0).cast(df.schema[size_col].dataType)))
    ready = sized.withColumn("part", F.floor(F.col(ord_col) / rows_per_part).cast("long"))
    # Whole rows go through the fold, as Arrow columns: they are shuffled once, and nothing is computed twice or joined back.
    schema = T.StructType([*ready.schema.fields, T.StructField("batch", T.LongType(), False)])

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by(ord_col)
        ids = _next_fit(table[size_col].to_numpy(), max_size, max_count)
        return table.append_column(pa.field("batch", pa.int64(), nullable=False), pa.array(ids))

    out = ready.groupBy("part").applyInArrow(fold, schema)
    return out.select(*ready.columns, "batch").withColumn("id", F.col("part") * IDS_PER_PART + F.col("batch"))


def assign_batches_skipping(df: DataFrame, individual: Column, max_size: int, rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Older numbering: rows sent on their own get batch 0, the others batches from 1 within their part."""
    tagged = df.withColumn("individual", individual)
    packed = assign_batches(tagged.filter(~F.col("individual")), max_size, rows_per_part, rows_per_part)
    alone = tagged.filter("individual").withColumn("part", F.floor(F.col("ord") / rows_per_part).cast("long"))
    return packed.withColumn("batch", F.col("batch") + 1).drop("id").unionByName(
        alone.withColumn("batch", F.lit(0).cast("long"))
    )


def roll_up(batched: DataFrame, dest: str) -> DataFrame:
    """One row per archive with its members in listing order.

    The list is bounded by the ``max_count`` the batches were made with.
    """
    member = F.struct("ord", "path", "object_name", "size")
    return (
        batched.groupBy("id")
        .agg(
            F.array_sort(F.collect_list(member)).alias("members"),
            F.count(F.lit(1)).alias("n_members"),
            F.sum("size").alias("size"),
        )
        .select("id", paths.archive_key(F.col("id"), dest).alias("zip_key"), "members", "n_members", "size")
    )


def joined_names(members: Column, field: str, separator: str = "|") -> Column:
    """Text form of a member list."""
    return F.array_join(F.transform(members, lambda m: m[field]), separator)


def over_limit(batched: DataFrame, max_size: int, max_count: int) -> DataFrame:
    """Archives that break a limit; a single oversize file (with empty ones before it) is allowed."""
    return (
        batched.groupBy("id")
        .agg(
            F.sum("size").alias("size"),
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col("size") > 0).cast("long")).alias("n_filled"),
        )
        .filter(((F.col("size") > max_size) & (F.col("n_filled") > 1)) | (F.col("n") > max_count))
    )
