"""Planning an upload: what is missing, how it travels, what each archive holds."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F

from ..operators import batching, lookups
from ..session import materialise


def upload_plan(listing: DataFrame, store: DataFrame, max_archive: int, collate: bool = True) -> DataFrame:
    """Listed files the store lacks, each marked ``file`` or ``zip``."""
    todo = lookups.missing(listing, store, "object_name")
    return todo.withColumn("type", batching.route(F.col("size"), max_archive, collate))


def archive_plan(plan: DataFrame, dest: str, max_archive: int, max_count: int, rows_per_part: int = batching.ROWS_PER_PART) -> DataFrame:
    """One row per archive to build."""
    small = plan.filter(F.col("type") == "zip").select("ord", "path", "object_name", "size")
    return batching.roll_up(batching.assign_batches(small, max_archive, max_count, rows_per_part), dest)


def still_to_build(archives: DataFrame, store: DataFrame) -> DataFrame:
    """Archives the store does not hold yet, compared by their full key."""
    return lookups.missing(archives, store, "zip_key")


def still_to_send(plan: DataFrame, packed_members: DataFrame) -> DataFrame:
    """Single files that no archive contains."""
    alone = plan.filter(F.col("type") == "file")
    return lookups.missing(alone, packed_members, "object_name", "member")


def resume(archives_path: str, fresh, store: DataFrame) -> DataFrame:
    """Remaining work of a plan: the saved table when there is one, else ``fresh()`` saved now.

    Part files appear when their job commits; a folder without any holds no plan.
    """
    try:
        plan = store.sparkSession.read.parquet(archives_path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        plan = materialise(fresh(), "plan", archives_path)
    return still_to_build(plan, store)
