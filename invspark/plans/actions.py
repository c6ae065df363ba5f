"""Action tables: what a clean-up, move or download would do, one row per object.

A dry run is the table itself. ``plans.archive.apply_actions`` carries one out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import names
from ..operators import lookups, ordered, selection


def _action(action: Column | str, key: str, reason: Column, target: Column | None = None) -> list[Column]:
    text = F.lit(None).cast("string")
    return [
        (F.lit(action) if isinstance(action, str) else action).alias("action"),
        F.col(key).alias("key"),
        (text if target is None else target).alias("target"),
        reason.alias("reason"),
    ]


def delete_archives(verdicts: DataFrame) -> DataFrame:
    """Delete complete archives, then their manifests; keep and name the others.

    One row per archive: ``target`` is its manifest, which goes only after the archive has gone.
    """
    ok = F.coalesce(F.col("deletable"), F.lit(False))
    reason = F.when(ok, "all members in store").when(F.col("total") == 0, "no readable manifest").otherwise("members missing")
    manifest = F.when(ok, F.concat("zip_key", F.lit(".metadata")))
    return verdicts.select(*_action(F.when(ok, "delete").otherwise("keep"), "zip_key", reason, manifest)).withColumnRenamed("zip_key", "key")


def delete_orphans(keys: DataFrame, key: str = "key") -> DataFrame:
    return lookups.orphan_manifests(keys, key).select(*_action("delete", key, F.lit("archive is gone")))


def delete_listed(keys: DataFrame, prefix: str = "", key: str = "key") -> DataFrame:
    """Bulk delete of everything below a prefix, with columns for the outcome of each row."""
    rows = keys.filter(F.startswith(key, F.lit(prefix))) if prefix else keys
    none = F.lit(None).cast("string")
    return rows.select(*_action("delete", key, F.lit("listed")), none.alias("status"), none.alias("error"))


def move(keys: DataFrame, destination: str, key: str = "key") -> DataFrame:
    """Copies to another container; the originals go only after ``delete_copied``."""
    return keys.select(*_action("copy", key, F.lit("move"), F.concat(F.lit(destination + "/"), F.col(key))))


def delete_copied(copies: DataFrame, results: DataFrame) -> DataFrame:
    """Delete the originals of copies whose result (key, status) is ``done``."""
    done = results.filter(F.col("status") == "done")
    return lookups.present(copies, done, "key").select(*_action("delete", "key", F.lit("copied")))


def download(keys: DataFrame, local: DataFrame, key: str = "key", local_key: str = "path") -> DataFrame:
    """Objects to fetch: no manifests, nothing already here; archives are marked for extraction."""
    todo = lookups.missing_local(selection.downloadable(keys, key), local, key, local_key)
    return todo.select(*_action(F.when(F.col("expand"), "fetch and extract").otherwise("fetch"), key, F.lit("not present")))


def retention(logs: DataFrame, now_us: Column, min_keep: int = 2, min_age_days: int = 2, pattern: str = r"^backup-logs-.*[.]csv$") -> DataFrame:
    """Old log files to remove per folder, when more than ``min_keep`` exist and would remain."""
    day = 86_400_000_000
    mine = logs.filter(F.rlike("name", F.lit(pattern))).withColumn("old", F.call_function("div", now_us - F.col("modified_us"), F.lit(day)) >= min_age_days)
    counts = mine.groupBy("folder").agg(F.count(F.lit(1)).alias("_n"), F.count_if("old").alias("_n_old"))
    allowed = counts.filter((F.col("_n") > min_keep) & (F.col("_n_old") > 0) & (F.col("_n") - F.col("_n_old") > min_keep))
    marked = ordered.attach(mine.filter("old"), allowed, ["folder"], "name").filter(F.col("_n").isNotNull())
    return marked.withColumn("_path", F.concat("folder", F.lit("/"), "name")).select(*_action("delete", "_path", F.lit("old log")))


def with_plan_id(actions: DataFrame, plan_id: str) -> DataFrame:
    """Key the rows so that a rerun can tell which were done: (plan_id, key)."""
    return actions.withColumn("plan_id", F.lit(plan_id))


def undone(actions: DataFrame, results: DataFrame) -> DataFrame:
    """Actions of a plan that no earlier run finished."""
    done = results.filter(F.col("status") == "done").select("plan_id", "key", "action").distinct()
    return actions.join(done, ["plan_id", "key", "action"], "left_anti")


def report(keys: DataFrame, contents: DataFrame, key: str = "key") -> DataFrame:
    """Key, MiB, date and archive contents (``n/a`` when there are none)."""
    notes = contents.select(F.col("zip_key").alias(key), F.col("text").alias("_text"))
    return keys.join(notes, key, "left").select(
        key, F.round(F.col("size") / 1048576.0, 2).alias("mib"), "modified_us", F.coalesce("_text", F.lit("n/a")).alias("contents")
    )
