"""Joins between listings, manifests, logs and the store.

Object keys are unique in a store, so lookups are plain equi-joins: Spark
broadcasts the small side when its size allows and otherwise shuffles, with
AQE splitting skewed partitions. Where the looked-up keys may repeat they are
made distinct first; that reuses the shuffle of the join and collapses hot
duplicates map-side. ``unique=True`` says a listing holds each key once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import names, values
from ..session import materialise, shuffles_for


def key_set(df: DataFrame, column: str, name: str, unique: bool = False) -> DataFrame:
    keys = df.select(F.col(column).alias(name)).filter(F.col(name).isNotNull())
    return keys if unique else keys.distinct()


def missing(df: DataFrame, other: DataFrame, on: str, other_key: str = "key", unique: bool = False) -> DataFrame:
    """Rows whose ``on`` is not among the other table's keys."""
    return df.join(key_set(other, other_key, on, unique), on, "left_anti")


def present(df: DataFrame, other: DataFrame, on: str, other_key: str = "key", unique: bool = False) -> DataFrame:
    """Rows whose ``on`` is among the other table's keys."""
    return df.join(key_set(other, other_key, on, unique), on, "left_semi")


def membership(df: DataFrame, other: DataFrame, on: str, other_key: str = "key", name: str = "present", unique: bool = False) -> DataFrame:
    """All rows, with a flag telling whether ``on`` is among the other table's keys."""
    known = key_set(other, other_key, on, unique).withColumn("_known", F.lit(True))
    return df.join(known, on, "left").withColumn(name, F.col("_known").isNotNull()).drop("_known")


def fold_flag(df: DataFrame, flags: DataFrame, on: str, flag: str, default: bool = False) -> DataFrame:
    """Bring a per-key flag back to all rows; keys without one get the default."""
    return df.join(flags.select(on, flag), on, "left").withColumn(flag, F.coalesce(flag, F.lit(default)))


def missing_local(df: DataFrame, local: DataFrame, key: str = "key", local_key: str = "path") -> DataFrame:
    """Objects without a local file of that (trimmed) name."""
    trimmed = df.withColumn("_trim", F.trim(key))
    return missing(trimmed, local, "_trim", local_key).drop("_trim")


def unverified_logs(keys: DataFrame, key: str = "key", **suffixes) -> DataFrame:
    """Logs (current or previous name) whose verification table does not exist."""
    kind = names.log_class(F.col(key), **suffixes)
    logs = keys.filter(kind.isin("log", "previous log")).withColumn("twin", names.verification_twin(F.col(key), **suffixes))
    return missing(logs, keys.filter(kind == "verification"), "twin", key)


def orphan_manifests(keys: DataFrame, key: str = "key") -> DataFrame:
    """Manifests whose archive is no longer in the store."""
    notes = keys.filter(names.is_manifest(F.col(key))).withColumn("zip_key", F.regexp_replace(key, "[.]metadata$", ""))
    return missing(notes, keys.filter(names.is_zip(F.col(key))), "zip_key", key)


def sync_decision(members: DataFrame, remote: DataFrame) -> DataFrame:
    """What to do with each unpacked member (key, md5) given the store (key, etag).

    Members may bring ``segmented_etag``, their two-level checksum in the cut the sender uses: an object stored in as many segments is
    then compared like any other, and one in another number of segments stays ``skip segmented``.
    """
    there = remote.select("key", "etag")
    decision = F.when(F.col("etag").isNull(), "upload").when(F.col("etag") == F.col("md5"), "skip")
    if "segmented_etag" in members.columns:
        own = F.col("segmented_etag")
        decision = decision.when(F.col("etag") == own, "skip").when(values.is_segmented(F.col("etag")) & (values.segment_count(F.col("etag")) == values.segment_count(own)), "replace")
    decision = decision.when(values.is_segmented(F.col("etag")), "skip segmented").otherwise("replace")
    return members.join(there, "key", "left").withColumn("decision", decision)


def fingerprint(member: Column) -> list[Column]:
    """Aggregates that agree for equal sets of distinct names, in any order: their number, and 256 bits of hashes combined by XOR."""
    wide = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), member))
    return [F.count(F.lit(1)).alias("n"), *[wide(seed).alias(f"h{seed}") for seed in (1, 2, 3, 4)]]


def matching_manifests(folders: DataFrame, manifests: DataFrame, rows: int = 0) -> DataFrame:
    """Folders (folder, member) whose file set equals that of some archive (zip_key, member).

    Sets are compared through order-free fingerprints, summed up map-side, so
    members are neither collected nor joined; two different sets agree by a
    chance of 2**-256. Both inputs hold distinct rows and are read once.
    ``rows`` is about the larger input's number of rows: the number of tasks
    follows it, so that the tables of a task do not grow with the inputs.
    Returns (folder, zip_key), the smallest key; a written table.
    """
    mark = ["n", "h1", "h2", "h3", "h4"]
    sets = folders.groupBy("folder").agg(*fingerprint(F.col("member")))
    archives = manifests.groupBy("zip_key").agg(*fingerprint(F.col("member"))).groupBy(*mark).agg(F.min("zip_key").alias("zip_key"))
    with shuffles_for(folders.sparkSession, rows):
        return materialise(sets.join(archives, mark).select("folder", "zip_key"), "matching")


def verified_folders(logged: DataFrame, local: DataFrame) -> DataFrame:
    """Per folder: are the logged files exactly the local ones? Inputs are (folder, name).

    One aggregation over the tagged union instead of a join.
    """
    tagged = logged.select("folder", "name", F.lit(1).alias("_log"), F.lit(0).alias("_disk")).unionByName(
        local.select("folder", "name", F.lit(0).alias("_log"), F.lit(1).alias("_disk"))
    )
    each = tagged.groupBy("folder", "name").agg(F.max("_log").alias("_log"), F.max("_disk").alias("_disk"))
    return (
        each.groupBy("folder")
        .agg(
            F.sum("_log").alias("n_logged"),
            F.sum("_disk").alias("n_local"),
            F.sum(F.col("_log") * F.col("_disk")).alias("n_both"),
        )
        .filter("n_logged > 0")
        .withColumn("verified", (F.col("n_logged") == F.col("n_both")) & (F.col("n_local") == F.col("n_both")))
    )


def complete_folders(files: DataFrame, store: DataFrame, folder: str = "folder", key: str = "object_name") -> DataFrame:
    """Per folder: how many files the store holds, and whether it holds them all."""
    return (
        membership(files, store, key)
        .groupBy(folder)
        .agg(F.count(F.lit(1)).alias("n_files"), F.count_if("present").alias("n_present"), F.bool_and("present").alias("skip"))
    )


def speed_up(runs: DataFrame, on: list[str], workers: str = "n_procs", rate: str = "rate") -> DataFrame:
    """Total rate of each run over that of the single-worker run of the same group."""
    single = runs.filter(F.col(workers) == 1).groupBy(*on).agg(F.avg(rate).alias("_single"))
    return runs.join(single, on).withColumn(
        "speed_up", F.when(F.col("_single") != 0, F.col(rate) * F.col(workers) / F.col("_single"))
    ).drop("_single")
