"""Archive completeness and content audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import manifests
from ..operators import lookups, selection, stats


def explode_members(manifest: DataFrame, distinct: bool = True) -> DataFrame:
    """(zip_key, member, total) of manifests (zip_key, text); unreadable ones give no rows.

    Repeated names are dropped inside the manifest, before any shuffle.
    """
    names = manifests.qualify(manifests.parse(F.col("text")), F.col("zip_key"))
    if distinct:
        names = F.array_distinct(names)
    listed = manifest.select("zip_key", names.alias("_names"))
    return listed.select("zip_key", F.size("_names").cast("long").alias("total"), F.explode("_names").alias("member"))


def existing_members(members: DataFrame, store: DataFrame, key: str = "key", unique: bool = False) -> DataFrame:
    return lookups.present(members, store, "member", key, unique)


def completeness(
    zips: DataFrame, members: DataFrame, store: DataFrame, key: str = "key", unique: bool = False, strict: bool = True, kind: str | None = None,
) -> DataFrame:
    """Per archive: members listed, members found in the store, and two verdicts.

    ``members`` holds distinct (zip_key, member). One left join and one
    aggregation; no manifest means ``extract`` and not ``deletable``. Archives
    and manifests in the store do not count as members found, as they may go
    themselves; ``strict=False`` lets them count. ``kind`` names a column of
    the store with the class of each key (``names.key_class``), if the listing
    keeps one; else keys are classified here.
    """
    if strict:
        store = store.filter(F.col(kind) == "other") if kind else selection.remaining(store, key)
    counted = (
        lookups.membership(members, store, "member", key, unique=unique)
        .groupBy("zip_key")
        .agg(F.count(F.lit(1)).alias("total"), F.count_if("present").alias("found"))
    )
    zero = F.lit(0).cast("long")
    return zips.select("zip_key").join(counted, "zip_key", "left").select(
        "zip_key",
        F.coalesce("total", zero).alias("total"),
        F.coalesce("found", zero).alias("found"),
        F.coalesce(F.col("found") != F.col("total"), F.lit(True)).alias("extract"),
        F.coalesce(F.col("found") == F.col("total"), F.lit(False)).alias("deletable"),
    )


def to_verify(log: DataFrame, verification: DataFrame) -> DataFrame:
    """Logged objects not verified yet; links are not verified."""
    real = log.filter(~F.endswith("DESTINATION_KEY", F.lit(".symlink")))
    return lookups.missing(real, verification, "DESTINATION_KEY", "DESTINATION_KEY")


def audit(log: DataFrame, objects: DataFrame) -> DataFrame:
    """Compare logged checksum and size with the stored objects (key, md5, size)."""
    stored = objects.select(F.col("key").alias("DESTINATION_KEY"), F.col("md5").alias("NEW_CHECKSUM"), F.col("size").alias("SIZE_ON_S3"))
    joined = log.select("DESTINATION_KEY", "CHECKSUM", "FILE_SIZE").join(stored, "DESTINATION_KEY", "left")
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return joined.select(
        "DESTINATION_KEY", "CHECKSUM", same("CHECKSUM", "NEW_CHECKSUM").alias("CHECKSUM_MATCH"), "NEW_CHECKSUM",
        "FILE_SIZE", "SIZE_ON_S3", same("FILE_SIZE", "SIZE_ON_S3").alias("SIZE_MATCH"),
    )


def audit_verdict(verification: DataFrame) -> DataFrame:
    return verification.agg(
        F.count(F.lit(1)).alias("n"),
        stats.all_true(F.col("CHECKSUM_MATCH")).alias("checksums_match"),
        stats.all_true(F.col("SIZE_MATCH")).alias("sizes_match"),
    )
