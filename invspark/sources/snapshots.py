"""Full listings kept as snapshots, and what changed between two of them.

A snapshot holds its keys in ranges, one folder of files each, and a tree of
digests over the ranges. All snapshots of a store use the ranges of the first.
Two snapshots are compared from the root of the tree down, along nodes that
differ only; the rows of ranges with equal digests are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_right

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

FANOUT = 16
#: Ranges of a snapshot; as many numbers and first keys are held by the driver and sent to tasks.
RANGES = 4096
HASHES = ("h1", "h2", "h3", "h4")


def _fields(row: list[str]) -> list[Column]:
    # A null and an empty text differ, and so do neighbours that share their letters otherwise.
    return [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in row]


def _digest(*fields: Column) -> list[Column]:
    return [F.bit_xor(F.xxhash64(F.lit(n), *fields)).alias(name) for n, name in enumerate(HASHES, 1)]


def save(listing: DataFrame, where: str, like: str | None = None, ranges: int = RANGES, key: str = "key") -> None:
    """Write ``listing`` (its keys are unique) as a snapshot at ``where``, in the ranges of the snapshot ``like`` or in new ones.

    New ranges are cut by Spark's range partitioning, about equal in rows. Keys before the first range belong to it, so later
    snapshots may hold any keys. A snapshot written again replaces itself.
    """
    spark = listing.sparkSession
    if like is None:
        placed = listing.repartitionByRange(ranges, key).withColumn("range", F.spark_partition_id())
    else:
        held = read_bounds(spark, like)
        firsts, numbers = [b["first"] for b in held], [b["range"] for b in held]

        def place(keys: pd.Series) -> pd.Series:
            # Strings compare by code points, which is the order of their UTF-8 bytes.
            return pd.Series([numbers[max(0, bisect_right(firsts, k) - 1)] if firsts and k is not None else 0 for k in keys], dtype="int32")

        placed = listing.withColumn("range", F.pandas_udf(place, "int")(F.col(key))).repartition("range")
    placed.write.mode("overwrite").partitionBy("range").parquet(f"{where}/rows")
    rows = _rows(spark, where, listing)
    leaves = rows.groupBy(F.col("range").alias("node")).agg(F.min(key).alias("first"), F.count(F.lit(1)).alias("n"), *_digest(*_fields(listing.columns)))
    leaves.coalesce(1).write.mode("overwrite").parquet(f"{where}/level=0")
    if like is None:
        bounds = spark.read.parquet(f"{where}/level=0").select(F.col("node").alias("range"), "first")
    else:
        bounds = spark.createDataFrame([(b["range"], b["first"]) for b in held], "range int, first string")
    bounds.coalesce(1).write.mode("overwrite").parquet(f"{where}/bounds")
    # Nodes above are numbered alike in all snapshots of a store.
    for level in range(1, levels(ranges)):
        below = spark.read.parquet(f"{where}/level={level - 1}")
        above = below.groupBy(F.floor(F.col("node") / FANOUT).cast("int").alias("node")).agg(F.min("first").alias("first"), F.sum("n").alias("n"), *_digest(F.col("node"), *HASHES))
        above.coalesce(1).write.mode("overwrite").parquet(f"{where}/level={level}")
    spark.range(1).select(F.lit(levels(ranges)).alias("levels")).write.mode("overwrite").parquet(f"{where}/tree")


def levels(ranges: int) -> int:
    return 1 + math.ceil(math.log(max(ranges, 2), FANOUT))


def read_bounds(spark: SparkSession, where: str) -> list:
    """The number and first key of each range, in order; at most as many as the snapshot has ranges."""
    return spark.read.parquet(f"{where}/bounds").orderBy("first").collect()


def _rows(spark: SparkSession, where: str, like: DataFrame) -> DataFrame:
    """A snapshot's rows; with the schema given, no file is opened before its range is wanted."""
    schema = T.StructType([*like.schema.fields, T.StructField("range", T.IntegerType())])
    return spark.read.schema(schema).parquet(f"{where}/rows")


def differing_ranges(spark: SparkSession, old: str, new: str) -> list[int]:
    """The numbers of the ranges whose rows differ, found from the root down; at most as many as there are ranges."""
    deep = min(spark.read.parquet(f"{where}/tree").first()["levels"] for where in (old, new))
    wanted: list[int] | None = None
    for level in range(deep - 1, -1, -1):
        sides = [spark.read.parquet(f"{where}/level={level}").select("node", F.struct("n", *HASHES).alias(name)) for where, name in ((old, "a"), (new, "b"))]
        if wanted is not None:
            sides = [side.filter(F.floor(F.col("node") / FANOUT).cast("int").isin(wanted)) for side in sides]
        found = sides[0].join(sides[1], "node", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("node").collect()
        wanted = sorted(r["node"] for r in found)
        if not wanted:
            return []
    return wanted


def changes(spark: SparkSession, old: str, new: str, schema: DataFrame, key: str = "key") -> DataFrame:
    """(key, change, old, new): what was ``added``, ``removed`` or ``changed`` from one snapshot to the other, with both rows.

    ``schema`` is any frame with the listings' columns. Equal to the full outer join of the two listings, but only ranges that differ
    are read; the join is by range and key, so an uneven range is split like any skewed join.
    """
    columns = schema.columns
    ranges = differing_ranges(spark, old, new)
    sides = []
    for where, name in ((old, "old"), (new, "new")):
        rows = _rows(spark, where, schema).filter(F.col("range").isin(ranges) if ranges else F.lit(False))
        sides.append(rows.select("range", key, F.struct(*[c for c in columns if c != key]).alias(name)))
    both = sides[0].join(sides[1], ["range", key], "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.select(key, change.alias("change"), "old", "new").filter("change is not null")
