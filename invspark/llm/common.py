"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from invspark.session import materialise, shared_dir

__all__ = ["BLANK", "batches", "folder_uri", "materialise", "outside", "read", "running", "shared_dir", "uniform"]

#: Space, tab, line feed, vertical tab, form feed and carriage return: what separates words.
BLANK = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def folder_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, as a URI that any file system library can open."""
    place = shared_dir(spark, name)
    if "://" in place:
        return place
    return "file://" + place.removeprefix("file:")


def outside(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` that do not clash with ``names`` (Spark compares names without case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def batches(rows: Iterator, size, most: int = 4 << 20, count: int = 2000) -> Iterator[list]:
    """Cut a stream of rows into lists of at most ``count`` rows and about ``most`` bytes."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row)
        if total >= most or len(held) >= count:
            yield held
            held, total = [], 0
    if held:
        yield held


def uniform(key: str, *columns):
    """A column of numbers in [0, 1), fixed by ``key`` and the values of ``columns`` (52 bits of an MD5)."""
    from pyspark.sql import functions as F

    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws("/", F.lit(key), *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def running(sizes: str):
    """An array column: for each element of the array column ``sizes`` (a name) the sum of all before it.

    Arrays grow by copying, so sums are made within pieces of 256 elements and over the pieces' totals: n to the
    power of 1.5 instead of its square.
    """
    from pyspark.sql import functions as F

    zero, piece = F.lit(0).cast("long"), 256

    def summed(values, start):
        return F.aggregate(
            values,
            F.struct(start.alias("s"), F.array().cast("array<bigint>").alias("out")),
            lambda a, x: F.struct((a["s"] + x).alias("s"), F.concat(a["out"], F.array(a["s"])).alias("out")),
            lambda a: a["out"],
        )

    last = F.greatest(F.ceil(F.size(sizes) / piece), F.lit(1)) - 1
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.slice(F.col(sizes), (i * piece + 1).cast("int"), F.lit(piece)))
    totals = F.transform(pieces, lambda p: F.aggregate(p, zero, lambda a, x: a + x))
    zipped = F.zip_with(pieces, summed(totals, zero), lambda p, s: F.struct(p.alias("p"), s.alias("s")))
    return F.flatten(F.transform(zipped, lambda z: summed(z["p"], z["s"])))
