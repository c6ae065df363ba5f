"""Following symbolic links inside a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import materialise
from . import ordered


def resolve(links: DataFrame) -> DataFrame:
    """(path, target) with every target followed to a path that is not a link; null for cycles.

    Pointer doubling: each round composes the map with itself, so a chain of n
    links takes log2(n) rounds, whatever its length. What still moves after as
    many rounds as the longest possible chain needs goes round in a cycle.
    Rounds are written out, or the plan would double too. Many links may share
    one target, hence the salted join.
    """
    current, moving, rounds = links.select("path", F.col("link_target").alias("target")), True, 0
    most = links.count().bit_length() + 1
    while moving and rounds < most:
        step = current.select(F.col("path").alias("target"), F.col("target").alias("_next"), F.lit(True).alias("_is_link"))
        jumped = ordered.attach(current, step, ["target"], "path", salts=8)
        still_link = F.coalesce(F.col("_is_link"), F.lit(False))
        jumped = materialise(jumped.select("path", F.when(still_link, F.col("_next")).otherwise(F.col("target")).alias("target"), still_link.alias("moved")), "links")
        current, rounds = jumped.select("path", "target"), rounds + 1
        moving = not jumped.filter("moved").isEmpty()
    return jumped.select("path", F.when(~F.col("moved"), F.col("target")).alias("target")) if moving and rounds else current


def follow(listing: DataFrame) -> DataFrame:
    """Listing with links replaced by the files they lead to, under the link's own object name.

    Links without a target are dropped; sizes of followed links are those of the target when it is listed.
    """
    links, files = listing.filter("is_link"), listing.filter(~F.col("is_link"))
    found = resolve(links).filter(F.col("target").isNotNull())
    sizes = files.select(F.col("path").alias("target"), F.col("size").alias("_size"))
    # Each target's size once, then back to its links, of which one target may have very many.
    known = sizes.join(found.select("target").distinct(), "target", "left_semi")
    sized = ordered.attach(found, known, ["target"], "path")
    followed = links.join(sized, "path").select(
        "ord",
        F.col("target").alias("path"),
        F.lit(False).alias("is_link"),
        F.lit(None).cast("string").alias("link_target"),
        "object_name",
        F.coalesce("_size", F.lit(0).cast("long")).alias("size"),
    )
    return files.select(*followed.columns).unionByName(followed)


def path_pairs(listing: DataFrame) -> DataFrame:
    """(given, resolved) path of every row; files resolve to themselves."""
    links, files = listing.filter("is_link"), listing.filter(~F.col("is_link"))
    same = files.select(F.col("path").alias("given"), F.col("path").alias("resolved"))
    return same.unionByName(resolve(links).select(F.col("path").alias("given"), F.col("target").alias("resolved")))


def moved(pairs: DataFrame) -> DataFrame:
    """Number of pairs whose paths differ."""
    return pairs.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("given").eqNullSafe(F.col("resolved"))).alias("n_differing"))
