"""Differences between two families of sets, without joining the members of large ones.

Each group's set becomes a small invertible table: every member is added to
three of its cells, as a count and as XORs of its hash and of a check on the
hash. Added for one side and subtracted for the other, members on both sides
cancel, map-side already, so a group is shuffled as a few cells whatever its
size. While few members differ, cells that hold a single one give it away, and
taking it out of its other cells frees further ones. Groups that cannot be taken
apart, or whose members found do not account for the difference of the
two sets' fingerprints, are joined member by member, and only those.

A group with no more members than its table has cells would be more cells than
members, as each goes to three of them: its members are counted themselves.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialise

#: Cells of a group's table, three rows of them: up to about two thirds as many members may differ.
CELLS = 48
PRINTS = ("f1", "f2", "f3")


def _hash(member: str) -> Column:
    return F.xxhash64(F.lit("member"), F.col(member).cast("string"))


def _prints() -> list[Column]:
    return [F.bit_xor(name).alias(name) for name in PRINTS]


def _rows(sets: DataFrame, group: str, member: str, sign: int) -> DataFrame:
    hashed = sets.filter(F.col(member).isNotNull()).select(
        F.col(group).alias("_group"), _hash(member).alias("h"), F.lit(sign).cast("long").alias("sign"),
        *[F.xxhash64(F.lit(name), F.col(member).cast("string")).alias(name) for name in PRINTS],
    )
    return hashed.withColumn("check", F.xxhash64("h"))


def _place(row: int, cells: int) -> Column:
    """A member's cell in one of the three rows of cells."""
    part = cells // 3
    return (F.pmod(F.xxhash64(F.lit(row), F.col("h")), F.lit(part)) + row * part).cast("int")


def spark_hash(*values: int) -> int:
    """Spark's ``xxhash64`` of an int and a long, or of a long: each value is hashed with the hash before it as seed."""
    seed = 42
    for place, value in enumerate(values):
        size = 4 if len(values) == 2 and place == 0 else 8
        seed = xxhash.xxh64_intdigest((value & (1 << 8 * size) - 1).to_bytes(size, "little"), seed)
    return seed


def peel(cells: dict[int, list[int]], size: int) -> list[tuple[int, int]] | None:
    """(hash, sign) of what a table holds, cell -> [count, hash, check], unsigned; None if it cannot be taken apart."""
    cells, out, part = {c: list(v) for c, v in cells.items() if any(v)}, [], size // 3
    ready = list(cells)
    while ready:
        held = cells.get(ready.pop())
        if held is None or abs(held[0]) != 1 or spark_hash(held[1]) != held[2]:
            continue
        sign, h, check = held
        out.append((h, sign))
        for row in range(3):
            other = spark_hash(row, h)
            other = (other - (1 << 64) if other >> 63 else other) % part + row * part
            value = cells.setdefault(other, [0, 0, 0])
            value[0] -= sign
            value[1] ^= h
            value[2] ^= check
            if any(value):
                ready.append(other)
            else:
                del cells[other]
    return None if cells else out


def differences(left: DataFrame, right: DataFrame, group: str, member: str, cells: int = CELLS) -> DataFrame:
    """(group, member, side): members of ``left`` only and of ``right`` only, for rows (group, member) without repeats on either side.

    Equal to the two anti-joins. Groups are not null; a null member belongs to no set. Members are compared by 64-bit hashes
    within a group, and what is found is held against 192 bits of the whole difference; a group where it fails is joined.
    """
    both = left.select(group, member, F.lit(1).alias("_sign")).unionByName(right.select(group, member, F.lit(-1).alias("_sign")))
    members = materialise(both.filter(F.col(member).isNotNull()), "members")
    large = materialise(members.groupBy(group).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > cells).select(group), "large")
    single = members.join(large, group, "left_anti").groupBy(group, member).agg(F.sum("_sign").alias("_sign")).filter("_sign <> 0")
    small = single.select(group, member, F.when(F.col("_sign") > 0, "left").otherwise("right").alias("side"))
    held = members.join(large, group, "left_semi")
    sides = {side: held.filter(F.col("_sign") == sign).select(group, member) for side, sign in (("left", 1), ("right", -1))}
    return small.unionByName(_by_cells(sides, group, member, cells))


def _by_cells(sides: dict[str, DataFrame], group: str, member: str, cells: int) -> DataFrame:
    """The same of groups of any size, by invertible tables."""
    rows = materialise(_cells(sides, group, member, cells), "cells")
    found = materialise(rows.mapInArrow(lambda parts: _taken(parts, cells), "_group string, h long, sign int, whole boolean"), "taken")
    # Names are looked up where their hash is known: the differences are the small side.
    named = []
    for side, sign in (("left", 1), ("right", -1)):
        wanted = found.filter(f"whole and sign = {sign}").select(F.col("_group").alias("_g"), F.col("h").alias("_h"))
        keyed = sides[side].withColumns({"_g": F.col(group).cast("string"), "_h": _hash(member)})
        named.append(keyed.join(wanted, ["_g", "_h"]).select(group, member, F.lit(side).alias("side")))
    easy = materialise(named[0].unionByName(named[1]), "named")
    prints = [F.xxhash64(F.lit(name), F.col(member).cast("string")).alias(name) for name in PRINTS]
    sums = easy.select(F.col(group).cast("string").alias("_group"), *prints).groupBy("_group").agg(*[F.bit_xor(n).alias(f"_{n}") for n in PRINTS])
    zero = F.lit(0).cast("long")
    unequal = F.lit(False)
    for name in PRINTS:
        unequal = unequal | (F.coalesce(name, zero) != F.coalesce(f"_{name}", zero))
    wrong = rows.select("_group", *PRINTS).join(sums, "_group", "left").filter(unequal).select("_group")
    hard = materialise(found.filter("not whole").select("_group").unionByName(wrong).distinct(), "hard")
    kept = easy.withColumn("_group", F.col(group).cast("string")).join(hard, "_group", "left_anti").select(group, member, "side")
    part = {side: df.withColumn("_group", F.col(group).cast("string")).join(hard, "_group", "left_semi").select(group, member) for side, df in sides.items()}
    joined = [part[a].filter(F.col(member).isNotNull()).join(part[b], [group, member], "left_anti").withColumn("side", F.lit(a)) for a, b in (("left", "right"), ("right", "left"))]
    return kept.unionByName(joined[0]).unionByName(joined[1])


def _cells(sides: dict[str, DataFrame], group: str, member: str, cells: int) -> DataFrame:
    """One row per group that differs: its cells that are not empty, and the fingerprint of the difference."""
    both = _rows(sides["left"], group, member, 1).unionByName(_rows(sides["right"], group, member, -1))
    # Every member once more in cell -1, which keeps the fingerprint.
    places = F.explode(F.array(F.lit(-1), *[_place(row, cells) for row in range(3)]))
    spread = both.withColumn("cell", places)
    summed = spread.groupBy("_group", "cell").agg(F.sum("sign").alias("n"), F.bit_xor("h").alias("h"), F.bit_xor("check").alias("check"), *_prints())
    odd = summed.filter("n <> 0 or h <> 0 or check <> 0")
    whole = F.col("cell") == -1
    return odd.groupBy(F.col("_group").cast("string").alias("_group")).agg(
        F.collect_list(F.when(~whole, F.struct("cell", "n", "h", "check"))).alias("cells"), *[F.max(F.when(whole, F.col(name))).alias(name) for name in PRINTS]
    )


def _taken(parts: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """What each group's table gives; a group that cannot be taken apart gives one row that is not ``whole``."""
    mask = (1 << 64) - 1
    for part in parts:
        rows: list[tuple] = []
        for group, held in zip(part.column("_group").to_pylist(), part.column("cells").to_pylist()):
            found = peel({c["cell"]: [c["n"], c["h"] & mask, c["check"] & mask] for c in held}, size)
            rows += [(group, None, None, False)] if found is None else [(group, h - (1 << 64) if h >> 63 else h, sign, True) for h, sign in found]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.bool_()))], names=["_group", "h", "sign", "whole"])
