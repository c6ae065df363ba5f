"""Set differences by invertible tables against anti-joins."""

import random

import pytest
from pyspark.sql import functions as F

from invspark.operators import reconcile


def frame(spark, sets, kind="string"):
    return spark.createDataFrame([(g, m) for g, members in sets.items() for m in members], f"folder {kind}, name string").repartition(4)


def brute(left, right):
    return sorted((g, m, side) for side, a, b in (("left", left, right), ("right", right, left)) for g in a for m in a[g] - b.get(g, set()))


def found(spark, left, right, kind="string", cells=reconcile.CELLS):
    rows = reconcile.differences(frame(spark, left, kind), frame(spark, right, kind), "folder", "name", cells)
    assert rows.columns == ["folder", "name", "side"]
    return sorted(tuple(r) for r in rows.collect())


@pytest.mark.parametrize("cells", [6, 48])
def test_equals_anti_joins(spark, cells):
    """Few, many and no differences; groups on one side only; one group of a third of all members."""
    rng = random.Random(6)
    left = {f"g{i}": {f"m{j}" for j in range(rng.choice([1, 3, 30, 200]))} for i in range(60)}
    left["hot"] = {f"x{j}" for j in range(3000)}
    right = {g: {m for m in members if rng.random() > rng.choice([0, 0, 0.02, 0.5])} | {f"new{j}" for j in range(rng.choice([0, 0, 2]))} for g, members in left.items()}
    del right["g3"], left["g5"]
    right["other"] = {"", "ü", " "}
    assert found(spark, left, right, cells=cells) == brute(left, right)


def test_few_differences_need_no_join(spark, monkeypatch):
    left = {i: {f"m{j}" for j in range(300)} for i in range(40)}
    right = {i: members - {f"m{i}"} | {"new"} for i, members in left.items()}
    sides = [frame(spark, s, "long") for s in (left, right)]
    rows = reconcile._cells({"left": sides[0], "right": sides[1]}, "folder", "name", reconcile.CELLS)
    assert rows.count() == 40 and rows.select(F.max(F.size("cells"))).first()[0] <= 6
    taken = rows.mapInArrow(lambda parts: reconcile._taken(parts, reconcile.CELLS), "_group string, h long, sign int, whole boolean")
    assert taken.filter("not whole").isEmpty() and taken.count() == 80
    assert found(spark, left, right, "long") == brute(left, right)


def test_small_groups_are_no_cells(spark, monkeypatch):
    """Groups of no more members than cells are not spread over cells; larger ones beside them are."""
    given, cells = [], reconcile._cells
    monkeypatch.setattr(reconcile, "_cells", lambda sides, *rest: given.append({side: df.count() for side, df in sides.items()}) or cells(sides, *rest))
    left = {i: {f"m{j}" for j in range(4)} for i in range(50)} | {99: {f"m{j}" for j in range(100)}}
    right = {i: {f"m{j}" for j in range(i % 3, 5)} for i in range(50)} | {99: {f"m{j}" for j in range(1, 100)}}
    assert found(spark, left, right, "long") == brute(left, right)
    assert given == [{"left": 100, "right": 99}]


def test_a_false_table_is_joined(spark, monkeypatch):
    """What a table gives is not believed where the fingerprints say otherwise."""
    monkeypatch.setattr(reconcile, "peel", lambda cells, size: [])
    left, right = {"a": {"x", "y"}, "b": {"z"}}, {"a": {"y"}, "b": {"z", "w"}}
    assert found(spark, left, right) == brute(left, right)


def test_nulls_and_empty_tables(spark):
    left = spark.createDataFrame([("a", None), ("a", "x")], "folder string, name string")
    none = left.filter("false")
    assert [tuple(r) for r in reconcile.differences(left, none, "folder", "name").collect()] == [("a", "x", "left")]
    assert reconcile.differences(none, none, "folder", "name").count() == 0 == reconcile.differences(left, left, "folder", "name").count()


def test_tables_are_taken_apart():
    rng, size = random.Random(1), 48
    for n in (0, 1, 5, 15):
        cells = {}
        members = {rng.getrandbits(64): rng.choice([1, -1]) for _ in range(n)}
        for h, sign in members.items():
            for row in range(3):
                other = reconcile.spark_hash(row, h)
                place = (other - (1 << 64) if other >> 63 else other) % 16 + row * 16
                held = cells.setdefault(place, [0, 0, 0])
                held[0] += sign
                held[1] ^= h
                held[2] ^= reconcile.spark_hash(h)
        assert sorted(reconcile.peel(cells, size)) == sorted(members.items())


def test_a_false_table_of_a_large_group_is_joined(spark, monkeypatch):
    monkeypatch.setattr(reconcile, "peel", lambda cells, size: [])
    left = {"a": {f"x{i}" for i in range(20)}, "b": {f"z{i}" for i in range(20)}}
    right = {"a": left["a"] - {"x3"}, "b": left["b"] | {"w"}}
    assert found(spark, left, right, cells=6) == brute(left, right)
