"""Hard negatives against brute force; trees, bounds and how much of a tree is read."""

import math
import random

import numpy as np
import pytest

from invspark.llm import negatives, queries
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.01"


def brute(rows, asked, positives=5, k=3, scale=256):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * x) for x in v]

    known = [(i, label, whole(v)) for i, label, v in rows if i is not None and label is not None and whole(v) is not None]
    out = []
    for a, label, v in known:
        if not asked(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, other, w in known if i != a and len(w) == len(v))
        for minus, p, _ in [x for x in scored if x[2] == label][:positives]:
            good = [(-s, i) for s, i, other in scored if other != label and 50 * -minus <= 100 * -s <= 95 * -minus]
            out += [(a, p, rank, i, -minus, s) for rank, (s, i) in enumerate(good[:k], 1)]
    return sorted(out)


def sample():
    rng = random.Random(4)
    rows = [(i, 0 if rng.random() < 0.4 else rng.randint(0, 5), [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(900)]
    rows += [(i, i % 3, [0.5, 0.25] * 3) for i in range(900, 1300)]  # ties, and one vector in a third of the rows
    rows += [(50, 1, rows[50][2]), (50, 2, [0.9] * 6), (100, rows[100][1], rows[100][2]), (7, 3, rows[7][2])]
    rows += [(None, 1, [1.0] * 6), (2000, None, [1.0] * 6), (2050, 1, None), (2100, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (2150, 1, [float("nan")] * 6), (2200, 1, [float("inf")] * 6)]
    rows += [(2250, 1, [1.0] * 3), (2251, 1, [1.5] * 3), (2252, 2, [1.2] * 3), (2253, 2, [9.0] * 3), (2300, 1, []), (2301, 1, []), (2302, 2, []), (2350, 77, [0.1] * 6), (2400, -1, [-0.1] * 6), (2401, -1, [0.1] * 6)]
    return rows


@pytest.mark.parametrize("tree, leaf, unit", [(1 << 14, 64, 1 << 24), (50, 4, 500), (50, 4, 1 << 24)])
def test_equals_brute_force(spark, monkeypatch, tree, leaf, unit):
    for name, value in (("TREE", tree), ("LEAF", leaf), ("UNIT", unit), ("BLOCK", 7 if leaf == 4 else 1024)):
        monkeypatch.setattr(negatives, name, value)
    rows = sample()
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, Rank string").repartition(3)
    found = sorted(tuple(r) for r in negatives.mine(df, "vec_id % 50 = 0").collect())
    assert found == brute(rows, lambda i: i % 50 == 0) and len(found) > 200


def test_empty_and_few(spark):
    schema = "vec_id long, label int, embedding array<float>"
    empty = spark.createDataFrame([], schema)
    assert negatives.mine(empty, "vec_id % 50 = 0").count() == 0
    alone = spark.createDataFrame([(0, 1, [1.0, 1.0]), (1, 2, [0.5, 0.5])], schema)
    assert negatives.mine(alone, "vec_id % 50 = 0").count() == 0
    pair = spark.createDataFrame([(0, 1, [1.0, 1.0]), (1, 2, [0.5, 0.5]), (2, 1, [1.0, 0.0])], schema)
    assert negatives.mine(pair, "vec_id = 0").collect() == []  # a negative of the same score as the positive is too near
    assert [tuple(r) for r in negatives.mine(pair, "vec_id = 0", high=100).collect()] == [(0, 2, 1, 1, 65536, 65536)]


def test_grid():
    """More buckets than groups, both bounded by the work there is."""
    assert negatives.grid(1, 100, 2, 16) == (1, 1) == negatives.grid(0, 0, 0, 16)
    assert negatives.grid(220, 10_000, 200, 400) == (7, 1)
    buckets, groups = negatives.grid(700, 10_000_000, 200_000, 8000)
    assert buckets * groups >= 8000 and 30 < buckets / groups < 70
    assert negatives.grid(10_000, 160_000_000, 100, 10)[0] >= 10_000 / 32


def test_tiles_are_full_and_hold_every_row():
    values = np.random.default_rng(0).normal(size=(1000, 5))
    leaves = list(negatives.tiles(values, np.arange(1000), np.arange(5), 16))
    assert sorted(np.concatenate(leaves).tolist()) == list(range(1000))
    assert max(map(len, leaves)) <= 16 and len(leaves) <= 2 * 1000 / 16


@pytest.mark.parametrize("scale", [100, 1 << 40])
def test_bounds_hold_and_prune(scale, monkeypatch):
    """Every score lies within the bounds of all boxes above it; clustered vectors are mostly not read with leaves of a cluster's size."""
    monkeypatch.setattr(negatives, "LEAF", 64)
    rng = np.random.default_rng(2)
    values = np.floor((rng.normal(size=(40, 1, 8)) * 4 + rng.normal(size=(40, 50, 8)) * 0.2).reshape(-1, 8) * scale)
    built = negatives.build(np.arange(len(values)), values)
    kinds = {"ids": "<i8", "starts": "<i4"}
    tree = negatives.Tree({name: x.astype(kinds.get(name, "<f8")).tobytes() for name, x in built.items()} | {"dim": 8, "kind": "<f8"})
    asked = values[rng.choice(len(values), 20)]
    least, most = tree.bounds(asked)
    exact = asked.astype(object) @ tree.exact.astype(object).T
    leaf_of = np.repeat(np.arange(tree.n_leaves), np.diff(tree.ends))
    for place in range(20):
        for row, node in enumerate(leaf_of):
            assert least[place, node] <= exact[place, row] <= most[place, node]
        assert least[place, tree.root] <= min(exact[place]) and max(exact[place]) <= most[place, tree.root]
    if scale == 100:
        read = 0
        for place in range(20):
            window = negatives.Asked(-np.inf, np.inf, 5)
            read += negatives.search(tree, asked[place], -1, [window], least[place], most[place])
            want = sorted((-int(s), i) for s, i in zip(exact[place], tree.ids.tolist()))[:5]
            assert window.best == want
        assert read < 20 * tree.n_leaves / 3


def test_query_equals_sql(spark):
    assert not differences(queries.QUERIES["op13_hard_negatives"](spark, SF), oracle(SF), queries.SQL["op13_hard_negatives"])
