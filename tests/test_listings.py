"""Snapshots and their changes, subtree intervals, sketches over runs."""

import os
import random

import pytest
from pyspark.sql import functions as F

from invspark.operators import folders, stats
from invspark.sources import listing, snapshots

SCHEMA = "key string, size long, etag string"


def objects(n, seed=0):
    rng = random.Random(seed)
    return {f"{rng.choice('abcdé')}/{i:04d}": (rng.randrange(100), rng.choice([None, "x", "", "yy"])) for i in range(n)}


def frame(spark, held):
    return spark.createDataFrame([(k, *v) for k, v in held.items()], SCHEMA)


def outer(old, new):
    return sorted(
        (k, "added" if k not in old else "removed" if k not in new else "changed", old.get(k), new.get(k)) for k in old.keys() | new.keys() if old.get(k) != new.get(k) or (k in old) != (k in new)
    )


def changed(spark, a, b, like):
    rows = snapshots.changes(spark, a, b, like).collect()
    return sorted((r.key, r.change, r.old and tuple(r.old), r.new and tuple(r.new)) for r in rows)


@pytest.mark.parametrize("ranges", [1, 5, 40])
def test_changes_equal_the_outer_join(spark, tmp_path, ranges):
    old, rng = objects(600), random.Random(1)
    new = {k: v for k, v in old.items() if rng.random() > 0.1}
    for k in rng.sample(sorted(new), 60):
        new[k] = (new[k][0], rng.choice([None, "x", "", "z"]))
    new |= {"": (1, "x"), "zz/last": (2, None), "0": (3, "")}
    a, b, c = (str(tmp_path / name) for name in "abc")
    snapshots.save(frame(spark, old), a, ranges=ranges)
    snapshots.save(frame(spark, new), b, like=a, ranges=ranges)
    assert changed(spark, a, b, frame(spark, old)) == outer(old, new)
    assert changed(spark, b, a, frame(spark, old)) == outer(new, old)
    snapshots.save(frame(spark, old), c, like=b, ranges=ranges)
    assert changed(spark, a, c, frame(spark, old)) == [] == snapshots.differing_ranges(spark, a, c)


def test_equal_ranges_are_not_read(spark, tmp_path):
    old = objects(2000)
    new = {k: (v[0] + 1, v[1]) if k in ("b/0007", sorted(old)[3]) else v for k, v in old.items()}
    new["a/0000x"] = (1, "x")
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    snapshots.save(frame(spark, old), a, ranges=50)
    snapshots.save(frame(spark, new), b, like=a, ranges=50)
    differ = snapshots.differing_ranges(spark, a, b)
    assert 1 <= len(differ) <= 3
    for where in (a, b):
        for folder in os.listdir(f"{where}/rows"):
            if folder.startswith("range=") and int(folder[6:]) not in differ:
                for name in os.listdir(f"{where}/rows/{folder}"):
                    with open(f"{where}/rows/{folder}/{name}", "wb") as out:
                        out.write(b"not to be read")
    assert changed(spark, a, b, frame(spark, old)) == outer(old, new)


def test_empty_snapshots(spark, tmp_path):
    old, a, b, c = objects(20), *(str(tmp_path / name) for name in "abc")
    snapshots.save(frame(spark, old), a, ranges=4)
    snapshots.save(frame(spark, old).filter("false"), b, like=a, ranges=4)
    assert changed(spark, a, b, frame(spark, old)) == outer(old, {})
    snapshots.save(frame(spark, old).filter("false"), c, ranges=4)
    assert changed(spark, c, b, frame(spark, old)) == []
    snapshots.save(frame(spark, old), b, like=c, ranges=4)
    assert changed(spark, c, b, frame(spark, old)) == outer({}, old)


PATHS = ["/r/a/b/x", "/r/a/b.txt", "/r/a/b/c/y", "/r/a/bc/z", "/r/a/b!q", "/r/top", "/r/d/e/f/g/h/deep", "/r/d/e/f/g/h/deep2", "/s/one", "/r/a/b", "/r//odd/x"]


@pytest.mark.parametrize("lead", ["/", ""])
def test_intervals_equal_ancestors(spark, lead):
    rng = random.Random(3)
    paths = [lead + p[1:] for p in PATHS] + [lead + "/".join(rng.choice("uvw") for _ in range(rng.randint(1, 6))) + f"/{i}" for i in range(200)] + ([] if lead else ["root1", "root2"])
    sizes = {p: rng.choice([0, 1, 1000, None]) for p in paths}
    frozen = listing.in_path_order(spark.createDataFrame(list(sizes.items()), "path string, size long")).cache()
    want = {}
    for p, size in sizes.items():
        parts = p.removeprefix("/").split("/")[:-1] if lead else p.split("/")[:-1]
        for depth in range(1, len(parts) + 1):
            n, b = want.get((lead + "/".join(parts[:depth]), depth), (0, 0))
            want[lead + "/".join(parts[:depth]), depth] = n + 1, b + (size or 0)
    found = folders.intervals(frozen).cache()
    assert {(r.folder, r.depth): (r.n_files, r.bytes) for r in found.collect()} == want
    gone = [lead + x for x in ("r/a/b", "u/v", "u", "s", "none", "w/w/w")]
    kept = folders.outside(frozen, found.filter(F.col("folder").isin(gone)))
    assert kept.columns == frozen.columns
    assert sorted(r.path for r in kept.collect()) == sorted(p for p in sizes if not any(p.startswith(g + "/") for g in gone))


def test_intervals_of_nothing(spark):
    none = spark.createDataFrame([], "ord long, path string, size long")
    assert folders.intervals(none).count() == 0
    one = spark.createDataFrame([(0, "a/b", 5)], "ord long, path string, size long")
    assert [tuple(r) for r in folders.intervals(one).collect()] == [("a", 1, 0, 0, 1, 5)]
    assert folders.outside(one, folders.intervals(none)).count() == 1


@pytest.mark.parametrize("kind", ["long", "double"])
def test_merged_sketches_keep_their_ranks(spark, kind):
    rng = random.Random(5)
    values = [int(rng.lognormvariate(10, 2)) for _ in range(30_000)]
    rows = [(i % 40, "a" if i % 3 else None, v if kind == "long" else v / 7) for i, v in enumerate(values)] + [(0, "a", None)]
    df = spark.createDataFrame(rows, f"run int, kind string, value {kind}").repartition(8)
    stored = stats.sketches(df, ["run", "kind"], "value")
    marks = [0, 0.01, 0.25, 0.5, 0.75, 0.99, 1]
    names = [f"q{n}" for n in range(len(marks))]
    for r in stats.sketched_quantiles(stats.merged_sketches(stored, ["kind"]), ["kind"], marks, names).collect():
        mine = sorted(v for _, k, v in rows if k == r.kind and v is not None)
        assert r.n == len(mine) and (r.q0, r.q6) == (mine[0], mine[-1])
        for mark, name in zip(marks, names):
            under, upto = sum(v < r[name] for v in mine), sum(v <= r[name] for v in mine)
            assert under - 0.01 * r.n - 1 <= mark * r.n <= upto + 0.01 * r.n + 1
    assert stats.merged_sketches(stats.sketches(df.filter("false"), [], "value"), []).count() == 0
