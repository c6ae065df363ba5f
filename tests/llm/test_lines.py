"""Line dedup against brute force, bitmaps, hot keys over many ranges."""

import random
from collections import defaultdict

import numpy as np
import pytest

from invspark.llm import lines, queries
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.01"
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(SMALL)


def brute(rows):
    split = [(d, (t or "").split("\n")) for d, t in rows]
    where = defaultdict(set)
    for d, held in split:
        for line in held:
            where[key(line)].add(d)

    def goes(d, line):
        docs = where[key(line)]
        return len(key(line)) >= 20 and len(docs) >= 3 and d != max((x for x in docs if x is not None), default=None)

    kept = [(d, len(held), [line for line in held if not goes(d, line)]) for d, held in split]
    return sorted(((d, n, n - len(held), "\n".join(held)) for d, n, held in kept), key=repr)


def sample():
    rng = random.Random(1)
    pool = [f"line number {i} which is long" for i in range(40)]
    pool += ["short", "x" * 20, "ü" * 20, "Ü" * 19, "É" * 20, "é" * 20, "  Line Number 3 WHICH is long\t", "\u00a0" + pool[5], "", " " * 40]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.3 else f"own {i} {j} " + "z" * rng.randint(0, 30) for j in range(rng.randint(0, 12)))) for i in range(400)]
    hot = "a line in a third of all rows, and more"
    rows += [(1000 + i, f"{hot}\nown line of document {i}") for i in range(1200)]
    rows += [(None, hot), (None, None), (None, hot), (None, pool[1]), (7, rows[7][1]), (7, rows[7][1]), (8, "other\n" + pool[0]), (9, None), (10, ""), (11, "\n\n")]
    rows += [(12, (hot + "\n") * 20_000), (13, "y" * 500_000 + "\n" + hot), (-5, hot + "\r")]
    rows += [(n, "only two documents hold it") for n in (20, 21, 21, 20)] + [(30, "one and none hold this line")] + [(None, "one and none hold this line")] * 5
    return rows


@pytest.mark.parametrize("size", [1 << 20, 60])
def test_equals_brute_force(spark, monkeypatch, size):
    """Also where ranges cut the hot key many times."""
    monkeypatch.setattr(lines, "RANGE", size)
    rows = sample()
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, Keep string").repartition(5)
    found = lines.dedup(df)
    assert found.columns == ["doc_id", "text", "n_lines", "n_dropped", "keep"]
    assert sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in found.collect()), key=repr) == brute(rows)


def test_bitmaps_alone_restore_the_texts(spark):
    rows = sample()[:300]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    bitmaps = {r.doc: (r.n_lines, r.keep) for r in lines.keep_bitmaps(df).collect()}
    for d, n, n_dropped, text in brute(rows):
        keep = lines.unpack(*bitmaps[d])
        assert len(keep) == n and n - keep.sum() == n_dropped
        assert "\n".join(x for x, k in zip(dict(rows)[d].split("\n"), keep) if k) == text


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lines.dedup(empty).count() == 0 == lines.keep_bitmaps(empty).count()


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 200, 5000])
def test_bitmap_round_trip(n):
    rng = np.random.default_rng(n)
    for share in (0, 0.001, 0.3, 0.999, 1):
        gone = np.nonzero(rng.random(n) < share)[0]
        keep = np.ones(n, bool)
        keep[gone] = False
        packed = lines.pack(n, gone)
        assert (lines.unpack(n, packed) == keep).all() and len(packed) <= 1 + (n + 7) // 8


def test_a_long_run_is_short():
    assert len(lines.pack(100_000, np.arange(10, 90_000))) < 10


def test_query_equals_sql(spark):
    assert not differences(queries.QUERIES["op12_line_dedup"](spark, SF), oracle(SF), queries.SQL["op12_line_dedup"])
