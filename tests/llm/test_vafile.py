"""Exact top-k against brute force."""

import math
import random

from invspark.llm import queries, vafile
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.01"


def brute(rows, asked, k, scale=256):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(scale * x) for x in v]

    out = []
    for q, v in asked:
        v = whole(v)
        if q is None or v is None:
            continue
        found = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in ((i, whole(w)) for i, w in rows) if i is not None and i != q and w is not None and len(w) == len(v)]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def test_equals_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6)]) for i in range(700)]
    rows += [(i, [0.1] * 6) for i in range(700, 900)]  # ties
    rows += [(5, rows[5][1]), (5, [9.0] * 6), (None, [1.0] * 6), (901, None), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [1.0] * 3), (906, [2.0] * 3), (907, [])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, RANK string").repartition(4)
    asked = [r for r in rows if r[0] is not None and (r[0] % 50 == 0 or r[0] in (5, 905, 901, 904, 907))]
    queries_df = df.filter("vec_id % 50 = 0 or vec_id in (5, 905, 901, 904, 907)")
    found = sorted(tuple(r) for r in vafile.top_k(df, queries_df, 5).collect())
    assert found == brute(rows, asked, 5)


def test_large_components_and_few_rows(spark):
    rows = [(1, [1e14, -3.0]), (2, [2e14, 5.0]), (3, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in vafile.top_k(df, df, 5).collect()}
    assert len(found) == 6 and found[1, 1] == (2, vafile.LONG[1])
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert vafile.top_k(empty, empty).count() == 0 == vafile.top_k(df, empty).count() == vafile.top_k(empty, df).count()


def test_vectors_are_read_by_bounds_only_as_far_as_needed():
    import numpy as np

    rng = np.random.default_rng(1)
    values = np.floor(rng.normal(size=(4000, 16)) * 256)
    ids = np.arange(4000)
    low, high = values.min(axis=0), values.max(axis=0)
    cells = np.minimum(15, (values - low) // (np.floor((high - low) / 16) + 1)).astype(np.uint8)
    lowest = np.array([[values[cells[:, d] == c, d].min(initial=np.inf) for c in range(16)] for d in range(16)])
    highest = np.array([[values[cells[:, d] == c, d].max(initial=-np.inf) for c in range(16)] for d in range(16)])
    read = 0
    original = vafile.scores

    def counting(queries, vectors):
        nonlocal read
        read += len(vectors)
        return original(queries, vectors)

    vafile.scores = counting
    try:
        for place, found, score in vafile.best(ids[:40], values[:40], ids, values, cells, lowest, highest, 5):
            exact = values @ values[place]
            exact[place] = -np.inf
            assert found.tolist() == np.lexsort((ids, -exact))[:5].tolist()
    finally:
        vafile.scores = original
    assert read < 40 * 4000 / 10


def test_query_equals_sql(spark):
    assert not differences(queries.QUERIES["op9_exact_top_k"](spark, SF), oracle(SF), queries.SQL["op9_exact_top_k"])


def test_any_grid_gives_the_same(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(6 if i % 7 else 3)]) for i in range(600)]
    rows += [(i, [0.1] * 6) for i in range(600, 700)] + [(20, rows[20][1]), (20, [9.0] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    wanted = brute(rows, [r for r in rows if r[0] % 20 == 0], 5)
    monkeypatch.setattr(vafile, "BLOCK", 16)
    monkeypatch.setattr(vafile, "QUERIES", 4)
    shapes = set()
    for tasks, held in ((1, 1 << 20), (8, 1 << 20), (8, 500), (1, 1)):
        monkeypatch.setattr(vafile, "HELD", held)
        monkeypatch.setattr(vafile, "grid", lambda a, b, c, d, _, g=vafile.grid, t=tasks: shapes.add(shape := g(a, b, c, d, t)) or shape)
        assert sorted(tuple(r) for r in vafile.top_k(df, df.filter("vec_id % 20 = 0"), 5).collect()) == wanted
        monkeypatch.undo()
        monkeypatch.setattr(vafile, "BLOCK", 16)
        monkeypatch.setattr(vafile, "QUERIES", 4)
    assert len(shapes) == 4


def test_queries_are_not_broadcast(spark, capsys):
    """Queries go to each bucket of candidates: sent through the driver, they took its memory with the square of the input."""
    rows = [(i, [float(i % 7), float(i % 5)]) for i in range(100)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = vafile.top_k(df, df.filter("vec_id % 50 = 0"), 5)
    assert found.count() == 10
    found.explain()
    assert "Broadcast" not in capsys.readouterr().out


def test_grid_sends_little_and_keeps_queries_few():
    """Bytes held are bounded, tasks have cells, and little is sent twice."""
    for candidates, sent, asked, held, tasks in ((150, 300 << 20, 72, 6 << 20, 12), (750, 1 << 31, 300, 1 << 30, 12), (1, 2 << 20, 40, 1 << 20, 12), (0, 0, 0, 0, 8), (90, 1 << 28, 90, 1 << 28, 64), (5000, 1 << 42, 4000, 1 << 40, 200)):
        buckets, groups = vafile.grid(candidates, sent, asked, held, tasks)
        assert buckets >= 1 and groups >= 1 and -(-held // groups) <= vafile.HELD
        assert buckets * groups >= min(tasks, max(1, candidates) * max(1, asked))
        assert buckets <= max(1, candidates) and groups <= max(1, asked, -(-held // vafile.HELD))
    assert vafile.grid(150, 300 << 20, 72, 6 << 20, 12) == (12, 1) and vafile.grid(90, 1 << 28, 90, 1 << 28, 64) == (8, 8)


def test_carried_thresholds_at_the_ends_of_a_long(spark, monkeypatch):
    monkeypatch.setattr(vafile, "BLOCK", 8)
    rows = [(i, [-1e30 * (i % 3 + 1), 1e290, -1e290][: 2 if i % 2 else 3]) for i in range(100, 0, -1)] + [(0, [1e30, 1e300, 1e300]), (200, [1e30, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    asked = [(0, rows[-2][1]), (200, rows[-1][1])]
    found = sorted(tuple(r) for r in vafile.top_k(df, df.filter("vec_id in (0, 200)"), 5).collect())
    wanted = [(q, rank, i, min(max(s, vafile.LONG[0]), vafile.LONG[1])) for q, v in asked for rank, (s, i) in enumerate(sorted(((max(min(sum(math.floor(256 * a) * math.floor(256 * b) for a, b in zip(v, w)), vafile.LONG[1]), vafile.LONG[0]), i) for i, w in rows if i != q and len(w) == len(v)), key=lambda x: (-x[0], x[1]))[:5], 1)]
    assert found == wanted
