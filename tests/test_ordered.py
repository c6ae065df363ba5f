"""Bucketed sequence operators against plain pandas, with small buckets and a run holding most rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from invspark.operators import batching, ordered, stats, timeline


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    n = 3000
    # One run holds about a third of all rows more than the others.
    run = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 6, n))
    out = pd.DataFrame({"run": run, "ord": rng.permutation(1 << 13)[:n] - 500, "v": rng.integers(0, 100, n)})
    return out.sort_values(["run", "ord"]).reset_index(drop=True)


@pytest.fixture(scope="module")
def df(spark, frame):
    return spark.createDataFrame(frame).repartition(5)


def ordered_pdf(out):
    return out.toPandas().sort_values(["run", "ord"]).reset_index(drop=True)


@pytest.mark.parametrize("shifts", [(), (4,), (5, 4), (3, 3, 3)])
def test_scan(df, frame, shifts):
    out = ordered_pdf(ordered.scan(df, ["run"], "ord", sums={"s": F.col("v")}, previous={"p": F.col("v")}, following={"n": F.col("v")}, shifts=shifts))
    by = frame.groupby("run")["v"]
    assert (out["s"] == by.cumsum() - frame["v"]).all()
    pd.testing.assert_series_equal(out["p"].astype(float), by.shift(1).astype(float), check_names=False)
    pd.testing.assert_series_equal(out["n"].astype(float), by.shift(-1).astype(float), check_names=False)


def test_previous_keeps_null_values(spark):
    rows = spark.createDataFrame([(1, 5), (2, None), (9, 7), (17, 1)], "ord long, v long")
    out = ordered.scan(rows, [], "ord", previous={"p": F.col("v")}, shifts=(2,)).orderBy("ord").collect()
    assert [r["p"] for r in out] == [None, 5, None, 7]


def test_numbers_and_chunks(df, frame):
    out = ordered_pdf(ordered.chunks(df, ["run"], "ord", 7, shifts=(4,)))
    assert (out["chunk"] == frame.groupby("run").cumcount() // 7).all()


@pytest.mark.parametrize("n,shift", [(1, 3), (2, 0), (10, 4), (10, 6), (100, 3), (100, 5)])
def test_rolling_rows(df, frame, n, shift):
    """Also where a frame reaches over many buckets, some of them empty."""
    out = ordered_pdf(ordered.rolling_rows(df, ["run"], "ord", F.col("v"), n, shifts=(shift,)))
    want = frame.groupby("run")["v"].rolling(n).mean().reset_index(drop=True)
    np.testing.assert_allclose(out["rolling"], want)


def test_rolling_rows_with_null_values(spark):
    rows = spark.createDataFrame([(i, None if i == 3 else float(i)) for i in range(8)], "ord long, v double")
    for shift in (20, 1, 0):
        out = ordered.rolling_rows(rows, [], "ord", F.col("v"), 3, shifts=(shift,)).orderBy("ord").toPandas()["rolling"]
        np.testing.assert_allclose(out, pd.Series([0, 1, 2, np.nan, 4, 5, 6, 7]).rolling(3).mean())
    full = ordered.rolling_rows(rows, [], "ord", F.col("v"), 3, shifts=(1,), full_only=True)
    assert sorted(r["ord"] for r in full.collect()) == [2, 3, 4, 5, 6, 7]


def test_rolling_span_counts_ties_and_open_start(spark):
    rows = spark.createDataFrame([(0, 10), (100, 20), (3600, 60), (3601, 4)], "ord long, v long")
    out = {r["ord"]: r["rolling"] for r in ordered.rolling_span(rows, [], "ord", F.col("v"), 3600).collect()}
    assert out == {0: 10.0, 100: 15.0, 3600: 40.0, 3601: 28.0}


def test_attach_splits_groups(df, spark):
    groups = df.groupBy("run").agg(F.sum("v").alias("total"))
    out = ordered.attach(df, groups.filter("run <> 2"), ["run"], "ord", salts=4)
    assert out.count() == df.count()
    assert out.filter("total is null").count() == df.filter("run = 2").count()


def test_attach_matches_null_keys(spark):
    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 3), ("b", 4)], "run string, ord long")
    groups = spark.createDataFrame([(None, 10), ("a", 20)], "run string, total long")
    assert sorted((r["ord"], r["total"]) for r in ordered.attach(rows, groups, ["run"], "ord").collect()) == [(1, 10), (2, 10), (3, 20), (4, None)]


def test_narrow_scan_gives_the_same(df):
    slim = df.select("run", "ord", "v")
    named = dict(sums={"s": F.col("v")}, previous={"p": F.col("v")}, following={"n": F.col("ord")}, shifts=(5,))
    wide, narrow = (ordered.scan(slim, ["run"], "ord", narrow=flag, **named) for flag in (False, True))
    assert wide.exceptAll(narrow).isEmpty() and narrow.exceptAll(wide).isEmpty()


def brute_next_fit(sizes, max_size, max_count):
    out, held, count, number = [], 0, 0, 0
    for size in sizes:
        if (held + size > max_size and held > 0) or count >= max_count:
            number, held, count = number + 1, 0, 0
        out.append(number)
        held, count = held + size, count + 1
    return out


def test_next_fit_against_the_rule():
    rng = np.random.default_rng(1)
    for _ in range(800):
        sizes = rng.integers(0, 12, rng.integers(1, 60)) * (rng.random() < 0.8)
        limit, count = int(rng.integers(1, 30)), int(rng.integers(1, 9))
        assert list(batching._next_fit(np.asarray(sizes, dtype=np.int64), limit, count)) == brute_next_fit(sizes, limit, count)


@pytest.mark.parametrize("sizes,limit,count,want", [
    ([0, 0, 50, 1], 10, 9, [0, 0, 0, 1]),       # leading empty files share with an oversize one
    ([10, 10], 10, 9, [0, 1]),                  # exactly the limit
    ([5, 5, 5], 10, 9, [0, 0, 1]),              # exactly half
    ([1, 1, 1], 10, 1, [0, 1, 2]),              # one member per archive
    ([20, 0, 0], 10, 9, [0, 1, 1]),
])
def test_next_fit_edges(sizes, limit, count, want):
    assert list(batching._next_fit(np.array(sizes, dtype=np.int64), limit, count)) == want


def test_batches_keep_limits(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"ord": range(4000), "size": rng.integers(0, 300, 4000)})
    batched = batching.assign_batches(spark.createDataFrame(pdf).repartition(7), 500, 6, 900)
    assert batching.over_limit(batched, 500, 6).isEmpty()
    got = batched.orderBy("ord").toPandas()
    want = [x for part in range(5) for x in (np.array(brute_next_fit(pdf["size"][part * 900:(part + 1) * 900], 500, 6)) + part * 1_000_000)]
    assert list(got["id"]) == want


def test_members_limit():
    assert [batching.members_limit(n) for n in (1, 48, 1000)] == [9990, 198, 50]


def test_quantiles_match_pandas(df, frame):
    out = stats.describe(df, ["run"], "v").toPandas().set_index("run").sort_index()
    want = frame.groupby("run")["v"].describe()
    for ours, theirs in (("n", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%"), ("max", "max")):
        np.testing.assert_allclose(out[ours].astype(float), want[theirs])


def test_describe_single_row(spark):
    one = spark.createDataFrame([(7,)], "v long")
    row = stats.describe(one, [], "v").first()
    assert (row["n"], row["mean"], row["std"], row["q50"]) == (1, 7.0, None, 7.0)


def test_histogram_matches_numpy(df, frame):
    out = stats.histogram(df, [], "v", 20).orderBy("bin").toPandas()
    counts, edges = np.histogram(frame["v"], 20)
    assert list(out["n"]) == list(counts)
    np.testing.assert_allclose(out["from_value"], edges[:-1])


def test_histogram_of_equal_values(spark):
    out = stats.histogram(spark.createDataFrame([(4,), (4,)], "v long"), [], "v", 10).orderBy("bin").toPandas()
    assert list(out["n"]) == list(np.histogram([4, 4], 10)[0])


def curve_of(spark, rows):
    df = spark.createDataFrame(rows, "ord long, run string, start_us long, end_us long, rate long")
    return df, timeline.level_curve(df, ["run"])


def test_area_equals_bytes(spark):
    rng = np.random.default_rng(8)
    rows, total = [], 0
    for i in range(300):
        start, dur, rate = int(rng.integers(0, 10**9)), int(rng.integers(1, 10**8)), int(rng.integers(1, 10**6))
        rows.append((i, "a", start, start + dur, rate))
        total += rate * dur
    _, curve = curve_of(spark, rows)
    got = timeline.integral(curve, ["run"]).first()["mib"]
    assert abs(got - total / 1e9 / 1024**2) <= 1e-9 * got
    assert curve.filter("next_t is null").first()["rate"] == 0


def test_concurrency_of_touching_and_equal_intervals(spark):
    _, curve = curve_of(spark, [(0, "a", 0, 10, 5), (1, "a", 10, 20, 7), (2, "b", 0, 10, 1), (3, "b", 0, 10, 1), (4, "c", 3, 3, None)])
    rows = [tuple(r) for r in curve.orderBy("run", "t").collect()]
    assert rows == [("a", 0, 10, 5, 1), ("a", 10, 20, 7, 1), ("a", 20, None, 0, 0), ("b", 0, 10, 2, 2), ("b", 10, None, 0, 0)]


def test_grid_counts_both_ends_and_skips_short_transfers(spark):
    # Ticks at 0, 100, 200: on a tick at both ends, between ticks, and a point exactly on a tick.
    df, _ = curve_of(spark, [(0, "a", 0, 100, 10), (1, "a", 110, 190, 99), (2, "a", 200, 200, None), (3, "a", 50, 250, 1)])
    got = [(r["tick"], r["rate"], r["concurrency"]) for r in timeline.grid(df, 100).orderBy("tick").collect()]
    assert got == [(0, 10, 1), (1, 11, 2), (2, 1, 2)]


def test_overlap_follows_order_not_time(spark):
    df, _ = curve_of(spark, [(1, "a", 100, 200, 1), (2, "a", 50, 60, 1), (3, "a", 60, 70, 1)])
    got = [r["overlap"] for r in timeline.overlap(df, ["run"]).orderBy("ord").collect()]
    assert got == [False, True, False]


def test_opening_flag_takes_the_last_tied_event(spark):
    rows = [(0, True, 0, 10, 4), (1, False, 10, 20, 6)]
    df = spark.createDataFrame(rows, "ord long, c boolean, start_us long, end_us long, rate long")
    got = {r["c"]: round(r["mib"] * 1e9 * 1024**2) for r in timeline.opening_flag_integral(df, "c").collect()}
    # At t=10 the start of the second comes first, the end of the first opens the interval.
    assert got == {True: 100, False: 0}
