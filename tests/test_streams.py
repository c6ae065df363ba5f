"""Streams with keyed state against their batch twins, whatever order the input comes in."""

import random
from types import SimpleNamespace

import pytest

from invspark.operators import lookups, stats
from invspark.streaming import progress

HOUR = 3_600_000_000
START = 400_000 * HOUR


def take(spark, path, rows):
    """Rows (key, hour) as one more listing, and what it reports."""
    data = spark.createDataFrame([(k, START + h * HOUR) for k, h in rows], "key string, listed_us long")
    data.coalesce(1).write.mode("append").parquet(f"{path}/in")
    stream = spark.readStream.schema(data.schema).parquet(f"{path}/in")
    progress.start_new_logs(stream, f"{path}/out", f"{path}/log", wait_us=24 * HOUR).awaitTermination()
    found = spark.read.schema("key string").option("recursiveFileLookup", True).parquet(f"{path}/out")
    return sorted(r.key for r in found.collect())


def test_logs_wait_for_their_verification(spark, tmp_path):
    path, check = str(tmp_path), "{}-backup-verification.csv".format
    assert take(spark, path, [("a-backup.csv", 0), (check("b"), 0), ("c-files.csv", 0), ("d-backup.csv", 0), (check("d"), 0), ("other.txt", 0)]) == []
    assert take(spark, path, [(check("a"), 7), ("b-backup.csv", 7), ("e-backup.csv", 7), ("e-files.csv", 20)]) == []
    assert take(spark, path, [(check("f"), 3), ("f-backup.csv", 24), (None, 24)]) == []  # c has waited for 24 hours, not longer
    assert take(spark, path, [("c-files.csv", 25), (None, 32)]) == ["c-files.csv", "e-backup.csv"]  # reported once, though listed again
    assert take(spark, path, [(check("c"), 50), ("e-backup.csv", 50)]) == ["c-files.csv", "e-backup.csv", "e-files.csv"]
    assert take(spark, path, [(None, 500)]) == ["c-files.csv", "e-backup.csv", "e-files.csv"]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_equals_the_batch_twin(spark, tmp_path, seed):
    rng = random.Random(seed)
    keys = [f"r/{i}-{kind}" for i in range(80) for kind in ("backup.csv", "files.csv", "backup-verification.csv") if rng.random() < 0.6]
    # Some keys are in several listings; one listing falls into two triggers.
    times = [0, 5, 5, 9]
    listings = [[(k, h) for k in keys if rng.random() < 0.3] for h in times]
    seen = {k for rows in listings for k, _ in rows}
    listings[-1] += [(k, 9) for k in keys if k not in seen]
    for rows in listings:
        rng.shuffle(rows)
        take(spark, str(tmp_path), rows)
    want = lookups.unverified_logs(spark.createDataFrame([(k,) for k in keys], "key string"))
    assert take(spark, str(tmp_path), [(None, 100)]) == sorted(r.key for r in want.collect())


@pytest.mark.parametrize("buckets", [1, 3])
def test_names_of_one_group_of_state_keep_their_own_times(spark, tmp_path, buckets):
    """Entries of state follow the groups, not the names; logs of a group fall due apart, and other keys leave no state."""
    path, check = str(tmp_path), "{}-backup-verification.csv".format
    triggers = [
        [(f"n{i}-backup.csv", i % 7) for i in range(60)] + [(f"x{i}.txt", 6) for i in range(50)],
        [(check(f"n{i}"), 10) for i in range(0, 60, 3)] + [(f"n{i}-backup.csv", 10) for i in range(60)],
        [(None, 28)], [(None, 29)], [(check("n1"), 60), ("n1-backup.csv", 60)], [(None, 200)],
    ]
    seen = []
    for rows in triggers:
        data = spark.createDataFrame([(k, START + h * HOUR) for k, h in rows], "key string, listed_us long")
        data.coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(data.schema).parquet(f"{path}/in")
        query = progress.start_new_logs(stream, f"{path}/out", f"{path}/log", wait_us=24 * HOUR, buckets=buckets)
        query.awaitTermination()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= buckets
        found = spark.read.schema("key string").option("recursiveFileLookup", True).parquet(f"{path}/out")
        seen.append(sorted(r.key for r in found.collect()))
    due = lambda hour: sorted(f"n{i}-backup.csv" for i in range(60) if i % 3 and i % 7 < hour - 24)
    assert seen == [[], [], due(28), due(29), due(60), due(200)] and len(seen[-1]) == 40


@pytest.mark.parametrize("seed", [1, 2])
def test_growth_in_any_order(spark, tmp_path, seed):
    rng = random.Random(seed)
    schema = "store string, taken_us long, files long, bytes long"
    rows = {(s, t): (s, t, rng.randrange(1000), rng.randrange(10**9)) for s in "ab" for t in rng.sample([-5, 0, 1, 255, 256, 257, 65_535, 65_536, 10**15, 10**15 + 1, *range(10**6, 10**6 + 40)], 30)}
    order = list(rows.values())
    rng.shuffle(order)
    parts = [order[:1], order[1:20], order[20:45], order[45:]]
    corrected = ("a", order[0][1], 7, 7) if order[0][0] == "a" else ("b", order[0][1], 7, 7)
    parts[2] = [*parts[2], corrected]  # a snapshot given again, with other totals
    rows[corrected[:2]] = corrected
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        progress.start_growth(stream, f"{tmp_path}/out", f"{tmp_path}/log", "store").awaitTermination()
    whole = spark.createDataFrame(list(rows.values()), schema)
    want = stats.growth(whole.withColumnRenamed("store", "series"), ["series"]).collect()
    found = progress.read_growth(spark, f"{tmp_path}/out", ["series"]).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, want)) and len(found) == 58
    totals = progress.read_totals(spark, f"{tmp_path}/out").filter("series = 'a'")
    shares = {r.taken_us: r.percent_used for r in progress.quota_watch(totals.select("taken_us", "files", "bytes"), 10**9).collect()}
    assert shares == {t: b / 10**7 for (s, t), (_, _, _, b) in rows.items() if s == "a"}


def test_a_trigger_writes_its_changes_only(spark, tmp_path):
    """Late snapshots change two rows each: their own, and that of the next one."""
    schema = "taken_us long, files long, bytes long"
    for part in ([(t, t, t) for t in range(0, 1000, 10)], [(15, 15, 15), (500, 1, 1)], [(2000, 5, 5)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        progress.start_growth(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/log").awaitTermination()
    written = [spark.read.parquet(f"{tmp_path}/out/batch={n}") for n in range(3)]
    assert written[0].count() == 100
    assert sorted((r.taken_us, r._t) for r in written[1].collect()) == [(15, 10), (20, 15), (500, 490), (510, 500)]
    assert [(r.taken_us, r._t) for r in written[2].collect()] == [(2000, 990)]


class Entries(dict):
    """State entries in memory that count what is read."""

    reads = 0

    def getValue(self, key):
        Entries.reads += 1
        return self.get(key)

    def containsKey(self, key):
        Entries.reads += 1
        return key in self

    def updateValue(self, key, value):
        self[key] = value


def test_state_read_per_snapshot_does_not_grow():
    rng = random.Random(0)
    one = SimpleNamespace(n=None)
    value = SimpleNamespace(exists=lambda: one.n is not None, get=lambda: one.n, update=lambda x: setattr(one, "n", x))
    state = progress.Neighbours()
    state.init(SimpleNamespace(getMapState=lambda *_: Entries(), getValueState=lambda *_: value))
    known, cost = [], {}
    for n in range(20_000):
        time, before = rng.randrange(10**15), Entries.reads
        rows = list(state.handleInputRows(("",), iter([SimpleNamespace(taken_us=time, files=n, bytes=n)]), None))
        cost[n] = Entries.reads - before
        known.append(time)
        if n % 500 == 0:
            earlier, later = [t for t in known if t < time], [t for t in known if t > time]
            assert [(r.taken_us, r._t) for r in rows] == [(time, max(earlier, default=None))] + ([(min(later), time)] if later else [])
    assert max(cost.values()) <= 70 and max(list(cost.values())[-100:]) <= max(list(cost.values())[:2000])


def test_empty_stream(spark, tmp_path):
    schema = "taken_us long, files long, bytes long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/in")
    progress.start_growth(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/log").awaitTermination()
    spark.createDataFrame([], progress.PAIRED).write.parquet(f"{tmp_path}/out/none")
    assert progress.read_growth(spark, f"{tmp_path}/out").count() == 0
