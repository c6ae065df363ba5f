"""One small table per rule that an ordinary row would not show."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from catalog import views
from invspark import session
from invspark.functions import manifests, names, paths, times, units, values
from invspark.operators import batching, folders, links, lookups, selection, stats
from invspark.plans import actions, segments, verify


def column(spark, rows, expression, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expression).collect()]


def test_manifest_separators(spark):
    rows = ["a|b,c|", "a;b;;", "a,b", "", None, "one"]
    got = column(spark, rows, manifests.parse(F.col("x")))
    assert got == [["a", "b,c"], ["a", "b"], ["a", "b"], [], None, ["one"]]


def test_members_of_root_archive_have_no_leading_slash(spark):
    df = spark.createDataFrame([("collated_1.zip", "a|b|a"), ("x/y/collated_2.zip", "c")], "zip_key string, text string")
    got = sorted(tuple(r) for r in verify.explode_members(df).collect())
    assert got == [("collated_1.zip", 2, "a"), ("collated_1.zip", 2, "b"), ("x/y/collated_2.zip", 1, "x/y/c")]


def test_abbreviation(spark):
    assert column(spark, ["a|b|c|d|e", "a|b|c|d|e|f"], manifests.abbreviate(F.split("x", "[|]"))) == ["a|b|c|d|e", "a|b|c|d|e abbreviated"]


def test_key_classes(spark):
    keys = ["p/collated_.zip", "p/collated_1.zip.metadata", "Collated_1.ZIP", "a\nb", "collated_12.zip", None]
    assert column(spark, keys, names.key_class(F.col("x"))) == ["other", "manifest", "other", "other", "zip", "other"]
    assert column(spark, keys, names.is_loose_zip(F.col("x"))) == [True, False, True, False, True, None]


def test_rebase(spark):
    base = F.lit("/rds/project/rds-abc")
    rows = ["/home/u/rds-iris-1/d/f", "/home/u/plain/f", "/h/rds-iris/x/rds-iris/y", "/h/not-rds-iris/f"]
    got = column(spark, rows, paths.rebase(F.col("x"), "rds-iris[^/]*", base))
    assert got == ["/rds/project/rds-abc/d/f", rows[1], "/rds/project/rds-abc/x/rds-iris/y", rows[3]]
    none = paths.base_up_to(F.lit("/no/base"), "rds-[^/]*")
    assert column(spark, rows[:1], paths.rebase(F.col("x"), "rds-iris[^/]*", none)) == rows[:1]


def test_paths(spark):
    assert column(spark, ["a/b/c", "c", "/c"], paths.parent_dir(F.col("x"))) == ["a/b", "", ""]
    assert column(spark, ["/a/b", "a"], paths.ancestors(F.col("x"))) == [["/a", "/a/b"], ["a"]]
    lines = ["  path: a/b.fits ", "- name: x", "path: !!tag c"]
    assert column(spark, lines, paths.line_path(F.col("x"), "/r/")) == ["/r/a/b.fits", None, "/r/c"]


def test_stamps_and_durations(spark):
    rows = ["2024-05-29 20:38:23.761037", "2024-05-29 20:38:23", "n/a", ""]
    got = column(spark, rows, times.micros(times.parse_stamp(F.col("x"))))
    assert got[0] - got[1] == 761037 and got[2:] == [None, None]
    assert column(spark, ["0:00:49.929613", "1:02:03", "x"], times.duration_us(F.col("x"))) == [49_929_613, 3_723_000_000, None]


def test_null_tokens_and_rates(spark):
    assert column(spark, ["n/a", "", "7", None], values.count_or_zero(F.col("x"))) == [0, 0, 7, 0]
    df = spark.createDataFrame([(1024**3, 8.0, 8_000_000), (5, 0.0, 0)], "size long, s double, us long")
    assert [r[0] for r in df.select(units.gibit_rate(F.col("size"), F.col("s"))).collect()] == [1.0, None]
    assert [r[0] for r in df.select(units.milli_rate(F.col("size"), F.col("us"))).collect()] == [1024**3 * 125, None]
    big = spark.createDataFrame([(2**50, 1_000_000)], "size long, us long")
    assert big.select(units.milli_rate(F.col("size"), F.col("us"))).first()[0] == 2**50 * 1000


def test_log_names(spark):
    rows = ["a-files.csv", "a-backup.csv", "a-backup-verification.csv", "a.txt"]
    assert column(spark, rows, names.log_class(F.col("x"))) == ["previous log", "log", "verification", None]
    assert column(spark, rows[:2], names.verification_twin(F.col("x"))) == ["a-backup-verification.csv"] * 2


def test_links(spark):
    rows = [
        (0, "/d/file", False, None, "o/file", 9), (1, "/d/one", True, "/d/file", "o/one", 0), (2, "/d/two", True, "/d/one", "o/two", 0),
        (3, "/d/loop1", True, "/d/loop2", "o/l1", 0), (4, "/d/loop2", True, "/d/loop1", "o/l2", 0),
        (5, "/d/gone", True, None, "o/gone", 0), (6, "/d/out", True, "/elsewhere/f", "o/out", 0), (7, "/d/self", True, "/d/self", "o/s", 0),
    ]
    df = spark.createDataFrame(rows, "ord long, path string, is_link boolean, link_target string, object_name string, size long")
    got = {r["object_name"]: (r["path"], r["size"], r["is_link"]) for r in links.follow(df).collect()}
    assert got == {
        "o/file": ("/d/file", 9, False), "o/one": ("/d/file", 9, False), "o/two": ("/d/file", 9, False), "o/out": ("/elsewhere/f", 0, False),
    }
    assert tuple(links.moved(links.path_pairs(df)).first()) == (8, 7)


def test_long_chain(spark):
    for n in (1, 30, 70, 1000):
        rows = [(f"/l{i}", f"/l{i + 1}") for i in range(n)]
        df = spark.createDataFrame(rows, "path string, link_target string")
        assert {r["target"] for r in links.resolve(df).collect()} == {f"/l{n}"}
    ring = [(f"/c{i}", f"/c{(i + 1) % 7}") for i in range(7)] + [("/in", "/c0"), ("/out", "/file")]
    found = {r["path"]: r["target"] for r in links.resolve(spark.createDataFrame(ring, "path string, link_target string")).collect()}
    assert found == {**{p: None for p, _ in ring}, "/out": "/file"}
    assert links.resolve(spark.createDataFrame([], "path string, link_target string")).count() == 0


def test_excluded_folders(spark):
    rows = [(0, "/a"), (1, "/a/b"), (2, "/ab"), (3, "/c")]
    df = spark.createDataFrame(rows, "ord long, folder string")
    gone = spark.createDataFrame([("/a",)], "folder string")
    assert {r["ord"] for r in selection.exclude_folders(df, gone).collect()} == {1, 2, 3}
    assert {r["ord"] for r in selection.exclude_folders(df, gone, subtree=True).collect()} == {2, 3}


def test_completeness_without_manifest(spark):
    zips = spark.createDataFrame([("z1",), ("z2",), ("z3",)], "zip_key string")
    members = spark.createDataFrame([("z1", "a"), ("z1", "b"), ("z2", "a"), ("z2", "x")], "zip_key string, member string")
    store = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "key string")
    got = {r["zip_key"]: tuple(r)[1:] for r in verify.completeness(zips, members, store).collect()}
    assert got == {"z1": (2, 2, False, True), "z2": (2, 1, True, False), "z3": (0, 0, True, False)}
    plan = {(r["action"], r["key"]) for r in actions.delete_archives(verify.completeness(zips, members, store)).collect()}
    assert plan == {("delete", "z1"), ("keep", "z2"), ("keep", "z3")}


def test_archives_do_not_count_as_members(spark):
    zips = spark.createDataFrame([("b/collated_1.zip",)], "zip_key string")
    members = spark.createDataFrame([("b/collated_1.zip", "b/collated_2.zip")], "zip_key string, member string")
    store = spark.createDataFrame([("b/collated_2.zip",)], "key string")
    assert not verify.completeness(zips, members, store).first()["deletable"]
    assert verify.completeness(zips, members, store, strict=False).first()["deletable"]


def test_statistics_of_doubles_and_null_keys(spark):
    values = [1e12, 2.5, -7.25, 3e10, 0.0, 1e-9, 2.5, float("nan"), None, -1e300, 4.0]
    rows = spark.createDataFrame([("a" if i % 2 else None, v) for i, v in enumerate(values)], "k string, v double")
    found = {r["k"]: r for r in stats.describe(rows, ["k"], "v").collect()}
    for key in ("a", None):
        want = pd.Series([v for i, v in enumerate(values) if v is not None and v == v and ("a" if i % 2 else None) == key])
        row = found[key]
        assert row["n"] == len(want) and row["min"] == want.min() and row["max"] == want.max()
        for name, q in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75)):
            assert row[name] == pytest.approx(want.quantile(q))
    bins = stats.histogram(rows.filter("v > -1e300"), ["k"], "v", 4).groupBy("k").agg(F.sum("n").alias("n")).collect()
    assert {r["k"]: r["n"] for r in bins} == {"a": 3, None: 5}
    assert stats.quantiles(rows, [], "v", [0.5], ["m"]).first()["m"] == 2.5


def test_unread_sizes_count_as_nothing(spark):
    rows = spark.createDataFrame([(0, 50), (1, None), (2, 60)], "ord long, size long")
    assert [r["batch"] for r in batching.assign_batches(rows, 10, 5).orderBy("ord").collect()] == [0, 1, 1]


def test_extract_and_deletable_never_agree(spark):
    zips = spark.range(200).select(F.concat(F.lit("z"), F.col("id").cast("string")).alias("zip_key"))
    members = spark.range(600).select(F.concat(F.lit("z"), (F.col("id") % 190).cast("string")).alias("zip_key"), F.col("id").cast("string").alias("member"))
    store = spark.range(400).select(F.col("id").cast("string").alias("key"))
    assert verify.completeness(zips, members, store).filter("extract = deletable").isEmpty()


def test_matching_manifests_ignores_supersets(spark):
    disk = spark.createDataFrame([("f1", "a"), ("f1", "b"), ("f2", "a"), ("f3", "c")], "folder string, member string")
    packed = spark.createDataFrame([("z1", "b"), ("z1", "a"), ("z2", "b"), ("z2", "a"), ("z3", "a"), ("z3", "b"), ("z3", "c")], "zip_key string, member string")
    assert [tuple(r) for r in lookups.matching_manifests(disk, packed).collect()] == [("f1", "z1")]


def test_verified_folders(spark):
    logged = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), ("c", "1")], "folder string, name string")
    local = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("c", "2"), ("d", "1")], "folder string, name string")
    assert {r["folder"]: r["verified"] for r in lookups.verified_folders(logged, local).collect()} == {"a": True, "b": False, "c": False}


def test_empty_all_and_any(spark):
    empty = spark.createDataFrame([], "x boolean")
    assert tuple(empty.agg(stats.all_true(F.col("x")), stats.any_true(F.col("x"))).first()) == (True, False)


@pytest.mark.parametrize("ages,removed", [
    ([0, 5], set()),                    # two logs: keep
    ([0, 0.5, 5], set()),               # three, but only two would remain
    ([0, 0.1, 0.5, 5], {"3"}),          # three remain
    ([0, 0.1, 0.5, 1.9], set()),        # not two whole days old
    ([0, 0.1, 0.5, 2.0], {"3"}),
    ([3, 4, 5, 6], set()),              # nothing would remain
])
def test_retention(spark, ages, removed):
    day = 86_400_000_000
    rows = [("/l", f"backup-logs-{i}.csv", int(100 * day - a * day)) for i, a in enumerate(ages)] + [("/l", "notes.txt", 0)]
    logs = spark.createDataFrame(rows, "folder string, name string, modified_us long")
    got = actions.retention(logs, F.lit(100 * day)).collect()
    assert {r["key"] for r in got} == {f"/l/backup-logs-{i}.csv" for i in removed}


def test_folder_advice_of_empty_tree(spark):
    row = folders.collation_advice(spark.createDataFrame([], "folder string, n_files long, bytes long")).first()
    assert (row["n_folders"], row["advice"], row["mean_mib"]) == (0, "not advised", 0.0)


def test_file_lists_are_bounded(spark):
    df = spark.range(1000).select(F.lit("/hot").alias("folder"), F.col("id").alias("ord"), F.col("id").cast("string").alias("name"))
    lists = folders.file_lists(df, per_list=100).orderBy("list_no").collect()
    assert [r["n"] for r in lists] == [100] * 10 and lists[1]["names"].startswith("100,101,")
    few = df.withColumn("folder", F.concat(F.lit("/f"), F.call_function("div", F.col("ord") + 1, F.lit(3)).cast("string")))
    assert folders.file_lists(few, per_list=100).count() == few.select("folder").distinct().count()


def test_segments(spark):
    df = spark.createDataFrame([("a", 0), ("b", 10), ("c", 25)], "key string, size long")
    got = [tuple(r) for r in segments.segments(df, 10).orderBy("key", "segment").collect()]
    assert got == [("a", 1, 1, 0, 0), ("b", 1, 1, 0, 10), ("c", 3, 1, 0, 10), ("c", 3, 2, 10, 20), ("c", 3, 3, 20, 25)]


def test_growth_without_new_files(spark):
    df = spark.createDataFrame([(0, 5, 100), (1_000_000, 5, 100)], "taken_us long, files long, bytes long")
    row = stats.growth(df).first()
    assert (row["files_added"], row["mib_s"], row["s_per_file"]) == (0, 0.0, 0.0)


def test_last_entry_wins(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, None), ("j", 1, "c")], "key string, ord long, v string")
    assert {r["key"]: r["v"] for r in stats.last_per_key(df, "key", "ord").collect()} == {"k": None, "j": "c"}


def test_resumable_actions(spark):
    plan = actions.with_plan_id(spark.createDataFrame([("delete", "a"), ("delete", "b")], "action string, key string"), "p1")
    done = spark.createDataFrame([("p1", "a", "delete", "done"), ("p1", "b", "delete", "failed")], "plan_id string, key string, action string, status string")
    assert [r["key"] for r in actions.undone(plan, done).collect()] == ["b"]


def test_tasks_of_matching_manifests_follow_the_rows(spark, monkeypatch):
    """What a task holds does not grow with the tables: distinct lines and sets of members go to as many tasks as their rows need."""
    lines = views.Tables(spark, "/root/testdata/sf0.001")
    rows = lines.table("lineitem").count()
    monkeypatch.setattr(session, "SPREAD_ROWS", 500)
    tasks = -(-rows // 500)
    assert tasks > 4 and lines.distinct_lines().rdd.getNumPartitions() == lines.packed.rdd.getNumPartitions() == tasks
    before = spark.conf.get("spark.sql.shuffle.partitions")
    seen = []
    monkeypatch.setattr(lookups, "materialise", lambda df, name: seen.append(spark.conf.get("spark.sql.shuffle.partitions")) or session.materialise(df, name))
    members = lines.packed.select(F.col("zip_key").alias("folder"), "member")
    found = lookups.matching_manifests(members, lines.packed, rows)
    assert seen == [str(tasks)] and spark.conf.get("spark.sql.shuffle.partitions") == before
    assert found.count() == lines.packed.select("zip_key").distinct().count() > 1000
