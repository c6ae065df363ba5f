"""The tree and manifest data sources against the walk of the same tree."""

import os

import pytest
from pyspark.sql import functions as F

from invspark.plans import archive
from invspark.sources import listing, text, tree


@pytest.fixture
def root(spark, tmp_path):
    top = tmp_path / "t"
    for i in range(40):
        path = top / f"d{i % 3}" / f"e{i % 5}" / ("g/h" if i % 2 else "") / f"f{i}.txt"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * i * 10)
    (top / "loose").write_text("at the top")
    (top / "d0" / "link").symlink_to("e0/f0.txt")
    (top / "d1" / "folder link").symlink_to("../d0")
    (top / "empty").mkdir()
    tree.register(spark)
    return str(top)


def rows(df):
    return sorted((r.path, r.is_dir, r.is_link, r.link_target, r.size, r.modified_us) for r in df.collect())


@pytest.mark.parametrize("depth", [0, 1, 2, 9])
def test_equals_the_walk(spark, root, depth):
    assert rows(spark.read.format("tree").option("depth", depth).load(root)) == rows(listing.walk_tree(spark, root))


def test_filters_reach_the_source(spark, root):
    walked = listing.walk_tree(spark, root)
    cut = walked.agg(F.percentile_approx("modified_us", 0.5)).first()[0]
    for condition in (f"path like '{root}/d1/%'", "size > 100", f"size >= 50 and modified_us <= {cut}", f"path like '{root}/d2/e1%' and size < 200", "size = 0 and not is_dir", "is_link", f"path like '{root}/no/%'"):
        assert rows(spark.read.format("tree").load(root).filter(condition)) == rows(walked.filter(condition))
    wanted = F.startswith("path", F.lit(f"{root}/d1/")) & (F.col("size") > 100)
    assert rows(spark.read.format("tree").load(root).filter(wanted)) == rows(walked.filter(wanted))
    above = spark.read.format("tree").load(root).filter(wanted)._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]
    assert "StartsWith" not in above and ">" not in above  # neither is left to decide above the scan
    reader = tree.TreeReader({"path": root, "depth": "1"})
    reader.wanted = tree.Wanted(prefixes=(f"{root}/d1/e",))
    assert [f.path for f in reader.partitions()] == [root, f"{root}/d1"]


def test_stream_gives_each_change_once(spark, root, tmp_path):
    def found():
        stream = spark.readStream.format("tree").option("lag_us", 0).load(root)
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/log").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
        return spark.read.schema(tree.ENTRIES).parquet(f"{tmp_path}/out")

    assert rows(found()) == rows(listing.walk_tree(spark, root))
    before = found().count()
    assert before == listing.walk_tree(spark, root).count()
    with open(f"{root}/d0/new.txt", "w") as out:
        out.write("later")
    os.utime(f"{root}/d0/new.txt", (0, 0))  # an old time of its own does not hide it
    after = found()
    assert after.count() >= before + 1 and after.filter("path like '%new.txt'").select("size", "modified_us").first() == (5, 0)


def test_folders_that_cannot_be_listed_are_rows(spark, tmp_path):
    tree.register(spark)
    assert [(r.path, r.error) for r in spark.read.format("tree").load(str(tmp_path / "none")).collect()] == [(str(tmp_path / "none"), "FileNotFoundError")]


def test_manifests(spark, tmp_path):
    where = str(tmp_path / "m")
    written = spark.createDataFrame([("b/collated_1.zip", "a.txt|b c.txt\n"), ("b/collated_2.zip", "x"), ("c/deep/er/collated_3.zip", "ü,y")], "zip_key string, text string")
    archive.write_manifests(written, where).collect()
    tree.register(spark)
    got = spark.read.format("manifests").load(where)
    want = sorted(tuple(r) for r in text.read_manifests(spark, where).select("zip_key", "text").collect())
    assert sorted(tuple(r) for r in got.collect()) == want
    assert [r.zip_key for r in got.filter(F.startswith("zip_key", F.lit("c/"))).collect()] == ["c/deep/er/collated_3.zip"]
