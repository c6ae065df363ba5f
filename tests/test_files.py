"""Jobs that read and write files: listing, packing, unpacking, actions, text logs, streams."""

import hashlib
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from invspark import schemas
from invspark.operators import batching, runs
from invspark.plans import actions, archive, upload
from invspark.sources import listing, tables, text
from invspark.streaming import progress


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "tree"
    for i in range(30):
        folder = root / f"d{i % 3}" / f"e{i % 5}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"f{i}.txt").write_bytes(os.urandom(10 + 37 * i))
    (root / "d0" / "link").symlink_to("e0/f0.txt")
    (root / "d2" / "empty").mkdir()
    return root


def test_walk_and_freeze(spark, tree):
    entries = listing.walk_tree(spark, str(tree))
    want = {str(p) for p in tree.rglob("*") if not p.is_dir()}
    files = entries.filter("not is_dir")
    assert {r["path"] for r in files.collect()} == want
    link = entries.filter("is_link").first()
    assert link["link_target"] == str(tree / "d0" / "e0" / "f0.txt") and link["size"] == 0
    frozen = listing.freeze(entries, str(tree), "dest").orderBy("ord").collect()
    assert [r["ord"] for r in frozen] == list(range(len(want)))
    assert [r["path"] for r in frozen] == sorted(want)
    assert frozen[0]["object_name"] == "dest/" + os.path.relpath(frozen[0]["path"], tree)


def test_walk_skips_folders(spark, tree):
    skip = spark.createDataFrame([(str(tree / "d1"),)], "folder string")
    found = listing.walk_tree(spark, str(tree), skip)
    assert found.filter(F.contains("path", F.lit("/d1"))).isEmpty()


def test_spark_listing(spark, tree):
    found = listing.list_files(spark, str(tree / "d1"))
    assert found.count() == len([p for p in (tree / "d1").rglob("*") if p.is_file()])


def test_listing_passes_the_driver_by(spark, tree):
    """A listing that the driver holds takes its memory with the number of files; inputFiles() names what it holds."""
    found = listing.list_files(spark, str(tree))
    assert found.count() == len([p for p in tree.rglob("*") if p.is_file()])
    assert not [f for f in found.inputFiles() if f.startswith(f"file://{tree}/")]


def test_listing_is_that_of_spark(spark, tmp_path, monkeypatch):
    """Hidden and odd names, links, empty files and times, by tasks as by Spark's own listing, which other places are left to."""
    root = tmp_path / "t r%20ee"
    names = ("f.txt", "_f", ".f", "_f=1", "_metadata.txt", "_metadata=1", "_common_metadata", "g._COPYING_", "_metadata=._COPYING_", "h \u00fc", "i%20j", "k#l", ".n=1", "q*r", "[s]", "empty")
    for folder in ("a", "a/b c", "_d", ".d", "_d=1", "_metadata", "_common_metadata_", "x._COPYING_", "\u00fc", "p=1", "q?w"):
        (root / folder).mkdir(parents=True)
        for i, name in enumerate(names):
            (root / folder / name).write_bytes(b"x" * (0 if name == "empty" else i + 1))
    (root / "a" / "file").symlink_to("f.txt")
    (root / "a" / "folder").symlink_to("b c")
    (root / "a" / "lost").symlink_to("nowhere")
    (root / "round").symlink_to("round")
    (root / "none").mkdir()
    os.makedirs(os.fsencode(root) + b"/bad\xff")
    open(os.fsencode(root) + b"/bad\xff/x", "w").close()
    os.utime(root / "a" / "f.txt", ns=(1_234_567_891_999, 1_234_567_891_999))

    def rows(where):
        found = listing.list_files(spark, where)
        return sorted(tuple(r) for r in found.collect()), found.dtypes

    places = [str(root), f"{root}/", f"file://{root}", str(root / "_d"), str(root / "none"), str(root / "a" / "f.txt"), f"{root}/p=*"]
    by_tasks = [rows(where) for where in places]
    monkeypatch.setattr(listing, "_mounted_folder", lambda spark, root: None)
    assert by_tasks == [rows(where) for where in places]
    assert len(by_tasks[0][0]) > 60
    monkeypatch.undo()
    for where in (str(root / "nothing"), f"{root}/nothing*"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            listing.list_files(spark, where)


def test_pack_and_unpack_files(spark, tree, tmp_path):
    entries = listing.walk_tree(spark, str(tree)).filter("not is_link")
    files = listing.freeze(entries, str(tree), "dest")
    plan = batching.roll_up(batching.assign_batches(files, 3000, 8), "dest").cache()
    gone = plan.select(F.explode("members").alias("m")).select("m.path").orderBy("path").first()["path"]
    content = {os.path.relpath(p, tree): p.read_bytes() for p in tree.rglob("*") if p.is_file() and not p.is_symlink()}
    os.remove(gone)
    content.pop(os.path.relpath(gone, tree))
    out = str(tmp_path / "out")
    packed = archive.pack_files(plan, out, "dest", compress=True).collect()
    assert sum(r["n_members"] for r in packed) == len(content) and sum(r["n_skipped"] for r in packed) == 1
    assert all(hashlib.md5(open(f"{out}/{r['zip_key']}", "rb").read()).hexdigest() == r["md5"] for r in packed)
    assert not [f for _, _, names in os.walk(out) for f in names if f.endswith(".partial")]
    members = archive.unpack_files(plan, out, keep_content=True).collect()
    assert {r["member"]: bytes(r["content"]) for r in members} == content
    assert all(r["md5"] == hashlib.md5(content[r["member"]]).hexdigest() for r in members)
    plain = archive.unpack_files(plan, out).collect()
    assert {(r["member"], r["size"], r["md5"]) for r in plain} == {(r["member"], r["size"], r["md5"]) for r in members}


def test_apply_actions(spark, tmp_path):
    root = tmp_path / "store"
    (root / "a").mkdir(parents=True)
    for name in ("x", "y"):
        (root / "a" / name).write_text(name)
    plan = spark.createDataFrame(
        [("copy", "a/x", "b/c/x"), ("delete", "a/y", None), ("delete", "a/none", None), ("copy", "a/none", "b/n"), ("keep", "a/x", None)],
        "action string, key string, target string",
    )
    for _ in range(2):  # a repeated run ends the same way
        got = {(r["action"], r["key"]): r["status"] for r in archive.apply_actions(plan, str(root)).collect()}
        assert got == {("copy", "a/x"): "done", ("delete", "a/y"): "done", ("delete", "a/none"): "done", ("copy", "a/none"): "failed", ("keep", "a/x"): "kept"}
    assert (root / "b/c/x").read_text() == "x" and not (root / "a/y").exists()


def test_digests_report_missing_files(spark, tmp_path):
    (tmp_path / "f").write_bytes(b"abc")
    df = spark.createDataFrame([(str(tmp_path / "f"),), (str(tmp_path / "no"),)], "path string")
    got = {os.path.basename(r["path"]): (r["size"], r["md5"], r["error"]) for r in archive.digest_files(df).collect()}
    assert got == {"f": (3, hashlib.md5(b"abc").hexdigest(), None), "no": (None, None, "FileNotFoundError")}


def test_text_lines_keep_their_order(spark, tmp_path):
    lines = [f"{i}.00 MiB uploaded in 1.00 seconds, {i}.00 MiB/s" for i in range(500)]
    for name in ("a.log", "b.log"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = text.read_lines(spark, str(tmp_path)).orderBy("file", "line_no").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r["value"] for r in found] == lines * 2
    assert len({(r["file"], r["line_no"]) for r in found}) == 1000


def test_line_forms(spark):
    rows = [
        "8.00 MiB uploaded in 2.00 seconds, 4.00 MiB/s",
        "5 files (avg 6.00 MiB/file) uploaded in 1.50 seconds, 0.30 s/file",
        "Finished at 2001-02-03 04:05:06.000007, elapsed time = 0:01:40.250000",
        "Total: 20 files; 1000.00 MiB; 10.00 MiB/s including setup time; 5.00 s/file including setup time",
        "something else",
    ]
    df = spark.createDataFrame([("r", i, v) for i, v in enumerate(rows)], schemas.RUN_LOG)
    got = [tuple(r)[3:] for r in runs.parse_lines(df).orderBy("line_no").collect()]
    assert got == [
        ("transfer", 8.0, 2.0, 4.0, None, None, None), ("folder", None, 1.5, None, 0.3, 5, None),
        ("finished", None, None, None, None, None, 100_250_000), ("total", 1000.0, None, 10.0, 5.0, 20, None),
    ]


def test_csv_log(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(
        "LOCAL_FOLDER,LOCAL_PATH,FILE_SIZE,BUCKET_NAME,DESTINATION_KEY,CHECKSUM,ZIP_CONTENTS,FILES_PER_ZIP,UPLOAD_TIME,UPLOAD_START,UPLOAD_END\n"
        "/d,/d/a,10,b,k1,c,n/a,n/a,1.5,2024-01-01 00:00:00,2024-01-01 00:00:01.500000\n"
        '/d,/d/z.zip,20,b,k2,c,"m1,m2|m3",2,n/a,2024-01-01 00:00:00.5,2024-01-01 00:00:02\n'
        "/d,/d/bad,30,b,k3,c,n/a,n/a,,n/a,2024-01-01 00:00:02\n"
    )
    got = tables.read_upload_log(spark, str(path)).orderBy("LOCAL_PATH").collect()
    assert [(r["LOCAL_PATH"], r["FILES_PER_ZIP"], r["UPLOAD_TIME"]) for r in got] == [("/d/a", None, 1.5), ("/d/z.zip", 2, None)]
    assert [r["end_us"] - r["start_us"] for r in got] == [1_500_000, 1_500_000]


def test_resume_reuses_the_saved_plan(spark, tmp_path):
    store = spark.createDataFrame([("collated_1.zip",)], "key string")
    fresh = spark.createDataFrame([(1, "collated_1.zip"), (2, "collated_2.zip")], "id long, zip_key string")
    where = str(tmp_path / "plan")
    assert [r["id"] for r in upload.resume(where, lambda: fresh, store).collect()] == [2]
    assert [r["id"] for r in upload.resume(where, lambda: pytest.fail("saved plan ignored"), store).collect()] == [2]


def test_stream_adds_up_over_batches(spark, tmp_path):
    source = str(tmp_path / "in")
    for n in range(3):
        spark.createDataFrame([(10 * (n + 1), "2"), (1, "n/a")], "FILE_SIZE long, FILES_PER_ZIP string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("FILE_SIZE long, FILES_PER_ZIP string").option("maxFilesPerTrigger", 1).parquet(source)
    progress.start_progress(stream, str(tmp_path / "totals"), str(tmp_path / "cp"), 18).awaitTermination()
    assert tuple(spark.read.parquet(str(tmp_path / "totals")).first()) == (6, 9, 63, 0.5)


def test_late_snapshots_correct_earlier_rows(spark, tmp_path):
    out, source, log = (str(tmp_path / n) for n in ("out", "in", "cp"))
    for batch in ([(0, 0), (10, 10)], [(5, 2), (12, 15)], [(20, 16)], [(11, 11)]):
        spark.createDataFrame([(t * 1_000_000, f, f) for t, f in batch], "taken_us long, files long, bytes long").write.mode("append").parquet(source)
        stream = spark.readStream.schema("taken_us long, files long, bytes long").parquet(source)
        progress.start_growth(stream, out, log).awaitTermination()
    found = {r["taken_us"] // 1_000_000: r["files_added"] for r in progress.read_growth(spark, out).collect()}
    assert found == {5: 2, 10: 8, 11: 1, 12: 4, 20: 1}


def test_manifest_stays_when_the_archive_does(spark, tmp_path):
    root = tmp_path / "s"
    (root / "z1.zip").mkdir(parents=True)  # a folder cannot be deleted as a file
    (root / "z1.zip" / "x").write_text("x")
    for name in ("z1.zip.metadata", "z2.zip", "z2.zip.metadata"):
        (root / name).write_text("m")
    verdicts = spark.createDataFrame([("z1.zip", 1, True), ("z2.zip", 1, True)], "zip_key string, total long, deletable boolean")
    done = {r["key"]: r["status"] for r in archive.apply_actions(actions.delete_archives(verdicts), str(root)).collect()}
    assert done == {"z1.zip": "failed", "z2.zip": "done"}
    assert sorted(p.name for p in root.iterdir()) == ["z1.zip", "z1.zip.metadata"]


def test_unreadable_archives_are_rows(spark, tmp_path):
    (tmp_path / "bad.zip").write_bytes(b"no archive" * 100)
    names = spark.createDataFrame([("bad.zip",), ("gone.zip",)], "zip_key string")
    assert {r["zip_key"]: r["error"] for r in archive.unpack_files(names, str(tmp_path)).collect()} == {"bad.zip": "BadZipFile", "gone.zip": "FileNotFoundError"}
    cells = spark.createDataFrame([("a", b"no archive"), ("b", None)], "zip_key string, content binary")
    assert {r["error"] for r in archive.unpack_contents(cells).collect()} == {"BadZipFile"}
    wanted = names.withColumn("member", F.lit("m"))
    assert {r["zip_key"]: r["status"] for r in archive.extract_files(wanted, str(tmp_path), str(tmp_path / "o")).collect()} == {"bad.zip": "failed", "gone.zip": "missing"}


def test_manifests_beside_archives_are_read_back(spark, tmp_path):
    root = str(tmp_path / "store root+")
    written = spark.createDataFrame([("b/collated_1.zip", "a.txt|b c.txt\n"), ("b/collated_2.zip", "x")], "zip_key string, text string")
    archive.write_manifests(written, root).collect()
    from invspark.sources import text

    found = {r["zip_key"]: r["text"] for r in text.read_manifests(spark, root).collect()}
    assert found == {"b/collated_1.zip": "a.txt|b c.txt", "b/collated_2.zip": "x"}


def test_move_then_delete_copied(spark, tmp_path):
    root = tmp_path / "s"
    root.mkdir()
    (root / "k").write_text("v")
    keys = spark.createDataFrame([("k",), ("missing",)], "key string")
    copies = actions.move(keys, "other")
    results = spark.createDataFrame(
        [tuple(r) for r in archive.apply_actions(copies, str(root)).collect()], "action string, key string, target string, status string, error string")
    archive.apply_actions(actions.delete_copied(copies, results), str(root)).collect()
    assert (root / "other/k").read_text() == "v" and not (root / "k").exists()


def test_bucket_configuration(spark, tmp_path):
    from invspark.sources import listing

    (tmp_path / "one.json").write_text('[\n {"name": "a", "description": "first"},\n {"name": "b"}\n]\n')
    assert [tuple(r) for r in listing.buckets(spark, str(tmp_path / "one.json")).collect()] == [("a", "first"), ("b", None)]


def test_file_work_is_not_dealt_by_bytes(spark, tmp_path):
    """Names of many files are few bytes; their work is spread over the tasks all the same."""
    for i in range(40):
        (tmp_path / f"f{i}").write_text("x")
    keys = spark.createDataFrame([(f"f{i}",) for i in range(40)], "key string").coalesce(1)
    copies = archive.apply_actions(actions.move(keys, "there"), str(tmp_path)).withColumn("task", F.spark_partition_id())
    assert copies.filter("status = 'done'").agg(F.countDistinct("task"), F.count("key")).first() == (4, 40)
    names = copies.select(F.concat(F.lit(f"{tmp_path}/"), "target").alias("path"))
    digests = archive.digest_files(names.distinct().coalesce(1)).withColumn("task", F.spark_partition_id())
    assert digests.filter("size = 1").agg(F.countDistinct("task"), F.count("path")).first() == (4, 40)


def test_archives_by_value_are_read_in_arrow_memory(spark, tmp_path):
    """A batch of archives is not copied into a frame; null, empty and damaged ones give their errors as before."""
    members = spark.createDataFrame([("a.zip", 0, "x", b"1"), ("a.zip", 1, "y", b""), ("b.zip", 0, "z", b"22")], "zip_key string, ord long, member string, content binary")
    odd = spark.createDataFrame([("n.zip", None), ("e.zip", b""), ("d.zip", b"PK damaged")], "zip_key string, content binary")
    found = archive.unpack_contents(archive.pack_contents(members).select("zip_key", "content").unionByName(odd))
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    rows = sorted((r.zip_key, r.member or "", r.size, r.content and bytes(r.content), r.error) for r in found.collect())
    assert rows == [
        ("a.zip", "x", 1, b"1", None), ("a.zip", "y", 0, b"", None), ("b.zip", "z", 2, b"22", None),
        ("d.zip", "", None, None, "BadZipFile"), ("e.zip", "", None, None, "BadZipFile"), ("n.zip", "", None, None, "BadZipFile"),
    ]
    written = archive.write_contents(members.select(F.col("member").alias("zip_key"), "content"), str(tmp_path))
    assert sorted(tuple(r) for r in written.collect()) == [("x", 1), ("y", 0), ("z", 2)]
    assert (tmp_path / "z").read_bytes() == b"22" and (tmp_path / "y").read_bytes() == b""
