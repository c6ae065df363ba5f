"""Archives read by range and built by many tasks: round trips, damage, names that leave the folder, members beyond 4 GiB."""

import hashlib
import os
import random
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from invspark.operators import batching
from invspark.plans import archive, logs, ranges
from invspark.sources import listing, tables


def files_below(root):
    return {os.path.relpath(os.path.join(top, name), root): open(os.path.join(top, name), "rb").read() for top, _, names in os.walk(root) for name in names}


@pytest.fixture
def members(spark, tmp_path):
    """Files of many lengths, in two archives, with names that are no ASCII."""
    rng, rows = random.Random(3), []
    for i in range(60):
        path = tmp_path / "in" / f"f{i}"
        path.parent.mkdir(exist_ok=True)
        path.write_bytes(rng.randbytes(rng.choice([0, 1, 100, 4096, 8192, 20_000])) + b"x" * rng.choice([0, 5000]))
        rows.append((f"b/z{i % 2}.zip", i, f"d{i % 3}/mémbre {i}.txt", str(path), path.stat().st_size))
    return spark.createDataFrame(rows, "zip_key string, ord long, member string, path string, size long")


@pytest.mark.parametrize("compress", [True, False])
def test_built_by_many_tasks_equals_the_sequential_archive(spark, tmp_path, members, compress):
    out, rows = str(tmp_path / "out"), members.collect()
    pieces = ranges.deflate_pieces(members, str(tmp_path / "work"), compress, piece=4096)
    built = {r.zip_key: r for r in ranges.build_archives(pieces, out, compress, range_bytes=3000).collect()}
    assert {k: (r.n_members, r.n_skipped, r.status) for k, r in built.items()} == {f"b/z{i}.zip": (30, 0, "done") for i in (0, 1)}
    for key, r in built.items():
        assert os.path.getsize(f"{out}/{key}") == r.size
        with zipfile.ZipFile(f"{out}/{key}") as found:
            assert found.testzip() is None
            mine = [x for x in rows if x.zip_key == key]
            assert found.namelist() == [x.member for x in sorted(mine, key=lambda x: x.ord)]
            for x in mine:
                info, data = found.getinfo(x.member), open(x.path, "rb").read()
                assert found.read(x.member) == data and (info.CRC, info.file_size) == (zlib.crc32(data), len(data))
                assert info.compress_type == (zipfile.ZIP_DEFLATED if compress else zipfile.ZIP_STORED)
    assert sorted(files_below(out)) == ["b/z0.zip", "b/z1.zip"]


def test_unreadable_members_are_left_out(spark, tmp_path, members):
    rows = [tuple(r) for r in members.collect()]
    os.remove(rows[4][3])
    open(rows[7][3], "ab").write(b"grown")
    long = max((r for r in rows if r[0] == "b/z1.zip" and r[2] != rows[7][2]), key=lambda r: r[4])
    os.truncate(long[3], 10)  # shorter than listed, in an earlier piece
    rows.append(("none.zip", 0, "gone", str(tmp_path / "gone"), 5))
    df = spark.createDataFrame(rows, members.schema)
    pieces = ranges.deflate_pieces(df, str(tmp_path / "work"), piece=4096)
    built = {r.zip_key: (r.n_members, r.n_skipped, r.size > 0, r.status) for r in ranges.build_archives(pieces, str(tmp_path / "out")).collect()}
    assert built == {"b/z0.zip": (29, 1, True, "done"), "b/z1.zip": (29, 1, True, "done"), "none.zip": (0, 1, False, "empty")}
    assert {(r.zip_key, r.member) for r in ranges.skipped_members(pieces).collect()} == {(rows[4][0], rows[4][2]), (long[0], long[2]), ("none.zip", "gone")}
    with zipfile.ZipFile(tmp_path / "out" / "b/z1.zip") as found:
        assert found.testzip() is None and found.read(rows[7][2]).endswith(b"grown") and long[2] not in found.namelist()


def test_read_by_range_equals_the_sequential_reader(spark, tmp_path, members):
    out = str(tmp_path / "out")
    ranges.build_archives(ranges.deflate_pieces(members, str(tmp_path / "work")), out).collect()
    keys = spark.createDataFrame([("b/z0.zip",), ("b/z1.zip",), ("gone.zip",)], "zip_key string")
    index = ranges.index_archives(keys, out)
    assert index.filter("error is null").count() == 60 and index.filter("error is not null").first().error == "FileNotFoundError"
    want = {(r.zip_key, r.member, r.size, r.md5) for r in archive.unpack_files(keys.filter("zip_key <> 'gone.zip'"), out).collect()}
    found = ranges.unpack_ranges(index, out, 2000).collect()
    assert {(r.zip_key, r.member, r.size, r.md5) for r in found if r.status == "done"} == want and len(found) == 61
    assert [(r.zip_key, r.status) for r in found if r.status != "done"] == [("gone.zip", "missing")]
    target = str(tmp_path / "members")
    some = index.filter("member like '%1.txt' or error is not null")
    for _ in range(2):  # a repeated run ends the same way
        done = [r for r in ranges.extract_ranges(some, out, target, 2000).collect() if r.status == "done"]
    data = {f"b/{r.member}": open(r.path, "rb").read() for r in members.collect() if r.member.endswith("1.txt")}
    assert files_below(target) == data and {(f"b/{r.member}", r.md5) for r in done} == {(k, hashlib.md5(v).hexdigest()) for k, v in data.items()}


def test_tasks_share_one_archive(spark, tmp_path):
    """One large archive is dealt over many groups of ranges, not to one task."""
    data = random.Random(1).randbytes(50_000)
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as out:
        for i in range(100):
            out.writestr(f"m{i}", data)
    index = ranges.index_archives(spark.createDataFrame([("z.zip",)], "zip_key string"), str(tmp_path))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        held = ranges._dealt(index, 100_000).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(held) > 1 and sum(r["count"] for r in held) == 100


def test_damaged_ranges_are_rows(spark, tmp_path):
    rng = random.Random(5)
    with zipfile.ZipFile(tmp_path / "z.zip", "w", zipfile.ZIP_DEFLATED) as out:
        for i in range(20):
            out.writestr(f"m{i}", rng.randbytes(3000) + b"y" * 3000)
    with zipfile.ZipFile(tmp_path / "z.zip") as found:
        places = {i.filename: i.header_offset for i in found.infolist()}
    content = bytearray((tmp_path / "z.zip").read_bytes())
    content[places["m3"]] ^= 1  # a header
    content[places["m9"] + 600] ^= 1  # a member's bytes
    (tmp_path / "z.zip").write_bytes(bytes(content))
    index = ranges.index_archives(spark.createDataFrame([("z.zip",)], "zip_key string"), str(tmp_path))
    found = {r.member: r.status for r in ranges.extract_ranges(index, str(tmp_path), str(tmp_path / "o"), 5000).collect()}
    assert {m for m, status in found.items() if status == "failed"} == {"m3", "m9"} and len(found) == 20
    assert set(files_below(tmp_path / "o")) == {f"m{i}" for i in range(20)} - {"m3", "m9"}
    # The listed lengths are checked as well.
    wrong = index.filter("member = 'm5'").withColumn("size", F.col("size") - 1)
    assert ranges.unpack_ranges(wrong, str(tmp_path)).first().error == "BadMember"


HOSTILE = ["../../escaped.txt", "/abs.txt", "C:/drive.txt", "a\\..\\..\\b.txt", "..", "ok/../../x.txt", "a/../.."]


def test_names_that_leave_the_folder_are_refused(spark, tmp_path):
    root = tmp_path / "store"
    (root / "b").mkdir(parents=True)
    with zipfile.ZipFile(root / "b" / "z.zip", "w") as out:
        for name in [*HOSTILE, "fine/./f.txt", "fine//g.txt"]:
            info = zipfile.ZipInfo("x")
            info.filename = name
            out.writestr(info, name)
    keys = spark.createDataFrame([("b/z.zip",)], "zip_key string")
    index = ranges.index_archives(keys, str(root))
    names = [r.member for r in index.collect()]
    assert set(HOSTILE) <= set(names)
    for n, extract in enumerate((lambda to: archive.extract_files(index, str(root), to), lambda to: ranges.extract_ranges(index, str(root), to))):
        before = files_below(tmp_path)
        target = tmp_path / f"deep/out{n}"
        found = {r.member: (r.status, r.error) for r in extract(str(target)).collect()}
        assert {m for m, outcome in found.items() if outcome == ("failed", "UnsafeName")} == set(HOSTILE)
        assert files_below(target) == {"b/fine/f.txt": b"fine/./f.txt", "b/fine/g.txt": b"fine//g.txt"}
        assert set(files_below(tmp_path)) - set(before) == {f"deep/out{n}/b/fine/f.txt", f"deep/out{n}/b/fine/g.txt"}
    assert not [f for f in os.listdir("/") if f in ("abs.txt", "escaped.txt")]


def test_a_source_that_fails_while_read_is_skipped(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"a" * 10_000)
    (tmp_path / "b").write_bytes(b"b")
    rows = [(0, str(tmp_path / "a"), "d/a", 10_000), (1, "/proc/self/mem", "d/mem", 0), (2, str(tmp_path / "b"), "d/b", 1)]  # opens, but cannot be read
    files = spark.createDataFrame(rows, "ord long, path string, object_name string, size long")
    plan = batching.roll_up(batching.assign_batches(files, 1 << 20, 10), "d")
    packed = archive.pack_files(plan, str(tmp_path / "out"), "d", compress=True).first()
    assert (packed.n_members, packed.n_skipped, packed.members, packed.skipped) == (2, 1, "a|b", "mem")
    assert 0 < packed.start_us <= packed.end_us
    with zipfile.ZipFile(tmp_path / "out" / packed.zip_key) as found:
        assert found.testzip() is None and found.namelist() == ["a", "b"] and found.read("b") == b"b"


def test_log_rows_of_a_packing_job(spark, tmp_path):
    for name in "abcdefg":
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text(name)
    files = listing.freeze(listing.walk_tree(spark, str(tmp_path / "in")), str(tmp_path / "in"), "d")
    packed = archive.pack_files(batching.roll_up(batching.assign_batches(files, 1 << 20, 100), "d"), str(tmp_path / "out"), "d")
    tables.append_log(logs.packed_rows(packed, str(tmp_path / "out"), "bucket"), str(tmp_path / "log"))
    row = spark.read.parquet(str(tmp_path / "log")).first()
    data = open(row.LOCAL_PATH, "rb").read()
    assert (row.FILE_SIZE, row.CHECKSUM, row.FILES_PER_ZIP, row.ZIP_CONTENTS) == (len(data), hashlib.md5(data).hexdigest(), "7", "a|b|c|d|e abbreviated")
    assert tables.typed_log(spark.read.parquet(str(tmp_path / "log"))).count() == 1


def test_a_member_beyond_four_gib(spark, tmp_path):
    """Lengths and places that need 64 bits; the file is sparse and deflates to little."""
    size = (4 << 30) + 12_345
    with open(tmp_path / "big", "wb") as out:
        out.truncate(size)
    (tmp_path / "small").write_bytes(b"after")
    rows = [("z.zip", 0, "big", str(tmp_path / "big"), size), ("z.zip", 1, "small", str(tmp_path / "small"), 5)]
    df = spark.createDataFrame(rows, "zip_key string, ord long, member string, path string, size long")
    built = ranges.build_archives(ranges.deflate_pieces(df, str(tmp_path / "work"), piece=256 << 20), str(tmp_path / "out")).first()
    assert built.status == "done" and built.size < 20 << 20
    with zipfile.ZipFile(tmp_path / "out" / "z.zip") as found:
        assert found.getinfo("big").file_size == size and found.read("small") == b"after"
    index = ranges.index_archives(spark.createDataFrame([("z.zip",)], "zip_key string"), str(tmp_path / "out"))
    done = {r.member: (r.size, r.status) for r in ranges.unpack_ranges(index, str(tmp_path / "out")).collect()}  # the checksum of all is checked, too
    assert done == {"big": (size, "done"), "small": (5, "done")}


def test_checksums_of_pieces_join():
    rng = random.Random(9)
    for _ in range(30):
        parts = [rng.randbytes(rng.choice([0, 1, 7, 1000])) for _ in range(rng.randint(1, 6))]
        assert ranges.crc_of_joined([(len(p), zlib.crc32(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def test_empty_tables(spark, tmp_path, members):
    none = members.filter("false")
    pieces = ranges.deflate_pieces(none, str(tmp_path / "work"))
    assert ranges.build_archives(pieces, str(tmp_path / "out")).count() == 0
    index = ranges.index_archives(none, str(tmp_path))
    assert index.count() == 0 == ranges.unpack_ranges(index, str(tmp_path)).count()
