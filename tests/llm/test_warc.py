"""Archives: round trip, revisits, framing, digests and damaged members."""

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from invspark.llm import queries, warc


def schema():
    return "page_id long, url string, html string, Path string"


def written(spark, tmp_path, rows, **how):
    pages = spark.createDataFrame(rows, schema())
    return warc.write(pages, f"file://{tmp_path}/w", **how)


def test_round_trip_and_revisits(spark, tmp_path):
    big, other = "x" * 100, "ü" * 60
    rows = [(3, "http://a/ b\r\nX: y", big, "p"), (1, None, big, None), (2, "u", big, "p"), (4, "u", "x" * 99, "p"), (5, "u", "x" * 99, "p"),
            (6, "u", None, "p"), (7, "u", "", "p"), (8, "u", other, "p"), (8, "u", other, "p"), (None, "u", big, "p"), (None, "u", "only" * 50, "p"), (9, "u", "z" * 300_000, "p")]
    archives = written(spark, tmp_path, rows)
    assert archives.agg(F.sum("records")).first()[0] == len(rows)
    found = warc.read(archives).collect()
    text = {(r.id, r.record_type, r.refers_to): r.payload for r in found}
    assert not [r.error for r in found if r.error] and len(found) == len(rows)
    assert text[1, "response", None] == big.encode() and text[3, "revisit", 1] is None and text[2, "revisit", 1] is None
    assert text[None, "revisit", 1] is None and text[None, "response", None] == b"only" * 50
    assert text[4, "response", None] == text[5, "response", None] == b"x" * 99
    assert text[6, "response", None] == text[7, "response", None] == b""
    assert sum(r.id == 8 and r.record_type == "response" for r in found) == 2
    assert text[9, "response", None] == b"z" * 300_000
    by = {r.id: r for r in found}
    assert by[3].payload_bytes == 100 and by[3].payload_digest == hashlib.sha256(big.encode()).hexdigest()
    assert by[3].url == "http://a/%20b%0D%0AX:%20y" and by[1].url is None


def test_archives_are_bounded_and_empty_tables_write_none(spark, tmp_path):
    rows = [(i, "u", f"{i}-" + "".join(chr(33 + (i * j) % 90) for j in range(900)), "p") for i in range(60)]
    archives = written(spark, tmp_path, rows, size=2000).collect()
    assert len(archives) > 8 and sum(r.records for r in archives) == 60
    assert written(spark, tmp_path, []).count() == 0
    assert warc.read(written(spark, tmp_path, [])).count() == 0


def archive(*payloads):
    return [warc.record(i, "u", p, hashlib.sha256(p).hexdigest(), None, "2020-01-01T00:00:00Z") for i, p in enumerate(payloads)]


def read(data):
    return list(warc.records(io.BytesIO(data), keep_payload=True))


def test_one_member_per_record():
    parts = archive(b"one" * 50, b"", b"three")
    for part in parts:
        assert gzip.decompress(part).startswith(b"WARC/1.1\r\n")
    found = read(b"".join(parts))
    assert [r["payload"] for r in found] == [b"one" * 50, b"", b"three"]
    assert [r["offset"] for r in found] == [0, len(parts[0]), len(parts[0]) + len(parts[1])]


@pytest.mark.parametrize("damage", ["bits", "cut", "digest", "length", "joined"])
def test_damaged_members_give_rows_and_reading_goes_on(damage):
    one, two, three = archive(b"a" * 4000, bytes(range(256)) * 40, b"c" * 10)
    if damage == "bits":
        two = two[:60] + bytes([two[60] ^ 255]) + two[61:]
    elif damage == "cut":
        two = two[: len(two) // 2]
    elif damage == "digest":
        two = gzip.compress(gzip.decompress(two).replace(b"\x00\x01\x02", b"\x00\x00\x02", 1))
    elif damage == "length":
        two = gzip.compress(gzip.decompress(two).replace(b"WARC-Date", b"X", 1).replace(b"Content-Length: 103", b"Content-Length: 993", 1))
    else:
        two = gzip.compress(gzip.decompress(two) + b"more")
    found = read(one + two + three)
    assert [r.get("id") for r in found] == [0, None, 2]
    assert found[1]["error"] and found[1]["offset"] == len(one)


def test_missing_archive_is_a_row(spark, tmp_path):
    names = spark.createDataFrame([(f"file://{tmp_path}/none.warc.gz",)], "path string")
    (row,) = warc.read(names).collect()
    assert "FileNotFoundError" in row.error and row.id is None


def test_query(spark):
    assert queries.QUERIES["op2_warc"](spark, "/root/testdata/sf0.001").count() == 50
