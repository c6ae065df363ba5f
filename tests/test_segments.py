"""Objects in segments: two-level checksums, and audits of altered, shortened, re-cut and missing objects."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from invspark.functions import values
from invspark.operators import lookups
from invspark.plans import segments


def etag(data, cut):
    parts = [hashlib.md5(data[i : i + cut]).digest() for i in range(0, max(len(data), 1), cut)]
    return parts[0].hex() if len(parts) == 1 else hashlib.md5(b"".join(parts)).hexdigest() + f"-{len(parts)}"


@pytest.fixture
def store(spark, tmp_path):
    """(sent bytes, stored bytes, store's cut) by key; files below tmp_path."""
    rng = random.Random(2)
    data = {name: rng.randbytes(n) for name, n in dict(same=2500, short=2500, long=2500, changed=2500, recut=2500, moved=1300, lone=80, empty=0, gone=1500, wrong=2500, exact=2000).items()}
    x = data["changed"]
    other = {"short": data["short"][:2200], "long": data["long"] + b"!", "changed": x[:1500] + bytes([x[1500] ^ 1]) + x[1501:], "gone": None}
    held = {name: (x, other.get(name, x), 700 if name in ("recut", "moved") else 1000) for name, x in data.items()}
    for name, (_, stored, _) in held.items():
        if stored is not None:
            (tmp_path / name).write_bytes(stored)
    sent = spark.createDataFrame([(name, len(x), str(tmp_path / name)) for name, (x, _, _) in held.items()], "key string, size long, path string")
    cut = segments.segments(sent, 1000).join(sent.select("key", "path"), "key")
    md5 = F.udf(lambda key, start, end: hashlib.md5(held[key][0][start:end]).hexdigest())
    logged = cut.select("key", "segment", "start", "end", md5("key", "start", "end").alias("md5"))
    rows = [(n, str(tmp_path / n), len(s), "0" * 32 + "-3" if n == "wrong" else etag(s, c)) for n, (_, s, c) in held.items() if s is not None]
    return held, logged, spark.createDataFrame(rows, "key string, path string, size long, etag string")


def test_audit(spark, store):
    held, logged, stored = store
    compared = segments.compare(logged, stored).cache()
    found = {r.key: (r.n_segments, r.n_differing, r.verdict) for r in segments.audit(compared, stored).collect()}
    assert found == {
        "same": (3, 0, "same"), "short": (3, 1, "altered"), "long": (3, 0, "altered"), "changed": (3, 1, "altered"), "recut": (3, 0, "re-cut"), "moved": (2, 0, "etag differs"),
        "lone": (1, 0, "same"), "empty": (1, 0, "same"), "gone": (2, 2, "missing"), "wrong": (3, 0, "etag differs"), "exact": (2, 0, "same"),
    }
    again = {(r.key, r.segment, r.start, r.end, r.error) for r in segments.differing(compared).collect()}
    assert again == {("short", 3, 2000, 2500, "EndsEarly"), ("changed", 2, 1000, 2000, None), ("gone", 1, 0, 1000, "missing"), ("gone", 2, 1000, 1500, "missing")}


def test_two_level_checksums_agree(spark, store):
    held, logged, stored = store
    joined = {r.key: (r.n_segments, r.etag) for r in segments.two_level(logged).collect()}
    cells = spark.createDataFrame([(name, x) for name, (x, _, _) in held.items()], "key string, content binary")
    by_cell = {r.key: (r.n, r.etag) for r in cells.select("key", values.segmented_etag(F.col("content"), 1000).alias("etag")).withColumn("n", values.segment_count(F.col("etag"))).collect()}
    assert joined == by_cell and {name: e for name, (_, e) in joined.items()} == {name: etag(x, 1000) for name, (x, _, _) in held.items()}


def test_a_file_that_goes_before_it_is_read(spark, store, tmp_path):
    held, logged, stored = store
    (tmp_path / "same").unlink()
    verdicts = {r.key: r.verdict for r in segments.audit(segments.compare(logged, stored), stored).collect()}
    assert verdicts["same"] == "unreadable" and verdicts["exact"] == "same"


def test_decisions(spark):
    members = spark.createDataFrame([(k, "m", "s-3") for k in "abcdef"], "key string, md5 string, segmented_etag string")
    remote = spark.createDataFrame([("a", "m"), ("b", "s-3"), ("c", "x-3"), ("d", "x-4"), ("e", "x")], "key string, etag string")
    found = {r.key: r.decision for r in lookups.sync_decision(members, remote).collect()}
    assert found == {"a": "skip", "b": "skip", "c": "replace", "d": "skip segmented", "e": "replace", "f": "upload"}
    assert {r.key: r.decision for r in lookups.sync_decision(members.drop("segmented_etag"), remote).collect()}["c"] == "skip segmented"


def test_empty_tables(spark, store):
    held, logged, stored = store
    none = logged.filter("false")
    assert segments.audit(segments.compare(none, stored), stored).count() == 0 == segments.two_level(none).count()
    gone = segments.audit(segments.compare(logged, stored.filter("false")), stored.filter("false"))
    assert {r.verdict for r in gone.collect()} == {"missing"}
