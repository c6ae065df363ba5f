"""Training order: an exact round trip, fixed strides, resumed reads."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from invspark.llm import feistel, queries, shards

LAYOUT = shards.Layout(length=7, dtype="u2", end=60_000, pad=60_001, per_shard=5)


def test_round_trip(spark, tmp_path):
    docs = [list(range(i, i + i % 23)) for i in range(60)] + [None, []] + [list(range(500))]
    table = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "doc_id long, ids array<int>").repartition(3)
    table.write.parquet(f"{tmp_path}/docs")
    table = spark.read.parquet(f"{tmp_path}/docs")
    written = shards.write(table, f"file://{tmp_path}/out", b"k", LAYOUT)
    rows = shards.read(written).collect()
    assert sorted(r.slot for r in rows) == list(range(written.n)) == sorted(r["index"] for r in rows)
    assert [r.slot for r in sorted(rows, key=lambda r: r["index"])] != list(range(written.n))
    stream = np.concatenate([np.frombuffer(r.ids, "<u2") for r in sorted(rows, key=lambda r: r["index"])]).tolist()
    found, current = [], []
    for token in stream:
        if token == LAYOUT.end:
            found.append(current)
            current = []
        else:
            current.append(token)
    assert not current and sorted(found) == sorted(d or [] for d in docs)
    # Slot s stands in shard s // per_shard at a fixed offset.
    paths = {r.shard: r.path.removeprefix("file://") for r in written.shards.collect()}
    for row in rows:
        data = open(paths[row.slot // LAYOUT.per_shard], "rb").read()
        at = row.slot % LAYOUT.per_shard * LAYOUT.stride
        assert int.from_bytes(data[at : at + 4], "little") == row.n_tokens and data[at + 4 : at + 4 + 2 * row.n_tokens] == row.ids
    resumed = {r.slot: r.ids for r in shards.read(written, from_slot=8).collect()}
    assert resumed == {r.slot: bytes(r.ids) for r in rows if r.slot >= 8}
    slots = feistel.Slots(b"k", written.n)
    assert all(slots.slot(np.array([r["index"]]))[0] == r.slot for r in rows)


def test_empty_and_ids_out_of_range(spark, tmp_path):
    empty = spark.createDataFrame([], "ids array<int>")
    assert shards.read(shards.write(empty, f"file://{tmp_path}/a", b"k", LAYOUT)).count() == 0
    with pytest.raises(Exception, match="do not fit"):
        shards.write(spark.createDataFrame([([70_000],)], "ids array<int>"), f"file://{tmp_path}/b", b"k", LAYOUT)


def test_query_holds_every_text(spark):
    sf = "/root/testdata/sf0.001"
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    rows = queries.QUERIES["op6_training_order"](spark, sf).collect()
    assert sum(r.n_tokens for r in rows) == sum(len(t.encode()) + 1 for t in texts)
    import hashlib

    stream = b"".join(t.encode() + b"\xff" for t in texts)
    wanted = [hashlib.sha256(stream[i : i + 2048]).hexdigest() for i in range(0, len(stream), 2048)]
    assert [r.ids_sha256 for r in sorted(rows, key=lambda r: r["index"])] == wanted
