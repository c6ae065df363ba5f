"""Token ids in training order: fixed-stride shards addressed by slot.

Documents are packed into sequences of equal length, partition by partition;
sequence ``i`` of ``n`` goes to slot ``P(i)``, where P is a keyed permutation of
0 .. n - 1 (a Feistel network with cycle-walking). Slots are cut into ranges of
equal length; a task writes one range as a file of fixed-size records, so slot
``s`` stands in shard ``s // per_shard`` at ``(s % per_shard) * stride``. Reading
in training order is reading files from start to end, and can begin at any slot.

No order is stored and none is sorted globally: P places every sequence, and
its inverse tells which sequence a slot holds.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import materialise
from .feistel import Slots

#: Bytes before the ids of a record: how many of them are tokens.
HEADER = 4
SHARDS = "shard long, path string, first_slot long, n_slots long, bytes long"


@dataclass(frozen=True)
class Layout:
    """How sequences are written. ``end`` closes a document, ``pad`` fills a partition's last sequence."""

    length: int
    dtype: str
    end: int
    pad: int
    per_shard: int

    @property
    def stride(self) -> int:
        return HEADER + self.length * np.dtype(self.dtype).itemsize


@dataclass(frozen=True)
class Written:
    """``shards``: one row per shard (a written table). ``n``: the number of sequences, and so of slots."""

    shards: DataFrame
    layout: Layout
    n: int
    key: bytes


def _ids(column: pa.Array, dtype: str) -> Iterator[np.ndarray]:
    for value in column:
        if not value.is_valid:
            yield np.zeros(0, dtype)
        elif pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
            yield np.frombuffer(value.as_buffer(), dtype=dtype)
        else:
            ids = value.values.to_numpy(zero_copy_only=False)
            if len(ids) and not (np.iinfo(dtype).min <= ids.min() and ids.max() <= np.iinfo(dtype).max):
                raise ValueError(f"ids do not fit {dtype}")
            yield ids.astype(dtype)


def write(docs: DataFrame, folder: str, key: bytes, layout: Layout, ids: str = "ids") -> Written:
    """Pack, permute and write ``ids`` (array of ints, or binary: ids of ``layout.dtype`` in a row) of all rows of ``docs``.

    Null and empty lists are documents of no tokens: an ``end`` alone. Rows are packed in the order of their partition,
    which must be the same each time ``docs`` is computed, as in a scan of files; a task that meets another number of
    tokens than was counted fails. ``folder`` must be one that all executors reach. An empty table writes no shard.
    """
    column, size = docs.select(F.col(ids).alias("ids")), np.dtype(layout.dtype).itemsize
    if isinstance(docs.schema[ids].dataType, T.BinaryType):
        count = F.coalesce(F.octet_length("ids"), F.lit(0)) / size
    else:
        count = F.when(F.col("ids").isNull(), F.lit(0)).otherwise(F.size("ids"))
    # One number per partition: as many as there are tasks.
    counted = column.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(count.cast("long") + 1).alias("n")).collect()
    first, at = {}, 0
    for row in sorted(counted):
        first[row["p"]] = (at, row["n"])
        at += -(-row["n"] // layout.length)
    n, slots = at, Slots(key, at)
    shards = -(-n // layout.per_shard)

    def pack(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = total = index = None
        held: list[np.ndarray] = []
        size, seen, end = 0, 0, np.array([layout.end], layout.dtype)

        def out(final: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, size, index
            flat = np.concatenate(held)
            rows = len(flat) // layout.length
            tokens = np.full(rows, layout.length)
            if final and len(flat) % layout.length:
                tokens = np.append(tokens, len(flat) % layout.length)
                flat = np.concatenate([flat, np.full(-len(flat) % layout.length, layout.pad, layout.dtype)])
                rows += 1
            if rows:
                records = np.empty((rows, layout.stride), np.uint8)
                records[:, :HEADER] = tokens.astype("<u4").view(np.uint8).reshape(rows, HEADER)
                records[:, HEADER:] = flat[: rows * layout.length].astype(np.dtype(layout.dtype).newbyteorder("<")).view(np.uint8).reshape(rows, -1)
                places = slots.slot(np.arange(index, index + rows))
                index += rows
                data = pa.array([r.tobytes() for r in records], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array((places // layout.per_shard).astype(np.int32)), data], names=["slot", "shard", "record"])
            held = [flat[rows * layout.length :]]
            size = len(held[0])

        for part in parts:
            if not len(part):
                continue
            if index is None:
                start, total = first[part.column(1)[0].as_py()]
                index = start
            for document in _ids(part.column(0), layout.dtype):
                held += [document, end]
                size, seen = size + len(document) + 1, seen + len(document) + 1
                if size >= max(layout.length, 1 << 20):
                    yield from out(False)
        if index is not None:
            if size:
                yield from out(True)
            if seen != total:
                raise RuntimeError(f"a partition gave {seen} tokens, {total} were counted")

    def save(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        out, shard, begin, rows, name = None, None, 0, 0, ""

        def close() -> pa.RecordBatch:
            out.close()
            if rows != min(layout.per_shard, n - shard * layout.per_shard):
                raise RuntimeError(f"shard {shard} has {rows} records")
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (shard, f"{folder}/{name}", begin, rows, rows * layout.stride)], names=["shard", "path", "first_slot", "n_slots", "bytes"])

        for part in parts:
            for slot, record in zip(part.column(0).to_pylist(), part.column(1)):
                if slot // layout.per_shard != shard:
                    if out is not None:
                        yield close()
                    # A name of its own for each attempt; the table that comes back names those that counted.
                    shard, begin, rows = slot // layout.per_shard, slot, 0
                    name = f"shard-{shard:08d}-{uuid.uuid4().hex}.bin"
                    store.create_dir(top, recursive=True)
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                out.write(record.as_buffer())
                rows += 1
        if out is not None:
            yield close()

    packed = column.select("ids", F.spark_partition_id().alias("p")).mapInArrow(pack, "slot long, shard int, record binary")
    ranged = packed.repartitionById(max(1, shards), F.col("shard")).select("slot", "record").sortWithinPartitions("slot")
    return Written(materialise(ranged.mapInArrow(save, SHARDS), "shards"), layout, n, key)


def read(written: Written, from_slot: int = 0) -> DataFrame:
    """(slot, index, n_tokens, ids binary) from ``from_slot`` on: what a trainer would read, each shard from start to end.

    ``ids`` holds the record's tokens without padding; ``index`` is the sequence's place before the permutation.
    """
    layout, slots = written.layout, Slots(written.key, written.n)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for path, begin, rows in zip(*(part.column(c).to_pylist() for c in range(3))):
                store, place = fs.FileSystem.from_uri(path)
                with store.open_input_file(place) as stream:
                    skip = max(0, from_slot - begin)
                    stream.seek(skip * layout.stride)
                    at, step = begin + skip, max(1, (4 << 20) // layout.stride)
                    while at < begin + rows:
                        data = stream.read(layout.stride * min(step, begin + rows - at))
                        records = np.frombuffer(data, np.uint8).reshape(-1, layout.stride)
                        tokens = records[:, :HEADER].copy().view("<u4")[:, 0].astype(np.int64)
                        size = np.dtype(layout.dtype).itemsize
                        places = np.arange(at, at + len(records))
                        bodies = [r[HEADER : HEADER + k * size].tobytes() for r, k in zip(records, tokens.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(places), pa.array(slots.index(places)), pa.array(tokens), pa.array(bodies, pa.binary())], names=["slot", "index", "n_tokens", "ids"]
                        )
                        at += len(records)

    wanted = written.shards.filter(F.col("first_slot") + F.col("n_slots") > from_slot).select("path", "first_slot", "n_slots")
    tasks = max(1, -(-written.n // layout.per_shard))
    return wanted.repartition(tasks).mapInArrow(run, "slot long, index long, n_tokens long, ids binary")

