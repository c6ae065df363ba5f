"""Repeated lines: a line found in many documents stays only in one of them.

A line's key is the line without blanks at its ends, A to Z lower-cased. Per
document and key one row (a 128-bit hash, the document, the places of the lines)
is written. Rows are cut into ranges of (hash, document) and sorted inside by
hash, last document first; a task streams them, lets the first document of a
hash pass and drops the others once a further document proves the key frequent.
Ranges may cut a hash: a hash that a third of all documents share is dealt over
many tasks. What tasks must know of a hash cut by their edges is at most three
documents per edge, summed up before the pass.

The result is no text but one bitmap per document, a bit for each line, packed
as bits or as runs, whichever is shorter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, outside

MIN_CHARS = 20
MIN_DOCS = 3
#: Rows of one range; a row holds a hash, a document and a few places.
RANGE = 1 << 20
BLANKS = b" \t\n\x0b\x0c\r"
KEYS = "high long, low long, doc long, body long, places array<int>"
DROPPED = "doc long, body long, places array<int>"


def key_of(line: bytes) -> bytes:
    """What lines are compared by; ``bytes.lower`` changes A to Z only."""
    return line.strip(BLANKS).lower()


def _long_enough(key: bytes, least: int) -> bool:
    # A code point takes one to four bytes.
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def _marked(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(doc, body, text): ``body`` tells rows apart that bear the same id but hold different texts."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(id).cast("long").alias("doc"), F.xxhash64(body).alias("body"), body.alias("text"))


def _keys(parts: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        docs, bodies = part.column(0), part.column(1).to_pylist()
        rows, digests, places, ends = [], [], [], [0]
        for row, text in enumerate(part.column(2).cast(pa.large_binary())):
            found: dict[bytes, list[int]] = {}
            for place, line in enumerate(text.as_py().split(b"\n")):
                key = key_of(line)
                if _long_enough(key, least):
                    found.setdefault(hashlib.blake2b(key, digest_size=16).digest(), []).append(place)
            for digest, held in found.items():
                rows.append(row)
                digests.append(digest)
                places += held
                ends.append(len(places))
        halves = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(halves[:, 0]), pa.array(halves[:, 1]), docs.take(pa.array(rows, pa.int64())), pa.array([bodies[r] for r in rows], pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(places, pa.int32()))],
            names=["high", "low", "doc", "body", "places"],
        )


def _runs(part: pa.RecordBatch, last: tuple | None, rank: int):
    """Of a sorted part: where runs of one hash begin, where another document does, and each row's rank among the documents of its run.

    ``last`` and ``rank`` are those of the row before; both are returned as of the last row.
    """
    high, low = part.column("high").to_numpy(), part.column("low").to_numpy()
    known = part.column("doc").is_valid().to_numpy(zero_copy_only=False)
    doc = part.column("doc").fill_null(0).to_numpy()
    opens, other = np.ones(len(part), bool), np.ones(len(part), bool)
    opens[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    other[1:] = opens[1:] | (doc[1:] != doc[:-1]) | (known[1:] != known[:-1])
    if last is not None:
        opens[0] = last[:2] != (high[0], low[0])
        other[0] = opens[0] or last[2:] != (doc[0], known[0])
    count, starts = np.cumsum(other) + rank, np.nonzero(opens)[0]
    base = np.zeros(len(part), np.int64)
    base[starts] = count[starts] - 1
    ranks = count - np.maximum.accumulate(base)
    return starts, other, ranks, (high[-1], low[-1], doc[-1], known[-1]), int(ranks[-1])


def _edges(parts: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(high, low, doc) of the first and the last run of a range: at most ``least`` documents of each."""
    last, rank, first, current, schema = None, 0, [], [], None
    for part in (p for p in parts if len(p)):
        begun, rows = last is not None, part.select(["high", "low", "doc"])
        starts, other, ranks, last, rank = _runs(part, last, rank)
        told, schema = other & (ranks <= least), rows.schema

        def named(begin: int, end: int) -> list[pa.RecordBatch]:
            return [rows.take(pa.array(begin + np.nonzero(told[begin:end])[0]))]

        if not begun and len(starts) > 1:
            first = named(0, starts[1])
        elif begun:
            current += named(0, starts[0] if len(starts) else len(part))
            if len(starts) and not first:
                first = current
        if len(starts):
            current = named(starts[-1], len(part))
    if schema is not None:
        yield from pa.Table.from_batches(first + current, schema).combine_chunks().to_batches()


def _drop(parts: Iterable[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted range whose lines go. Of a hash at the range's edges, ``top`` and ``docs`` are given."""
    last, rank, held = None, 0, []
    for part in (p for p in parts if len(p)):
        begun = last is not None
        starts, _, ranks, last, rank = _runs(part, last, rank)
        place = np.arange(len(part))
        given = part.column("docs").is_valid().to_numpy(zero_copy_only=False)
        known = part.column("doc").is_valid().to_numpy(zero_copy_only=False)
        if not begun and not given[0]:
            raise RuntimeError("ranges are cut otherwise than when their edges were summed up")
        top = known & (part.column("doc").fill_null(0).to_numpy() == part.column("top").fill_null(0).to_numpy())
        # How many documents the run of each row has, as far as this part shows; the last run may go on.
        closing = np.append(starts[starts > 0] - 1, len(part) - 1)
        total = ranks[closing][np.searchsorted(closing, place)]
        gone = np.where(given, (part.column("docs").fill_null(0).to_numpy() >= least) & ~top, (ranks >= 2) & (total >= least))
        if held:
            continued = not len(starts) or starts[0] > 0
            if continued and total[0] >= least:
                yield from held
            if len(starts) or total[0] >= least:
                held = []
        out = part.select(["doc", "body", "places"])
        # No document comes after those without an id.
        wait = ~given & ~gone & known & (ranks >= 2) & (place >= (starts[-1] if len(starts) else 0))
        if wait.any():
            held.append(out.filter(pa.array(wait)))
        if gone.any():
            yield out.filter(pa.array(gone))


def dropped(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, body, places) of the lines that go, a row per document and key.

    A range holds the rows of at most ``min_docs`` - 1 documents of one key back until the key is known to be frequent.
    """
    spark = docs.sparkSession
    keys = materialise(_marked(docs, id, text).mapInArrow(lambda parts: _keys(parts, min_chars), KEYS), "lines")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-keys.count() // RANGE))
    # The row number lets ranges cut between repeated rows, too.
    order = [F.asc("high"), F.asc("low"), F.desc_nulls_last("doc"), F.asc("body"), F.asc("row")]
    ranged = keys.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(ranges, *order)
    edges = ranged.sortWithinPartitions(*order).mapInArrow(lambda parts: _edges(parts, min_docs), "high long, low long, doc long")
    # Two runs of a range, so at most 2 * min_docs rows each; summed up to at most two rows a range.
    cut = edges.groupBy("high", "low").agg(F.max("doc").alias("top"), (F.countDistinct("doc") + F.max(F.col("doc").isNull().cast("long"))).alias("docs"))
    told = ranged.join(F.broadcast(cut), ["high", "low"], "left").sortWithinPartitions(*order)
    return told.select("high", "low", "doc", "body", "places", "top", "docs").mapInArrow(lambda parts: _drop(parts, min_docs), DROPPED)


def pack(n: int, gone: np.ndarray) -> bytes:
    """A bitmap of ``n`` lines, 1 for those kept: b"b" and the bits, or b"r" and the lengths of runs (kept first) as varints; b"" where all are kept."""
    if not len(gone):
        return b""
    keep = np.ones(n, np.uint8)
    keep[gone] = 0
    edges = np.nonzero(np.diff(keep, prepend=1))[0]
    runs = bytearray()
    for length in np.diff(edges, prepend=0).tolist():
        while length > 0x7F:
            runs.append(length & 0x7F | 0x80)
            length >>= 7
        runs.append(length)
    bits = np.packbits(keep).tobytes()
    return b"r" + bytes(runs) if len(runs) < len(bits) else b"b" + bits


def unpack(n: int, packed: bytes) -> np.ndarray:
    """For each of ``n`` lines whether it is kept."""
    if not packed:
        return np.ones(n, bool)
    if packed[:1] == b"b":
        return np.unpackbits(np.frombuffer(packed, np.uint8, offset=1), count=n).astype(bool)
    lengths, value, shift = [], 0, 0
    for byte in packed[1:]:
        value |= (byte & 0x7F) << shift
        shift += 7
        if byte < 0x80:
            lengths.append(value)
            value = shift = 0
    lengths.append(n - sum(lengths))
    return np.repeat(np.arange(len(lengths)) % 2 == 0, lengths)


def _packed(n: pd.Series, places: pd.Series) -> pd.Series:
    return pd.Series([pack(int(count), np.asarray(gone, np.int64)) for count, gone in zip(n, places)], dtype=object)


def keep_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, body, n_lines, n_dropped, keep): per document which of its lines stay.

    A text is split at line feeds; a null text counts as empty, an empty one as one empty line. Keys of at least
    ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines, except in the document
    with the largest id, where all stay. Rows with the same id are one document to the count, with bitmaps of
    their own where their texts differ (``body``, a hash of the text); equal rows share a bitmap. Rows without an id
    are together one document, below all others. Keys are compared by 128-bit hashes. An empty table gives no rows.
    """
    gone = dropped(docs, id, text, min_chars, min_docs)
    lines = _marked(docs, id, text).select("doc", "body", (F.char_length("text") - F.char_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"))
    both = lines.unionByName(gone.select("doc", "body", "places"), allowMissingColumns=True)
    # A set: equal rows name the same places, and a hot group of them stays one entry per key.
    grouped = both.groupBy("doc", "body").agg(F.max("n_lines").alias("n_lines"), F.flatten(F.collect_set("places")).alias("places"))
    return grouped.select("doc", "body", "n_lines", F.size("places").cast("long").alias("n_dropped"), F.pandas_udf(_packed, "binary")("n_lines", "places").alias("keep"))


def kept_text(text: Column, n_lines: Column, keep: Column) -> Column:
    """The lines of ``text`` that the bitmap keeps, joined by line feeds."""

    @F.pandas_udf("string")
    def apply(texts: pd.Series, counts: pd.Series, bitmaps: pd.Series) -> pd.Series:
        out = []
        for value, n, packed in zip(texts, counts, bitmaps):
            if packed:
                value = "\n".join(line for line, kept in zip(value.split("\n"), unpack(int(n), packed)) if kept)
            out.append(value)
        return pd.Series(out, dtype=object)

    return apply(F.coalesce(text, F.lit("")), n_lines, keep)


def dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", **limits) -> DataFrame:
    """``docs`` without its repeated lines, and with ``n_lines``, ``n_dropped`` and ``keep``; columns of those names are replaced.

    Every row of ``docs`` gives one row; see ``keep_bitmaps`` for what is kept.
    """
    added = ["n_lines", "n_dropped", "keep"]
    bitmaps = keep_bitmaps(docs, id, text, **limits).withColumnsRenamed({"doc": "_doc", "body": "_body"} | {name: f"_{name}" for name in added})
    here = docs.withColumns({"_own": F.col(id).cast("long"), "_hash": F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))})
    joined = here.join(bitmaps, here["_own"].eqNullSafe(bitmaps["_doc"]) & (here["_hash"] == bitmaps["_body"]))
    shown = [F.col(c) if c != text else kept_text(F.col(text), F.col("_n_lines"), F.col("_keep")).alias(text) for c in outside(docs, added)]
    return joined.select(*shown, *[F.col(f"_{name}").alias(name) for name in added])
