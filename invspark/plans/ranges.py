"""Archives larger than one task: read by many tasks through an index, and built by many tasks.

Reading: the central directory becomes a table with the place of every member.
Members are dealt over tasks by the part of the archive they begin in, and a
task inflates its members from byte ranges; nothing of the archive before them
is read.

Building: members are cut into pieces that are deflated apart, each ended at a
byte boundary so that pieces joined are one deflate stream. Checksums of pieces
are combined by arithmetic. Once all lengths are known, running sums give each
header, piece and directory entry its place, and the archive is a table of
(offset, bytes) that tasks write into one file in any order.
"""

from __future__ import annotations

import hashlib
import os
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, functions as F

from ..operators import ordered
from ..session import dealt, materialise
from . import segments
from .archive import BLOCK, EXTRACTED, UNREADABLE, Written, open_path, target_of

#: Bytes of an archive whose members one group of ranges holds, and bytes of a member deflated at a time.
RANGE = 256 * 1024**2
PIECE = 64 * 1024**2

INDEX = "zip_key string, member string, header long, packed long, size long, crc long, method int, flags int, error string"
PIECES = "zip_key string, ord long, member string, piece long, size long, packed long, crc long, part string, at long, error string"


def index_archives(archives: DataFrame, root: str) -> DataFrame:
    """One row per member of the archives (zip_key) below ``root``: where it begins, its lengths, CRC-32, method and flags.

    Only the ends of the archives are read. A missing or unreadable archive gives one row with its error.
    """

    def index(batches):
        columns = [name.split()[0] for name in INDEX.split(", ")]
        for batch in batches:
            for key in batch["zip_key"]:
                try:
                    system, path = open_path(f"{root}/{key}")
                    with system.open_input_file(path) as source, zipfile.ZipFile(source) as archive:
                        held = [i for i in archive.infolist() if not i.is_dir()]
                    for begin in range(0, len(held), 10_000):
                        rows = [(key, i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type, i.flag_bits, None) for i in held[begin : begin + 10_000]]
                        yield pd.DataFrame(rows, columns=columns)
                except UNREADABLE as error:
                    row = dict.fromkeys(columns) | {"zip_key": key, "error": type(error).__name__}
                    yield pd.DataFrame([row]).astype(dict.fromkeys(columns[2:8], "Int64"))

    return dealt(archives.select("zip_key"), "zip_key").mapInPandas(index, INDEX)


class BadMember(Exception):
    """What lies at a member's place is not what the index says."""


def inflate(source, header: int, packed: int, size: int, crc: int, method: int, flags: int) -> Iterator[bytes]:
    """The bytes of one member, read from its range block by block; raises ``BadMember`` where they disagree with the index."""
    if flags & 1 or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise NotImplementedError("encrypted, or an unknown method")
    source.seek(header)
    head = source.read(30)
    if len(head) < 30 or head[:4] != b"PK\x03\x04":
        raise BadMember("no header")
    source.seek(header + 30 + sum(struct.unpack("<HH", head[26:30])))
    packer = zlib.decompressobj(-15) if method == zipfile.ZIP_DEFLATED else None
    left, made, sum_ = packed, 0, 0
    while left:
        block = source.read(min(left, BLOCK))
        if not block:
            raise BadMember("archive ends")
        left -= len(block)
        while block:
            # What is inflated at a time is bounded, too: a few bytes may hold gigabytes.
            out = packer.decompress(block, BLOCK) if packer else block
            block = packer.unconsumed_tail if packer else b""
            made, sum_ = made + len(out), zlib.crc32(out, sum_)
            if made > size:
                raise BadMember("longer than listed")
            if out:
                yield out
    if packer and (out := packer.flush()):
        made, sum_ = made + len(out), zlib.crc32(out, sum_)
        yield out
    if made != size or sum_ != crc:
        raise BadMember("length or checksum differs")


def _dealt(index: DataFrame, range_bytes: int) -> DataFrame:
    """Members that begin in one part of an archive together, in order: a large archive is read by many tasks, each in one direction."""
    part = F.call_function("div", F.col("header"), F.lit(range_bytes))
    rows = dealt(index.withColumns({"_part": part, "attempt": F.expr("uuid()")}), "zip_key", "_part")
    return rows.sortWithinPartitions("zip_key", "header").drop("_part")


def _read(index: DataFrame, root: str, out_root: str | None, range_bytes: int) -> DataFrame:
    """Read every indexed member, and write it below ``out_root`` if given; one row of ``EXTRACTED`` each."""

    def member_of(source, row) -> tuple[int, str]:
        digest, size = hashlib.md5(), 0
        with Written(target_of(out_root, row.zip_key, row.member), row.attempt) if out_root else open(os.devnull, "wb") as sink:
            for block in inflate(source, *(int(getattr(row, name)) for name in ("header", "packed", "size", "crc", "method", "flags"))):
                digest.update(block)
                sink.write(block)
                size += len(block)
        return size, digest.hexdigest()

    def read(batches):
        opened, source = None, None
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                if isinstance(row.error, str):
                    rows.append((row.zip_key, None, None, None, "missing" if row.error == "FileNotFoundError" else "failed", row.error))
                    continue
                try:
                    if opened != row.zip_key:
                        if source is not None:
                            source.close()
                        opened, source = None, None
                        system, path = open_path(f"{root}/{row.zip_key}")
                        opened, source = row.zip_key, system.open_input_file(path)
                    rows.append((row.zip_key, row.member, *member_of(source, row), "done", None))
                except (*UNREADABLE, BadMember) as error:
                    rows.append((row.zip_key, row.member, None, None, "failed", type(error).__name__))
            yield pd.DataFrame(rows, columns=["zip_key", "member", "size", "md5", "status", "error"]).astype({"size": "Int64"})
        if source is not None:
            source.close()

    return _dealt(index, range_bytes).mapInPandas(read, EXTRACTED)


def unpack_ranges(index: DataFrame, root: str, range_bytes: int = RANGE) -> DataFrame:
    """Size and md5 of every indexed member, read by range; a damaged member gives ``failed``, the others stay readable."""
    return _read(index, root, None, range_bytes)


def extract_ranges(index: DataFrame, root: str, out_root: str, range_bytes: int = RANGE) -> DataFrame:
    """Write the indexed members to ``out_root``, under their archive's folder, by many tasks per archive; one row each.

    ``index`` may be filtered to the members wanted. Members that begin in the same ``range_bytes`` of an archive share a task; a long
    member is streamed. Files are written under a temporary name and renamed, so a task may run again. Names that would leave the
    folder give ``failed``, damaged members too; a missing archive gives one row with status ``missing``.
    """
    return _read(index, root, out_root, range_bytes)


# Building. CRC-32 as a polynomial over GF(2), bits reflected: the highest power lies in the lowest bit.
POLYNOMIAL = 0xEDB88320
ONE = 1 << 31


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo the CRC's."""
    product = 0
    for power in range(32):
        if a & (ONE >> power):
            product ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return product


def _shift(n: int) -> int:
    """x to the power of 8 n: what n further bytes multiply a checksum by."""
    result, square = ONE, ONE >> 8
    while n:
        if n & 1:
            result = _times(result, square)
        square, n = _times(square, square), n >> 1
    return result


def crc_of_joined(pieces: list[tuple[int, int]]) -> int:
    """CRC-32 of pieces joined, from (length, CRC-32) of each, without their bytes."""
    total = 0
    for length, crc in pieces:
        total = _times(_shift(length), total) ^ crc if total else crc
    return total


def deflate_pieces(members: DataFrame, work: str, compress: bool = True, piece: int = PIECE) -> DataFrame:
    """``PIECES`` of members (zip_key, ord, member, path, size), deflated by as many tasks as there are partitions; a written table.

    Each task appends its pieces to a part file of its own below ``work``; a repeated task writes another part, which its rows name.
    A piece that cannot be read has an ``error``. ``size`` is that of the listing; a last piece reads whatever follows.
    """
    cut = segments.segments(members.select(F.struct("zip_key", "ord", "member", "path").alias("key"), "size"), piece)
    rows = dealt(cut.select("key.*", F.col("segment").alias("piece"), F.col("segment").eqNullSafe(F.col("n_segments")).alias("last"), "start", "end"), "zip_key", "ord", "piece")

    def deflate(batches):
        columns = [name.split()[0] for name in PIECES.split(", ")]
        system, folder = open_path(work)
        system.create_dir(folder, recursive=True)
        part = f"{work}/{uuid.uuid4().hex}.part"
        with system.open_output_stream(open_path(part)[1], compression=None) as sink:
            for batch in batches:
                out = []
                for row in batch.itertuples(index=False):
                    at, size, crc, error = sink.tell(), 0, 0, None
                    packer = zlib.compressobj(6, zlib.DEFLATED, -15) if compress else None
                    try:
                        source_fs, source = open_path(row.path)
                        with source_fs.open_input_file(source) as stream:
                            stream.seek(row.start)
                            while block := stream.read(BLOCK if row.last else min(BLOCK, row.end - row.start - size)):
                                size, crc = size + len(block), zlib.crc32(block, crc)
                                sink.write(packer.compress(block) if packer else block)
                        if not row.last and size != row.end - row.start:
                            error = "ShorterThanListed"
                        elif packer:
                            # A full flush ends at a byte and forgets what came before; the last piece ends the stream.
                            sink.write(packer.flush(zlib.Z_FINISH if row.last else zlib.Z_FULL_FLUSH))
                    except OSError as failed:
                        error = type(failed).__name__
                    out.append((row.zip_key, row.ord, row.member, row.piece, size, sink.tell() - at, crc, part, at, error))
                yield pd.DataFrame(out, columns=columns)

    return materialise(rows.mapInPandas(deflate, PIECES), "pieces")


# Fixed values of the format: signatures, version 4.5 (ZIP64), the date 1980-01-01, UTF-8 names; 3 << 8: made on Unix.
LOCAL, ENTRY, END64, LOCATOR, END = b"PK\x03\x04", b"PK\x01\x02", b"PK\x06\x06", b"PK\x06\x07", b"PK\x05\x06"
VERSION, DATE, UTF8, ALL = 45, 33, 0x800, 0xFFFFFFFF


def _header(name: bytes, size: int, packed: int, crc: int, method: int) -> bytes:
    extra = struct.pack("<HHQQ", 1, 16, size, packed)
    return struct.pack("<4sHHHHHIIIHH", LOCAL, VERSION, UTF8, method, 0, DATE, crc, ALL, ALL, len(name), len(extra)) + name + extra


def _entry(name: bytes, size: int, packed: int, crc: int, method: int, offset: int) -> bytes:
    extra = struct.pack("<HHQQQ", 1, 24, size, packed, offset)
    fixed = struct.pack("<4sHHHHHHIIIHHHHHII", ENTRY, 3 << 8 | VERSION, VERSION, UTF8, method, 0, DATE, crc, ALL, ALL, len(name), len(extra), 0, 0, 0, 0o600 << 16, ALL)
    return fixed + name + extra


def _ending(count: int, length: int, offset: int) -> bytes:
    return (
        struct.pack("<4sQHHIIQQQQ", END64, 44, 3 << 8 | VERSION, VERSION, 0, 0, count, count, length, offset)
        + struct.pack("<4sIQI", LOCATOR, 0, offset + length, 1) + struct.pack("<4sHHHHIIH", END, 0, 0, 0xFFFF, 0xFFFF, ALL, ALL, 0)
    )


HEADER_BYTES, ENTRY_BYTES = len(_header(b"", 0, 0, 0, 0)), len(_entry(b"", 0, 0, 0, 0, 0))


def lay_out(pieces: DataFrame, compress: bool = True) -> DataFrame:
    """(zip_key, offset, bytes, part, at, length): all of each archive, as inline bytes or as ranges of part files.

    Members keep their order. A member with a piece that could not be read is left out whole. Places are running sums over ``ord``,
    cut into buckets, so that no task holds an archive's members.
    """
    method = zipfile.ZIP_DEFLATED if compress else zipfile.ZIP_STORED
    name = F.octet_length("member").cast("long")
    data, listed = F.lit(HEADER_BYTES) + name + F.col("packed"), F.lit(ENTRY_BYTES) + name
    members = (
        pieces.groupBy("zip_key", "ord", "member")
        .agg(F.sum("size").alias("size"), F.sum("packed").alias("packed"), F.count("error").alias("errors"), F.collect_list(F.struct("piece", "size", "crc")).alias("held"))
        .filter("errors = 0").withColumn("crc", F.pandas_udf(_joined, "long")("held")).drop("held", "errors")
    )
    placed = ordered.scan(members, ["zip_key"], "ord", sums={"offset": data, "listed": listed})
    totals = placed.groupBy("zip_key").agg(F.count(F.lit(1)).alias("count"), F.sum(data).alias("data"), F.sum(listed).alias("directory"))
    known = ordered.attach(placed, totals.select("zip_key", "data"), ["zip_key"], "ord")

    def inline(rows: DataFrame, offset: Column, make, *columns: str) -> DataFrame:
        def build(values: pd.DataFrame) -> pd.Series:
            return pd.Series([make(*row) for row in values.itertuples(index=False)], dtype=object)

        return rows.select(
            "zip_key", offset.alias("offset"), F.pandas_udf(build, "binary")(F.struct(*columns)).alias("bytes"),
            F.lit(None).cast("string").alias("part"), F.lit(None).cast("long").alias("at"),
        ).withColumn("length", F.octet_length("bytes").cast("long"))

    headers = inline(placed, F.col("offset"), lambda member, size, packed, crc: _header(member.encode(), size, packed, crc, method), "member", "size", "packed", "crc")
    entries = inline(known, F.col("data") + F.col("listed"), lambda member, size, packed, crc, offset: _entry(member.encode(), size, packed, crc, method, offset), "member", "size", "packed", "crc", "offset")
    endings = inline(totals, F.col("data") + F.col("directory"), _ending, "count", "directory", "data")
    # The pieces of a member follow its header; what lies before a piece is summed within the member.
    before = ordered.scan(pieces.select("zip_key", "ord", "piece", "packed", "part", "at"), ["zip_key", "ord"], "piece", sums={"before": F.col("packed")})
    data_pieces = before.join(placed.select("zip_key", "ord", "offset", name.alias("name")), ["zip_key", "ord"]).select(
        "zip_key", (F.col("offset") + HEADER_BYTES + F.col("name") + F.col("before")).alias("offset"), F.lit(None).cast("binary").alias("bytes"), "part", "at", F.col("packed").alias("length")
    )
    return headers.unionByName(entries).unionByName(endings).unionByName(data_pieces)


def _joined(held: pd.Series) -> pd.Series:
    return pd.Series([crc_of_joined([(p["size"], p["crc"]) for p in sorted(pieces, key=lambda p: p["piece"])]) for pieces in held], dtype="int64")


def write_ranges(layout: DataFrame, root: str, build: str, range_bytes: int = RANGE) -> DataFrame:
    """Write laid out archives below ``root``, a mounted folder, by many tasks per archive; (zip_key, offset, length) of what was written.

    All tasks write into one file per archive, ``<zip_key>.<build>.partial``, each at its own places: a repeated task writes the same
    bytes to the same places. ``finish`` renames the files once all is written.
    """
    part = F.call_function("div", F.col("offset"), F.lit(range_bytes))
    rows = dealt(layout.withColumn("_part", part), "zip_key", "_part").sortWithinPartitions("zip_key", "offset").drop("_part")

    def write(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                path = _mounted(f"{root}/{row.zip_key}")
                os.makedirs(os.path.dirname(path), exist_ok=True)
                file = os.open(f"{path}.{build}.partial", os.O_WRONLY | os.O_CREAT, 0o644)
                try:
                    if row.bytes is not None:
                        _put_at(file, row.bytes, row.offset)
                        continue
                    parts, there = open_path(row.part)
                    with parts.open_input_file(there) as source:
                        source.seek(int(row.at))
                        done = 0
                        while done < row.length:
                            block = source.read(min(BLOCK, int(row.length) - done))
                            if not block:
                                raise OSError(f"{row.part} ends early")
                            _put_at(file, block, row.offset + done)
                            done += len(block)
                finally:
                    os.close(file)
            yield batch[["zip_key", "offset", "length"]]

    return rows.mapInPandas(write, "zip_key string, offset long, length long")


def _mounted(path: str) -> str:
    system, local = open_path(path)
    if not isinstance(system, pafs.LocalFileSystem):
        raise NotImplementedError("archives are built in place below a mounted folder")
    return local


def _put_at(file: int, data: bytes, offset: int) -> None:
    view = memoryview(data)
    while view:
        n = os.pwrite(file, view, offset)
        view, offset = view[n:], offset + n


def finish(written: DataFrame, root: str, build: str) -> DataFrame:
    """Rename each completely written archive to its name; (zip_key, size, status, error). A gap in what was written gives ``failed``."""
    sums = written.groupBy("zip_key").agg(F.sum("length").alias("bytes"), F.max(F.col("offset") + F.col("length")).alias("size"))

    def rename(batches):
        for batch in batches:
            rows = []
            for key, held, size in batch[["zip_key", "bytes", "size"]].itertuples(index=False):
                path, error = _mounted(f"{root}/{key}"), None
                partial = f"{path}.{build}.partial"
                try:
                    if held != size or os.path.getsize(partial if os.path.exists(partial) else path) != size:
                        error = "Incomplete"
                    elif os.path.exists(partial):  # else an earlier attempt of this task has renamed it
                        os.replace(partial, path)
                except OSError as failed:
                    error = type(failed).__name__
                rows.append((key, size, "failed" if error else "done", error))
            yield pd.DataFrame(rows, columns=["zip_key", "size", "status", "error"])

    return dealt(sums, "zip_key").mapInPandas(rename, "zip_key string, size long, status string, error string")


def skipped_members(pieces: DataFrame) -> DataFrame:
    """(zip_key, member, error) of the members that an archive built of these pieces leaves out."""
    return pieces.filter("error is not null").groupBy("zip_key", "ord", "member").agg(F.min_by("error", "piece").alias("error")).drop("ord")


def build_archives(pieces: DataFrame, root: str, compress: bool = True, range_bytes: int = RANGE) -> DataFrame:
    """Write the archives of deflated pieces, a written table, below ``root``, each by many tasks.

    One row per archive: (zip_key, n_members, n_skipped, size, status, error). Members keep the order of ``ord``, which is unique
    within an archive. Where no member could be read, no archive is written (status ``empty``). Every step is a written table,
    so a lost executor repeats only its own tasks; a member of any length passes in blocks.
    """
    build = uuid.uuid4().hex
    layout = materialise(lay_out(pieces, compress), "layout")
    written = materialise(write_ranges(layout, root, build, range_bytes), "written")
    done = materialise(finish(written, root, build), "finished")
    by_member = pieces.groupBy("zip_key", "ord", "member").agg(F.count("error").alias("errors"))
    counts = by_member.groupBy("zip_key").agg(F.count_if(F.col("errors") == 0).alias("n_members"), F.count_if(F.col("errors") > 0).alias("n_skipped"))
    return counts.join(done, "zip_key", "left").select(
        "zip_key", "n_members", "n_skipped", F.coalesce("size", F.lit(0).cast("long")).alias("size"), F.coalesce("status", F.lit("empty")).alias("status"), "error"
    )
