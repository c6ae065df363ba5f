"""WARC archives: written as one gzip member per record, read back sequentially.

*Writing.* Records with equal payloads are found by digest: the one with the
smallest id is a ``response``, the others are ``revisit`` records that hold the
HTTP header only. Tasks write archives of a bounded size under names of their
own, so a repeated task never touches another's files; the table that comes
back (one row per archive) names those of the attempts that counted.

*Reading.* A reader inflates an archive piece by piece, frames header and block
by Content-Length, checks that the record's member ends where the record does,
and verifies block and payload digests while bytes pass. A damaged member gives
a row with its error; reading goes on at the next member that can be opened.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from .common import batches, materialise

#: Bytes of one archive file after which the next begins.
ARCHIVE = 32 << 20
#: Payloads below this are never written as revisits.
LEAST_REVISIT = 100
CHUNK = 1 << 18
MAGIC = b"\x1f\x8b\x08"
RECORD = "urn:page:"

ARCHIVES = "path string, records long, bytes long"
RECORDS = (
    "path string, offset long, id long, url string, record_type string, payload_bytes long, payload_digest string, "
    "refers_to long, payload binary, error string"
)


def plan(pages: DataFrame, id: str, payload: str, least: int = LEAST_REVISIT) -> DataFrame:
    """Add ``_payload`` (binary, null: empty), ``_digest`` (hex SHA-256) and ``_refers`` (the response's id for revisits, else null).

    Rows that share the smallest id of equal payloads are all responses. A row without an id revisits one that has
    an id; payloads that only rows without ids hold stay responses. Repeated payloads are counted map-side and joined
    on salted keys, so that one payload may be a large share of all rows.
    """
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select("*", body.alias("_payload")).withColumn("_digest", F.sha2("_payload", 256))
    large = rows.filter(F.octet_length("_payload") >= least)
    firsts = large.groupBy("_digest").agg(F.min(id).alias("_first"), F.count("*").alias("_n")).filter("_n > 1 AND _first IS NOT NULL")
    salts = 64
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(id, F.lit(1)), F.lit(salts)).cast("int"))
    copies = firsts.select("_digest", "_first", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    joined = salted.join(copies, ["_digest", "_salt"], "left")
    revisits = F.col("_first").isNotNull() & (F.col(id).isNull() | (F.col(id) > F.col("_first")))
    return joined.withColumn("_refers", F.when(revisits, F.col("_first"))).drop("_salt", "_first")


def record(id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, date: str) -> bytes:
    """One record as a gzip member. Characters that could end a header line are percent-encoded in the URL."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD}{'' if id is None else id}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", None if url is None else quote(url, safe="/:?#[]@!$&'()*+,;=%~-._")),
        ("WARC-Payload-Digest", f"sha256:{digest}"),
        ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if refers is not None:
        fields[2:2] = [
            ("WARC-Refers-To", f"<{RECORD}{refers}>"),
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def write(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", payload: str = "html",
    date: str = "2020-01-01T00:00:00Z", size: int = ARCHIVE, least: int = LEAST_REVISIT,
) -> DataFrame:
    """Write every row of ``pages`` as a record into archives below ``folder``; (path, records, bytes) of each archive.

    The result is a written table: reading it again writes nothing. ``folder`` must be one that all executors reach.
    An empty table writes no archive.
    """
    rows = plan(pages.select(F.col(id).cast("long").alias("_id"), F.col(url).cast("string").alias("_url"), F.col(payload).alias("_html")), "_id", "_html", least)

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        name, out, records = "", None, 0

        def close() -> pa.RecordBatch:
            length = out.tell()
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [records], "bytes": [length]})

        for part in parts:
            for row in range(len(part)):
                if out is None:
                    name, records = f"pages-{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                out.write(record(*(part.column(c)[row].as_py() for c in range(5)), date))
                records += 1
                if out.tell() >= size:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return materialise(rows.select("_id", "_url", "_payload", "_digest", "_refers").mapInArrow(run, ARCHIVES), "archives")


class Member:
    """The bytes of one gzip member, inflated as they are asked for."""

    def __init__(self, source: "Source"):
        self.source, self.inflate, self.data = source, zlib.decompressobj(31), b""

    def fill(self) -> bool:
        """Inflate some more; False at the end of the member."""
        while not self.inflate.eof:
            # What one step may inflate is bounded, whatever the compression ratio.
            raw = self.inflate.unconsumed_tail or self.source.take()
            if not raw:
                raise EOFError("archive ends inside a record")
            got = self.inflate.decompress(raw, CHUNK)
            if self.inflate.eof:
                self.source.give_back(self.inflate.unused_data)
            if got:
                self.data += got
                return True
        return False

    def until(self, mark: bytes, most: int = 1 << 20) -> bytes:
        while mark not in self.data:
            if len(self.data) > most:
                raise ValueError("header too long")
            if not self.fill():
                raise ValueError("record ends inside its header")
        found, _, self.data = self.data.partition(mark)
        return found

    def pieces(self, length: int) -> Iterator[bytes]:
        while length:
            if not self.data and not self.fill():
                raise ValueError("record shorter than its Content-Length")
            piece, self.data = self.data[:length], self.data[length:]
            length -= len(piece)
            yield piece

    def rest(self) -> bytes:
        while len(self.data) < 16 and self.fill():
            pass
        return self.data


class Source:
    """Raw bytes of an archive in order; ``offset`` is the place of the next byte to be taken."""

    def __init__(self, stream):
        self.stream, self.held, self.offset = stream, b"", 0

    def take(self) -> bytes:
        data, self.held = self.held or self.stream.read(CHUNK), b""
        self.offset += len(data)
        return data

    def give_back(self, data: bytes) -> None:
        self.held = data + self.held
        self.offset -= len(data)

    def resync(self, start: int) -> bool:
        """Move to the first place from ``start`` on where a member opens that holds a record; False if there is none."""
        self.stream.seek(start)
        window = b""
        while True:
            data = self.stream.read(CHUNK)
            window += data
            place = window.find(MAGIC)
            while place >= 0 and (place + 512 <= len(window) or not data):
                try:
                    head = zlib.decompressobj(31).decompress(window[place : place + 512], 7)
                except zlib.error:
                    head = b""
                if head == b"WARC/1.":
                    self.offset, self.held = start + place, b""
                    self.stream.seek(self.offset)
                    return True
                place = window.find(MAGIC, place + 1)
            if not data:
                return False
            cut = place if place >= 0 else max(0, len(window) - len(MAGIC) + 1)
            start, window = start + cut, window[cut:]


def headers(data: bytes) -> dict[str, str]:
    lines = data.decode("utf-8", "replace").split("\r\n")
    return {name.strip().lower(): value.strip() for name, colon, value in (line.partition(":") for line in lines[1:]) if colon}


def number(urn: str | None) -> int | None:
    tail = (urn or "").strip("<>").removeprefix(RECORD)
    return int(tail) if tail.lstrip("-").isdigit() else None


def parse(member: Member, keep_payload: bool) -> dict:
    """One record: framed by Content-Length, digests verified on the way."""
    head = member.until(b"\r\n\r\n")
    if not head.startswith(b"WARC/1."):
        raise ValueError("not a WARC record")
    fields = headers(head)
    length = int(fields["content-length"])
    kind, claimed = fields.get("warc-type", ""), fields.get("warc-payload-digest", "").removeprefix("sha256:")
    block, payload, size, kept, http = hashlib.sha256(), hashlib.sha256(), 0, [], b""
    inside = False  # past the HTTP header
    for piece in member.pieces(length):
        block.update(piece)
        if not inside:
            http += piece
            if b"\r\n\r\n" not in http:
                continue
            http, _, piece = http.partition(b"\r\n\r\n")
            inside = True
        payload.update(piece)
        size += len(piece)
        if keep_payload:
            kept.append(piece)
    if member.rest() != b"\r\n\r\n":
        raise ValueError("record and member end at different places")
    if "warc-block-digest" in fields and fields["warc-block-digest"] != f"sha256:{block.hexdigest()}":
        raise ValueError("block digest differs")
    declared = int(headers(http)["content-length"])
    if kind == "response" and (claimed != payload.hexdigest() or size != declared):
        raise ValueError("payload digest or length differs")
    return {
        "id": number(fields.get("warc-record-id")), "url": fields.get("warc-target-uri"), "record_type": kind,
        "payload_bytes": declared, "payload_digest": claimed, "refers_to": number(fields.get("warc-refers-to")),
        "payload": b"".join(kept) if keep_payload and kind == "response" else None, "error": None,
    }


def records(stream, keep_payload: bool = False) -> Iterator[dict]:
    """The records of an archive in order, each with its ``offset``; damaged members as rows with an ``error``.

    Sequential, but for a damaged member: the search for the next one begins right behind its first byte.
    """
    source = Source(stream)
    while True:
        start = source.take()
        if not start:
            return
        source.give_back(start)
        offset = source.offset
        member = Member(source)
        try:
            yield {"offset": offset, **parse(member, keep_payload)}
        except (zlib.error, ValueError, KeyError, EOFError) as error:
            yield {"offset": offset, "error": f"{type(error).__name__}: {error}"}
            if not source.resync(offset + 1):
                return


def read(archives: DataFrame, keep_payload: bool = True) -> DataFrame:
    """The records of the archives named in ``archives.path``, one task per archive, each read once from its start.

    Revisits carry the digest and length of the payload they stand for and the id of its response. An archive that
    cannot be opened, or a damaged record, gives a row with ``error`` set and the rest null.
    """
    names = [field.split()[0] for field in RECORDS.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string()]

    def of(path: str) -> Iterator[dict]:
        try:
            store, place = fs.FileSystem.from_uri(path)
            with store.open_input_file(place) as stream:
                for found in records(stream, keep_payload):
                    yield {"path": path, **found}
        except OSError as error:
            yield {"path": path, "error": f"{type(error).__name__}: {error}"}

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (row for part in parts for path in part.column(0).to_pylist() for row in of(path))
        for some in batches(found, lambda row: 200 + len(row.get("payload") or b"")):
            yield pa.RecordBatch.from_arrays([pa.array([row.get(n) for row in some], kind) for n, kind in zip(names, kinds)], names=names)

    # As many tasks as archives: names are few bytes, what they name is not.
    return archives.select("path").repartition(max(1, archives.count())).mapInArrow(run, RECORDS)
