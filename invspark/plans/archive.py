"""Building, opening and checking archives as distributed jobs.

One task handles one archive at a time. Files are reached through
``pyarrow.fs``, so paths may be local, mounted or URIs; writes go to a
temporary name first, so a retried task leaves nothing half done.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import time
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..session import dealt

# Fixed value: every member carries the same date, so equal input gives equal archives.
MEMBER_DATE = (1980, 1, 1, 0, 0, 0)
BLOCK = 8 * 1024**2
FLUSH = 64 * 1024**2

PACKED = "zip_key string, n_members long, n_skipped long, size long, md5 string, members string, skipped string, start_us long, end_us long"
UNPACKED = "zip_key string, member string, size long, md5 string, content binary, error string"
EXTRACTED = "zip_key string, member string, size long, md5 string, status string, error string"


def open_path(path: str):
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:/") else (pafs.LocalFileSystem(), path)


class UnsafeName(ValueError):
    """A member name that does not stay below the folder it is extracted to."""


def target_of(out_root: str, zip_key: str, member: str) -> str:
    """Where a member goes: below ``out_root``, under its archive's folder. Names that would leave that folder are refused."""
    folder = zip_key.rpartition("/")[0]
    for name in (folder, member) if folder else (member,):
        if not name or name.startswith("/") or "\\" in name or "\0" in name or re.match("[A-Za-z]:", name) or ".." in name.split("/"):
            raise UnsafeName(name)
    inside = posixpath.normpath(member)
    if inside == "." or member.endswith("/"):
        raise UnsafeName(member)
    return "/".join(part for part in (out_root, folder, inside) if part)


class Written:
    """A file written under a temporary name and renamed when all went well, else removed."""

    def __init__(self, target: str, attempt: str):
        self.system, self.target = open_path(target)
        self.partial = f"{self.target}.{attempt}.partial"

    def __enter__(self):
        self.system.create_dir(self.target.rsplit("/", 1)[0], recursive=True)
        self.sink = self.system.open_output_stream(self.partial, compression=None)
        return self.sink

    def __exit__(self, kind, *error) -> None:
        self.sink.close()
        if kind is None:
            self.system.move(self.partial, self.target)
        else:
            self.system.delete_file(self.partial)


class _Unreadable(Exception):
    """A source that fails while it is read."""


def _blocks(stream) -> Iterator[bytes]:
    while True:
        try:
            block = stream.read(BLOCK)
        except OSError as error:
            raise _Unreadable from error
        if not block:
            return
        yield block


def _info(name: str, compress: bool) -> zipfile.ZipInfo:
    info = zipfile.ZipInfo(name, MEMBER_DATE)
    info.compress_type = zipfile.ZIP_DEFLATED if compress else zipfile.ZIP_STORED
    return info


def pack_contents(members: DataFrame, compress: bool = False) -> DataFrame:
    """Archives (zip_key, n_members, size, md5, content) from (zip_key, ord, member, content).

    A group is one archive of the batch plan, bounded by its size limit.
    """

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w") as archive:
            for row in group.sort_values("ord").itertuples(index=False):
                archive.writestr(_info(row.member, compress), row.content)
        data = buffer.getvalue()
        return pd.DataFrame({
            "zip_key": [group["zip_key"].iloc[0]], "n_members": [len(group)], "size": [len(data)],
            "md5": [hashlib.md5(data).hexdigest()], "content": [data],
        })

    return members.select("zip_key", "ord", "member", "content").groupBy("zip_key").applyInPandas(
        pack, "zip_key string, n_members long, size long, md5 string, content binary"
    )


def pack_files(plan: DataFrame, out_root: str, dest: str, compress: bool = False, tasks: int | None = None) -> DataFrame:
    """Write the archives of a batch plan below ``out_root`` with their manifests, streaming member files; one result row each.

    Members that cannot be opened, or fail while they are read, are skipped, left
    out of the archive's member list and named in ``skipped``; what was read of
    them stays behind as unlisted bytes. Member names are relative to the
    archive's folder ``dest``. The manifest (``.metadata``, names joined by
    ``|``) is written once the archive is in place. ``start_us`` and ``end_us``
    are taken before the first member and after the manifest, for the log.
    """

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                system, target = open_path(f"{out_root}/{row.zip_key}")
                system.create_dir(target.rsplit("/", 1)[0], recursive=True)
                partial = f"{target}.{row.attempt}.partial"
                names, skipped, start = [], [], time.time_ns() // 1000
                with system.open_output_stream(partial) as sink, zipfile.ZipFile(sink, "w") as archive:
                    for member in row.members:
                        name = member["object_name"]
                        name = name[len(dest) + 1:] if dest and name.startswith(dest + "/") else name
                        try:
                            source_fs, source = open_path(member["path"])
                            stream = source_fs.open_input_stream(source)
                        except OSError:
                            skipped.append(name)
                            continue
                        info = _info(name, compress)
                        try:
                            with stream, archive.open(info, "w", force_zip64=True) as slot:
                                for block in _blocks(stream):
                                    slot.write(block)
                            names.append(name)
                        except _Unreadable:
                            # The directory is written last; what it does not list is no member.
                            archive.filelist.remove(info)
                            archive.NameToInfo.pop(name)
                            skipped.append(name)
                size, md5 = _digest(system, partial)
                system.move(partial, target)
                _put(system, f"{target}.metadata", "|".join(names).encode(), row.attempt)
                yield pd.DataFrame({
                    "zip_key": [row.zip_key], "n_members": [len(names)], "n_skipped": [len(skipped)],
                    "size": [size], "md5": [md5], "members": ["|".join(names)], "skipped": ["|".join(skipped)],
                    "start_us": [start], "end_us": [time.time_ns() // 1000],
                })

    rows = plan.select("zip_key", "members", F.expr("uuid()").alias("attempt"))
    rows = rows.repartition(tasks, "zip_key") if tasks else dealt(rows, "zip_key")
    return rows.mapInPandas(pack, PACKED)


def _put(system, path: str, data: bytes, attempt: str) -> None:
    with system.open_output_stream(f"{path}.{attempt}.partial", compression=None) as sink:
        sink.write(data)
    system.move(f"{path}.{attempt}.partial", path)


def write_contents(archives: DataFrame, root: str) -> DataFrame:
    """Write archives given by value (zip_key, content) below ``root``; (zip_key, size) of each."""

    def write(parts):
        for part in parts:
            # Contents are written from Arrow's own memory, one after the other, so a batch is held once.
            sizes = []
            for key, content, attempt in zip(*part.columns):
                system, path = open_path(f"{root}/{key.as_py()}")
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                _put(system, path, content.as_buffer(), attempt.as_py())
                sizes.append(content.as_buffer().size)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64())], names=["zip_key", "size"])

    rows = archives.select("zip_key", "content", F.expr("uuid()").alias("attempt"))
    return rows.mapInArrow(write, "zip_key string, size long")


def write_manifests(manifest: DataFrame, root: str) -> DataFrame:
    """Write manifests (zip_key, text) as ``<root>/<zip_key>.metadata``; (zip_key, size) of each."""

    def write(batches):
        for batch in batches:
            sizes = []
            for key, text, attempt in zip(batch["zip_key"], batch["text"], batch["attempt"]):
                system, path = open_path(f"{root}/{key}.metadata")
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                _put(system, path, text.encode(), attempt)
                sizes.append(len(text.encode()))
            yield batch[["zip_key"]].assign(size=sizes)

    rows = manifest.select("zip_key", "text", F.expr("uuid()").alias("attempt"))
    return dealt(rows, "zip_key").mapInPandas(write, "zip_key string, size long")


def _digest(system, path: str) -> tuple[int, str]:
    digest, size = hashlib.md5(), 0
    with system.open_input_stream(path) as stream:
        while block := stream.read(BLOCK):
            digest.update(block)
            size += len(block)
    return size, digest.hexdigest()


def digest_files(paths: DataFrame, path: str = "path") -> DataFrame:
    """Size and md5 of files read block by block (for objects too large for one cell)."""

    def digest(batches):
        for batch in batches:
            found = []
            for name in batch[path]:
                try:
                    found.append((name, *_digest(*open_path(name)), None))
                except OSError as error:
                    found.append((name, None, None, type(error).__name__))
            yield pd.DataFrame(found, columns=[path, "size", "md5", "error"]).astype({"size": "Int64"})

    return dealt(paths.select(path), path).mapInPandas(digest, f"{path} string, size long, md5 string, error string")


def _members(zip_key: str, archive: zipfile.ZipFile, keep: bool) -> Iterator[pd.DataFrame]:
    columns = ["zip_key", "member", "size", "md5", "content", "error"]
    rows, held = [], 0
    for info in archive.infolist():
        if info.is_dir():
            continue
        digest, kept = hashlib.md5(), []
        with archive.open(info) as stream:
            while block := stream.read(BLOCK):
                digest.update(block)
                if keep:
                    kept.append(block)
        rows.append((zip_key, info.filename, info.file_size, digest.hexdigest(), b"".join(kept) if keep else None, None))
        held += info.file_size if keep else 0
        if held > FLUSH or len(rows) == 10_000:
            yield pd.DataFrame(rows, columns=columns)
            rows, held = [], 0
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def _failed(zip_key: str, error: Exception) -> pd.DataFrame:
    row = {"zip_key": [zip_key], "member": [None], "size": [None], "md5": [None], "content": [None], "error": [type(error).__name__]}
    return pd.DataFrame(row).astype({"size": "Int64"})


#: What reading a missing, damaged or encrypted archive may raise.
UNREADABLE = (OSError, ValueError, zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError)


def unpack_contents(archives: DataFrame, keep_content: bool = True) -> DataFrame:
    """Members with size and md5 of archives given as (zip_key, content); an unreadable archive gives a row with its error."""

    fields = [("zip_key", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("md5", pa.string()), ("content", pa.binary()), ("error", pa.string())]

    def unpack(parts):
        schema = pa.schema(fields)
        for part in parts:
            # Archives are opened in Arrow's own memory, so a batch is held once.
            for key, content in zip(*part.columns):
                key = key.as_py()
                for found in _readable(key, pa.BufferReader(content.as_buffer() or b""), keep_content):
                    yield pa.RecordBatch.from_pandas(found, schema, preserve_index=False)

    return archives.select("zip_key", "content").mapInArrow(unpack, UNPACKED)


def _readable(key: str, source, keep: bool) -> Iterator[pd.DataFrame]:
    try:
        with zipfile.ZipFile(source) as archive:
            yield from _members(key, archive, keep)
    except UNREADABLE as error:
        yield _failed(key, error)


def unpack_files(archives: DataFrame, root: str, keep_content: bool = False) -> DataFrame:
    """Members with size and md5 of archives below ``root``, given by key; the archive is not loaded whole.

    A missing or unreadable archive gives a row with its error, and no members after the damage.
    """

    def unpack(batches):
        for batch in batches:
            for key in batch["zip_key"]:
                try:
                    system, path = open_path(f"{root}/{key}")
                    with system.open_input_file(path) as source, zipfile.ZipFile(source) as archive:
                        yield from _members(key, archive, keep_content)
                except UNREADABLE as error:
                    yield _failed(key, error)

    return dealt(archives.select("zip_key"), "zip_key").mapInPandas(unpack, UNPACKED)


def extract_files(wanted: DataFrame, root: str, out_root: str) -> DataFrame:
    """Write the wanted members (zip_key, member) of archives below ``root`` to ``out_root``, under the archive's folder.

    One row per member with its size and md5. A missing archive counts as done
    (its members went with it): one row with status ``missing``. An unreadable
    archive, an absent member or a name that would leave the folder gives
    ``failed`` with the error. Members are streamed to a temporary name and
    renamed, so a task may run again. The list of one archive is bounded by its
    member count; one task reads it (see ``plans.ranges`` for larger ones).
    """

    def extract(batches):
        columns = ["zip_key", "member", "size", "md5", "status", "error"]
        for batch in batches:
            for key, members, attempt in zip(batch["zip_key"], batch["members"], batch["attempt"]):
                rows = []
                try:
                    system, path = open_path(f"{root}/{key}")
                    with system.open_input_file(path) as source, zipfile.ZipFile(source) as archive:
                        for member in members:
                            try:
                                digest, size = hashlib.md5(), 0
                                with Written(target_of(out_root, key, member), attempt) as sink, archive.open(member) as stream:
                                    while block := stream.read(BLOCK):
                                        digest.update(block)
                                        size += len(block)
                                        sink.write(block)
                                rows.append((key, member, size, digest.hexdigest(), "done", None))
                            except (*UNREADABLE, KeyError) as error:
                                rows.append((key, member, None, None, "failed", type(error).__name__))
                except FileNotFoundError:
                    rows = [(key, None, None, None, "missing", None)]
                except UNREADABLE as error:
                    rows = [(key, None, None, None, "failed", type(error).__name__)]
                yield pd.DataFrame(rows, columns=columns).astype({"size": "Int64"})

    rows = wanted.groupBy("zip_key").agg(F.sort_array(F.collect_set("member")).alias("members"))
    return dealt(rows, "zip_key").withColumn("attempt", F.expr("uuid()")).mapInPandas(extract, EXTRACTED)


def apply_actions(actions: DataFrame, root: str) -> DataFrame:
    """Carry out copy and delete rows on files below ``root``; every row comes back with status and error.

    A delete row with a ``target`` removes the key first and the target only when that went well.

    Rows may run twice when a task is retried: deleting what is gone and
    copying over an equal copy both count as done.
    """

    def apply(batches):
        for batch in batches:
            status, errors = [], []
            for action, key, target, attempt in zip(batch["action"], batch["key"], batch["target"], batch["attempt"]):
                try:
                    system, path = open_path(f"{root}/{key}")
                    if action == "delete":
                        # What hangs on the object goes after it, and stays if the object could not go.
                        for gone in (path, f"{path[: -len(key)]}{target}") if target else (path,):
                            if system.get_file_info(gone).type != pafs.FileType.NotFound:
                                system.delete_file(gone)
                        status.append("done")
                    elif action == "copy":
                        there = f"{path[: -len(key)]}{target}"
                        system.create_dir(there.rsplit("/", 1)[0], recursive=True)
                        system.copy_file(path, f"{there}.{attempt}.partial")
                        system.move(f"{there}.{attempt}.partial", there)
                        status.append("done")
                    else:
                        status.append("kept")
                    errors.append(None)
                except OSError as error:
                    status.append("failed")
                    errors.append(type(error).__name__)
            yield batch.assign(status=status, error=errors)[["action", "key", "target", "status", "error"]]

    rows = actions.select("action", "key", "target", F.expr("uuid()").alias("attempt"))
    return dealt(rows, "key").mapInPandas(apply, "action string, key string, target string, status string, error string")
