"""Listings of trees and stores as tables."""

from __future__ import annotations

import os
import stat
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import paths
from ..operators import ordered
from ..session import dealt, materialise, shared_dir

ENTRY = "path string, is_dir boolean, is_link boolean, link_target string, size long, modified_us long, error string"
FILE = "path string, is_dir boolean, size long, modified_ms long"


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Every file below ``root`` with size and time, as Spark's file sources list them; contents are not read.

    Links are followed. Left out are empty files, hidden names (with all below them), links to nowhere and names that are not UTF-8.
    Spark's own listing holds all files on the driver. A mounted folder is therefore read by tasks, level by level (``_walk``); a
    folder that cannot be read is an error, as it is there. Stores, patterns and single files are left to Spark.
    """
    if (folder := _mounted_folder(spark, root)) is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))
    found = _walk(spark, folder, lambda level: level.mapInArrow(_list_folders, FILE), FILE, "is_dir")
    files = found.filter("not is_dir and size > 0")
    return files.select(F.concat(F.lit("file:"), "path").alias("path"), "size", F.timestamp_millis("modified_ms").alias("modified"))


def _mounted_folder(spark: SparkSession, root: str) -> str | None:
    """The absolute path of ``root`` if to Spark it is one folder of the local file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if set(root) & set("{}[]*?\\") or system.getUri().getScheme() != "file" or not system.isDirectory(path):
        return None
    return system.makeQualified(path).toUri().getPath()


def _left_out(name: str, is_dir: bool) -> bool:
    """Names that Spark's file sources do not list: hidden ones and unfinished copies. Folders may have the names of parquet's metadata."""
    hidden = name.startswith("_") and "=" not in name
    if name.startswith(("_metadata", "_common_metadata")):
        return hidden and not is_dir
    return hidden or name.startswith(".") or name.endswith("._COPYING_")


def _list_folders(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(entries) -> Iterator[tuple]:
        for entry in entries:
            try:
                entry.name.encode()
                found = entry.stat()
            except (OSError, UnicodeEncodeError):  # no file, or gone since
                continue
            is_dir = stat.S_ISDIR(found.st_mode)
            if not _left_out(entry.name, is_dir):
                yield entry.path, is_dir, 0 if is_dir else found.st_size, found.st_mtime_ns // 1_000_000

    for part in parts:
        for folder in part.column(0).to_pylist():
            with os.scandir(folder) as entries:
                found = rows(entries)
                while some := list(islice(found, 10_000)):
                    columns = zip(zip(*some), (pa.string(), pa.bool_(), pa.int64(), pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], names=["path", "is_dir", "size", "modified_ms"])


def _scan_folders(batches):
    import pandas as pd

    columns = ["path", "is_dir", "is_link", "link_target", "size", "modified_us", "error"]
    for batch in batches:
        for folder in batch["path"]:
            rows = []
            try:
                entries = os.scandir(folder)
            except OSError as error:
                rows = [(folder, True, False, None, 0, None, type(error).__name__)]
                yield pd.DataFrame(rows, columns=columns).astype({"modified_us": "Int64"})
                continue
            with entries:
                for entry in entries:
                    link, is_dir = entry.is_symlink(), entry.is_dir(follow_symlinks=False)
                    try:
                        stat = entry.stat(follow_symlinks=False)
                        size, modified = stat.st_size, stat.st_mtime_ns // 1000
                    except OSError:
                        size, modified = 0, None
                    target = os.path.join(folder, os.readlink(entry.path)) if link else None
                    rows.append((entry.path, is_dir, link, target and os.path.normpath(target), 0 if is_dir or link else size, modified, None))
                    if len(rows) == 10_000:
                        yield pd.DataFrame(rows, columns=columns).astype({"modified_us": "Int64"})
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns).astype({"modified_us": "Int64"})


def _walk(spark: SparkSession, root: str, scan: Callable[[DataFrame], DataFrame], schema: str, enter: str) -> DataFrame:
    """What ``scan`` finds in folders (path), level by level, the folders of a level in parallel; it enters rows that meet ``enter``.

    Each level is written out before the next is read, so a lost executor repeats one level at most and the driver never sees
    the listing.
    """
    out = shared_dir(spark, "walk")
    level, depth = spark.createDataFrame([(root,)], "path string"), 0
    while True:
        done = materialise(scan(dealt(level, "path")), "level", f"{out}/level={depth}")
        level = done.filter(enter).select("path")
        if level.isEmpty():
            return spark.read.schema(schema).parquet(out).drop("level")
        depth += 1


def walk_tree(spark: SparkSession, root: str, skip: DataFrame | None = None) -> DataFrame:
    """List a mounted tree level by level (``_walk``).

    A folder that cannot be read has a second row with its ``error``.
    ``skip`` holds folders (folder) not to enter.
    """

    def scan(level: DataFrame) -> DataFrame:
        found = level.mapInPandas(_scan_folders, ENTRY)
        if skip is not None:
            found = found.join(skip.select(F.col("folder").alias("path")).distinct(), "path", "left_anti").select(*found.columns)
        return found

    return _walk(spark, root, scan, ENTRY, "is_dir and error is null")


def freeze(entries: DataFrame, root: str, dest: str) -> DataFrame:
    """A listing with ``ord`` fixed once, in path order, ready for planning.

    Rows are range-partitioned and sorted, written, and numbered from the
    position they were written at: file order, then row order in the file.
    """
    files = entries.filter("not is_dir").drop("is_dir", "error")
    return in_path_order(files).select(
        "ord", "path", "is_link", "link_target",
        paths.object_name(F.col("path"), root, dest).alias("object_name"), "size",
    )


def in_path_order(files: DataFrame, path: str = "path") -> DataFrame:
    """Add ``ord``: 0, 1, ... in the order of paths. Whatever lies below a folder is then one interval of ``ord``."""
    placed = files.orderBy(path).withColumn("_row", F.monotonically_increasing_id())
    return ordered.numbered(materialise(placed, "listing"), [], "_row", "ord", shifts=(20, 23)).drop("_row")


def with_prefix(keys: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """Objects below a prefix; pushed down to a parquet listing."""
    return keys.filter(F.startswith(F.col(key), F.lit(prefix)))


def buckets(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Configured buckets from JSON: files of one array of {name, description} each, or with ``lines`` one object or array per line."""
    return spark.read.schema("name string, description string").json(path, multiLine=not lines)


def synthetic_tree(folders: DataFrame, files_per_folder: int, size: int, folder: str = "folder") -> DataFrame:
    """A made-up listing: every folder gets the same number of files of the same size."""
    name = F.concat(F.col(folder), F.lit("/"), paths.base_name(F.col(folder)), F.lit("_"), F.col("j").cast("string"), F.lit(".f"))
    return folders.select(folder, F.explode(F.sequence(F.lit(1), F.lit(files_per_folder))).alias("j")).select(
        name.alias("path"), F.lit(size).cast("long").alias("size")
    )
