"""Trees and manifests as data sources: ``spark.read.format("tree")``, ``spark.readStream.format("tree")``, ``format("manifests")``.

Partitions are the folders found down to the option ``depth``, each read with
all below it by one task, and the entries on the way to them. Filters on the
path's beginning leave whole folders unread; those on size and time drop
entries before they reach Spark. The tree must be mounted on every worker.
"""

from __future__ import annotations

import json
import os
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan,
    LessThanOrEqual, StringStartsWith,
)

ENTRIES = "path string, is_dir boolean, is_link boolean, link_target string, size long, modified_us long, changed_us long, error string"
COLUMNS = [column.split()[0] for column in ENTRIES.split(", ")]
TESTS = {
    EqualTo: lambda a, b: a == b, GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b,
    LessThanOrEqual: lambda a, b: a <= b,
}


def entries(folder: str) -> Iterator[tuple]:
    """One row per entry of a folder, and one with an error if it cannot be listed."""
    try:
        found = os.scandir(folder)
    except OSError as error:
        yield folder, True, False, None, 0, None, None, type(error).__name__
        return
    with found:
        for entry in found:
            link, is_dir = entry.is_symlink(), entry.is_dir(follow_symlinks=False)
            try:
                stat = entry.stat(follow_symlinks=False)
                size, modified, changed = stat.st_size, stat.st_mtime_ns // 1000, stat.st_ctime_ns // 1000
            except OSError:  # gone since
                size, modified, changed = 0, None, None
            target = os.path.normpath(os.path.join(folder, os.readlink(entry.path))) if link else None
            yield entry.path, is_dir, link, target, 0 if is_dir or link else size, modified, changed, None


@dataclass
class Folder(InputPartition):
    """A folder to read, with or without what is below its folders."""

    path: str
    deep: bool


@dataclass
class Changed(Folder):
    """A folder, and the two offsets of a batch."""

    offsets: str


@dataclass
class Wanted:
    """The filters that were pushed: where paths begin, and tests of single columns."""

    prefixes: tuple[str, ...] = ()
    tests: tuple[tuple[str, str, int], ...] = ()

    def enters(self, folder: str) -> bool:
        """Whether anything below a folder can begin like all the prefixes."""
        below = folder.rstrip("/") + "/"
        return all(below.startswith(p) or p.startswith(below) for p in self.prefixes)

    def keeps(self, row: tuple) -> bool:
        if not all(row[0].startswith(p) for p in self.prefixes):
            return False
        by_name = {kind.__name__: test for kind, test in TESTS.items()}
        # A comparison with null is not true.
        return all((value := row[COLUMNS.index(column)]) is not None and by_name[test](value, other) for column, test, other in self.tests)

    def take(self, filters: list[Filter]) -> Iterator[Filter]:
        """Keep what the source can decide by itself; the others are given back."""
        for f in filters:
            column = getattr(f, "attribute", ())  # a negation has none
            name = column[0] if len(column) == 1 else None
            if isinstance(f, StringStartsWith) and name == "path":
                self.prefixes = (*self.prefixes, f.value)
            elif type(f) in TESTS and name in ("size", "modified_us", "changed_us") and isinstance(f.value, int):
                self.tests = (*self.tests, (name, type(f).__name__, f.value))
            else:
                yield f


def spread(root: str, depth: int, wanted: Wanted) -> list[Folder]:
    """The folders of a tree as partitions: those above ``depth`` one by one, those at it with all below."""
    out, level = [], [root]
    for _ in range(depth):
        out += [Folder(path, False) for path in level]
        level = [row[0] for path in level for row in entries(path) if row[1] and row[7] is None and wanted.enters(row[0])]
    return out + [Folder(path, True) for path in level]


def walk(folder: Folder, wanted: Wanted) -> Iterator[tuple]:
    waiting = [folder.path]
    while waiting:
        for row in entries(waiting.pop()):
            if wanted.keeps(row):
                yield row
            if folder.deep and row[1] and row[7] is None and wanted.enters(row[0]):
                waiting.append(row[0])


class TreeReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.depth, self.wanted = options["path"].rstrip("/"), int(options.get("depth", 2)), Wanted()

    def pushFilters(self, filters):
        yield from self.wanted.take(filters)

    def partitions(self):
        return spread(self.root, self.depth, self.wanted)

    def read(self, partition):
        yield from walk(partition, self.wanted)


class TreeStream(DataSourceStreamReader):
    """Entries by the time their status changed, which cannot be set back: an offset is a time, a batch what changed after one and up to the next.

    The newest offset stays ``lag`` behind the clock, as times have a grain. A file that changes again comes again.
    """

    def __init__(self, options):
        self.root, self.depth = options["path"].rstrip("/"), int(options.get("depth", 2))
        self.lag = int(options.get("lag_us", 1_000_000))

    def initialOffset(self):
        return {"changed_us": 0}

    def latestOffset(self):
        return {"changed_us": time.time_ns() // 1000 - self.lag}

    def partitions(self, start, end):
        return [Changed(f.path, f.deep, json.dumps([start, end])) for f in spread(self.root, self.depth, Wanted())]

    def read(self, partition):
        start, end = json.loads(partition.offsets)
        wanted = Wanted(tests=(("changed_us", "GreaterThan", start["changed_us"]), ("changed_us", "LessThanOrEqual", end["changed_us"])))
        yield from walk(partition, wanted)

    def commit(self, end):
        pass


class Tree(DataSource):
    """Options: ``path``, ``depth`` (levels of folders that become partitions, 2 if not given), for streams ``lag_us``."""

    @classmethod
    def name(cls):
        return "tree"

    def schema(self):
        return ENTRIES

    def reader(self, schema):
        return TreeReader(self.options)

    def streamReader(self, schema):
        return TreeStream(self.options)


class ManifestReader(TreeReader):
    """The manifests below a folder: the archive's key, relative to it, and the text."""

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, StringStartsWith) and tuple(f.attribute) == ("zip_key",):
                self.wanted.prefixes = (*self.wanted.prefixes, f"{self.root}/{f.value}")
            else:
                yield f

    def read(self, partition):
        for path, is_dir, *_ in walk(partition, self.wanted):
            if not is_dir and path.endswith(".metadata"):
                with open(path, encoding="utf-8") as text:
                    yield path[len(self.root) + 1 : -len(".metadata")], text.read().rstrip("\n")


class Manifests(Tree):
    """Options as those of ``tree``; rows (zip_key, text)."""

    @classmethod
    def name(cls):
        return "manifests"

    def schema(self):
        return "zip_key string, text string"

    def reader(self, schema):
        return ManifestReader(self.options)


def register(spark: SparkSession) -> None:
    """Make both formats known to a session, and let filters reach them."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (Tree, Manifests):
        spark.dataSource.register(source)
