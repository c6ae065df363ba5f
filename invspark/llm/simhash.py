"""Near-duplicate documents by SimHash, with pivot distance tables.

Documents are reduced to 64-bit fingerprints, equal fingerprints to one row.
Two fingerprints link if they differ in at most ``radius`` bits.

*Views.* Cut 64 bits into eight blocks of eight. Fingerprints that differ in at
most two bits agree outside some two blocks, so they share a key in one of the
28 views that each leave out two blocks. Members of a group (equal key in a
view) differ in 16 bits only: a group holds at most 65,536 fingerprints,
whatever the data. No key is capped and nothing is dropped.

*Pivot tables.* For the members of each group the Hamming distances to many
reference fingerprints are computed first. By the triangle inequality a pair
can only link if no distance differs by more than ``radius``, so pairs are
discarded by the maximum coordinate difference; members sorted by the first
distance make whole runs of pairs drop out unseen. Survivors are verified by
counting differing bits.

*Links, not pairs.* A group gives one link from each member to the smallest
member it is connected with inside the group, so output is linear even where
all members are near each other. Components are found by contraction: every
node points to its smallest neighbour, edges move to the pointed-to nodes, and
at least half the nodes that still have edges disappear in every round.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import batches, materialise, outside

WIDTH = 3
RADIUS = 2
BLOCKS = 8
N_PIVOTS = 32
SEED = 42
#: Shingles hashed and counted at a time, so that one long text needs bounded memory beside itself.
STEP = 1 << 15
#: Pairs of a group looked at together.
PAIRS = 1 << 20


def votes(words: list[bytes], width: int) -> tuple[np.ndarray, int]:
    """For each of 64 bits (highest first) in how many shingle hashes it is set, and the number of shingles."""
    if not words:
        return np.zeros(64, np.int64), 0
    count = max(1, len(words) - width + 1)
    total = np.zeros(64, np.int64)
    for start in range(0, count, STEP):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in range(start, min(count, start + STEP))),
            dtype=">u8",
        )
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return total, count


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """A to Z lower-cased, words between ``[\\x20\\x09-\\x0D]+``, shingles with repeats; 0 without words."""
    total, count = votes((text or "").encode().lower().split(), width)
    return int.from_bytes(np.packbits(2 * total > count).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", name: str = "fingerprint", width: int = WIDTH) -> DataFrame:
    """Replace ``text`` by a signed 64-bit fingerprint. Null and empty texts get 0. Rows are independent."""
    kept = [c for c in outside(docs, [name]) if c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(name, T.LongType(), False)])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints = pa.array([fingerprint(x.as_py(), width) for x in part.column(len(kept))], pa.int64())
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], prints], names=[*kept, name])

    return docs.select(*kept, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def pivots(n: int = N_PIVOTS) -> np.ndarray:
    """Reference fingerprints, fixed by a seed; drawn, so that distances to them spread in every view."""
    return np.random.default_rng(64).integers(0, 1 << 64, n, dtype=np.uint64)


def links(members: np.ndarray, references: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """(first, second) places of distinct ``members`` (uint64) that differ in at most ``radius`` bits.

    Only pairs whose distances to every reference differ by at most ``radius`` are verified.
    """
    table = np.bitwise_count(members[:, None] ^ references[None, :]).astype(np.int8)
    order = np.argsort(table[:, 0], kind="stable")
    table, members = table[order], members[order]
    # In order of the first coordinate, the partners of a row end where it has grown by more than the radius.
    ends = np.searchsorted(table[:, 0], table[:, 0] + radius, side="right")
    found, start = [(order[:0], order[:0])], 0
    while start < len(members):
        stop = min(len(members), start + max(1, PAIRS // int(ends[start] - start)))
        last = int(ends[stop - 1])
        first, second = np.nonzero(np.arange(start, last)[None, :] > np.arange(start, stop)[:, None])
        first, second = first + start, second + start
        for k in range(table.shape[1]):
            near = np.abs(table[first, k] - table[second, k]) <= radius
            first, second = first[near], second[near]
        near = np.bitwise_count(members[first] ^ members[second]) <= radius
        found.append((order[first[near]], order[second[near]]))
        start = stop
    return np.concatenate([f for f, _ in found]), np.concatenate([s for _, s in found])


def roots(n: int, first: np.ndarray, second: np.ndarray) -> list[int]:
    """The smallest place each of ``n`` places is connected with."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(first.tolist(), second.tolist()):
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [root(x) for x in range(n)]


def groups(parts: Iterable[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The members of each key that has several, from rows (key, fingerprint) in order of the key."""
    keys, prints = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for part in itertools.chain(parts, [None]):
        if part is not None:
            keys = np.concatenate([keys, part.column(0).to_numpy()])
            prints = np.concatenate([prints, part.column(1).to_numpy()])
        if not len(keys):
            continue
        starts = np.concatenate([[0], np.nonzero(keys[1:] != keys[:-1])[0] + 1, [len(keys)]])
        # The last key may go on in the next batch.
        ready = len(starts) - (1 if part is None else 2)
        sizes = np.diff(starts)
        for k in np.nonzero(sizes[:ready] > 1)[0]:
            yield prints[starts[k] : starts[k + 1]]
        keys, prints = keys[starts[ready] :], prints[starts[ready] :]


def _group_links(parts: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    references = pivots()

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for members in groups(parts):
            members = np.sort(members)
            first, second = links(members.view(np.uint64), references, radius)
            if len(first):
                home = np.array(roots(len(members), first, second))
                moved = np.nonzero(home != np.arange(len(members)))[0]
                yield members[home[moved]], members[moved]

    for some in batches(found(), lambda pair: 16 * len(pair[0])):
        columns = [pa.array(np.concatenate([pair[k] for pair in some])) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def _view_keys(name: str) -> list:
    """One key per view: the view's number above the 48 bits that it keeps."""
    size = 64 // BLOCKS
    block = lambda b: F.shiftrightunsigned(F.col(name), size * b).bitwiseAND(F.lit((1 << size) - 1).cast("long"))
    keys = []
    for view, left_out in enumerate(itertools.combinations(range(BLOCKS), 2)):
        key = F.lit(view << (64 - 2 * size)).cast("long")
        for place, b in enumerate(b for b in range(BLOCKS) if b not in left_out):
            key = key.bitwiseOR(F.shiftleft(block(b), size * place))
        keys.append(key)
    return keys


def near_links(prints: DataFrame, name: str = "fingerprint", radius: int = RADIUS) -> DataFrame:
    """Links (a < b) among distinct fingerprints, enough to connect all that differ in at most ``radius`` bits."""
    if radius > 2:
        raise ValueError("views leave out two blocks: the radius is 2 at most")
    keyed = prints.select(F.explode(F.array(*_view_keys(name))).alias("key"), F.col(name).alias("_f"))
    together = keyed.repartition("key").sortWithinPartitions("key")
    return together.mapInArrow(lambda parts: _group_links(parts, radius), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the smallest node it is connected with.

    Contraction: each round every node takes its smallest neighbour (itself, if none is smaller) as parent, edges
    move to the parents, and loops and repeats go. Rounds are written to the shared folder. The chains of parents
    are then followed from the last round back. Rounds grow with the logarithm of the longest chain.
    """
    spark, hops = edges.sparkSession, []
    edges = materialise(edges.select("a", "b").filter("a <> b"), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parents = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("parent")), "parents")
        hops.append(parents)
        for end in ("a", "b"):
            moved = parents.withColumnRenamed("node", end)
            other = "b" if end == "a" else "a"
            edges = edges.join(moved, end).select(F.col("parent").alias(end), other)
        edges = materialise(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    if not hops:
        return spark.createDataFrame([], "node long, root long")
    found = hops[-1].withColumnRenamed("parent", "root")
    for parents in reversed(hops[:-1]):
        onward = found.withColumnRenamed("node", "parent")
        found = materialise(parents.join(onward, "parent", "left").select("node", F.coalesce("root", "parent").alias("root")), "roots")
    return found


def homes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fingerprint, root): the class of every distinct fingerprint of ``prints``, named by one of its members."""
    distinct = materialise(prints.select("fingerprint").distinct(), "distinct")
    found = materialise(components(near_links(distinct, "fingerprint", radius)), "components")
    return distinct.join(found, distinct["fingerprint"] == found["node"], "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """(``id``, fingerprint long, component_id): one row per row of ``docs``.

    ``component_id`` is the smallest ``id`` reachable over fingerprints that differ in at most ``radius`` bits.
    Null and empty texts have fingerprint 0 and link like any other. Null ids do not name a class: a class of
    null ids only has a null component. Repeated rows stay repeated. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id).alias("_id"), F.col(text).alias("_text"))
    prints = materialise(fingerprints(rows, "_text", "fingerprint", width), "fingerprints")
    home = materialise(homes(prints, radius), "homes")
    # Copies are one row from here on: counted map-side, so that a hot fingerprint costs no more than another.
    least = prints.groupBy("fingerprint").agg(F.min("_id").alias("least"))
    smallest = home.join(least, "fingerprint").groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(home.join(smallest, "root").select("fingerprint", "component_id"), "classes")
    return prints.join(named, "fingerprint").select(F.col("_id").alias(id), "fingerprint", "component_id")


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """One row of each class, with its own columns: that with the smallest ``id`` (null ids last, then any one row)."""
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.monotonically_increasing_id().alias("_n"), F.col(id).alias("_id"), F.col(text).alias("_text"),
    )
    # Written once, so that row numbers stay what they are when a task runs again.
    whole = materialise(fingerprints(whole, "_text", "fingerprint", width), "documents")
    home = materialise(homes(whole, radius), "homes")
    # The best row of a fingerprint first: hot fingerprints shrink map-side before they meet their class.
    order = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_n").alias("n"))
    best = whole.groupBy("fingerprint").agg(F.min(order).alias("best"))
    chosen = best.join(home, "fingerprint").groupBy("root").agg(F.min("best").alias("best"))
    return whole.join(chosen.select(F.col("best.n").alias("_n")), "_n", "left_semi").select("_doc.*")
