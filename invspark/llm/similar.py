"""SimHash near-duplicates at a similarity well below equality (five words, 0.8 and up).

At such distances no set of exact keys is complete and small, so wide
fingerprints (256 bits) meet in two steps. Each of ``TABLES`` tables shuffles
the bits in its own order and brings together what agrees in the first byte;
among those, what agrees in any of the ``INNER`` pairs of the other bytes is a
run. The second step costs no shuffle, so there can be many: a pair at the
radius itself (51 bits) shares a run with a chance of 0.9998, closer pairs more
surely.

Within a run of any size all pairs are connected that differ in at most
``radius`` bits. Pairs already connected are not looked at again, so near copies
cost a comparison each, not one by pair. As in ``simhash``, distances to some
pivots (members) are tabled, and by the triangle inequality pairs drop out whose
maximum coordinate difference exceeds the radius; what is left is verified by
counting differing bits. In a long run, members outside its largest class are
held against the others in order of the first coordinate, where only a stretch
of them can be near. Links go through the same components as those of
``simhash``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from .common import batches, materialise
from .simhash import SEED, STEP, components, roots

LANES = 4
BITS = 64 * LANES
TABLES = 48
#: Bytes of a table's order whose equality makes a run; byte 0 is the table's key.
INNER = [(1 + i, 1 + (i + gap) % (BITS // 8 - 1)) for gap in (1, 2, 3, 4) for i in range(BITS // 8 - 1)]
WIDTH = 5
SIMILARITY = 0.8
#: In runs up to this size pairs are compared place by place, in longer ones member by member; both connect the same.
SMALL = 16
#: Columns of a pivot table.
N_PIVOTS = 8
#: Rows looked at together, if no group is larger.
CHUNK = 1 << 16


def fingerprint(text: str | None, width: int = WIDTH) -> np.ndarray:
    """``LANES`` longs. Lane 0 votes with the shingles' XXH64, the others with mixtures of it; no words: all bits 0."""
    words = (text or "").encode().lower().split()
    count = max(1, len(words) - width + 1) if words else 0
    total = np.zeros(BITS, np.int64)
    for start in range(0, count, STEP):
        stop = min(count, start + STEP)
        hashes = np.fromiter((xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), SEED) for i in range(start, stop)), np.uint64, stop - start)
        for lane in range(LANES):
            x = hashes
            if lane:
                x = (x ^ (x >> np.uint64(31))) + np.uint64(0x9E3779B97F4A7C15 * lane & (1 << 64) - 1)
                x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                x = x ^ (x >> np.uint64(31))
            bits = np.unpackbits(x.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            total[64 * lane : 64 * lane + 64] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(2 * total > count).view(">i8").astype(np.int64)


NAMES = [f"f{lane}" for lane in range(LANES)]


def fingerprints(docs: DataFrame, text: str, width: int) -> DataFrame:
    """Replace ``text`` by the columns f0, f1, ..."""
    kept = [c for c in docs.columns if c != text]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(n, T.LongType(), False) for n in NAMES])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            prints = np.array([fingerprint(x.as_py(), width) for x in part.column(len(kept))], np.int64).reshape(-1, LANES)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(prints[:, lane].copy()) for lane in range(LANES))], names=[*kept, *NAMES])

    return docs.select(*kept, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def table_orders() -> np.ndarray:
    """The order of the bits in each table, fixed by a seed."""
    rng = np.random.default_rng(18)
    return np.array([rng.permutation(BITS) for _ in range(TABLES)])


def _spread(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, f0, ...): for each table its number above the first byte, and the bits in its order."""
    orders = table_orders()
    for part in parts:
        for start in range(0, len(part), 1000):
            some = part.slice(start, 1000)
            prints = np.stack([some.column(1 + lane).to_numpy() for lane in range(LANES)], axis=1)
            bits = np.unpackbits(prints.astype(">i8").view(np.uint8).reshape(len(prints), -1), axis=1)
            moved = np.ascontiguousarray(np.stack([np.packbits(bits[:, order], axis=1) for order in orders], axis=1))
            key = np.arange(TABLES, dtype=np.int64) << 8 | moved[:, :, 0]
            lanes = moved.reshape(-1, BITS // 8).view(np.int64)
            columns = [key.ravel(), np.repeat(some.column(0).to_numpy(), TABLES), *(lanes[:, lane].copy() for lane in range(LANES))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "node", *NAMES])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """The distances of each row to ``N_PIVOTS`` of them, spread evenly."""
    return np.stack([distances(prints, prints[one]).astype(np.int16) for one in np.linspace(0, len(prints) - 1, N_PIVOTS).astype(int)], axis=1)


def within(table: np.ndarray, first, second, radius: int) -> np.ndarray:
    """Which of the pairs may be near: those whose distances to no pivot differ by more than the radius."""
    return np.abs(table[first] - table[second]).max(axis=1, initial=0) <= radius


def merged(label: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """The labels (the smallest place of each class) after the classes of linked places become one."""
    if not len(first):
        return label
    ids, ends = np.unique(np.concatenate([label[first], label[second]]), return_inverse=True)
    target = np.arange(len(label))
    target[ids] = ids[roots(len(ids), ends[: len(first)], ends[len(first) :])]
    return target[label]


def sweep(prints: np.ndarray, label: np.ndarray, radius: int) -> np.ndarray:
    """Labels of one run's members, with all pairs connected that are within the radius."""
    label, table = np.unique(label, return_inverse=True)[1], pivot_table(prints)

    def take(one: int, near: np.ndarray) -> None:
        near = near[label[near] != label[one]]
        if len(near):
            label[np.isin(label, label[near])] = label[one]

    for one, apart in zip(np.linspace(0, len(prints) - 1, N_PIVOTS).astype(int), table.T):
        take(one, np.flatnonzero(apart <= radius))
    # One class is settled on; pairs inside it are connected, so only the members outside need a look at the others.
    anchor = np.flatnonzero(label == np.bincount(label).argmax())[0]
    first = distances(prints, prints[anchor])
    order = np.argsort(first, kind="stable")
    sorted_ = first[order]
    for one in np.flatnonzero(label != label[anchor]):
        if label[one] != label[anchor]:
            low, high = np.searchsorted(sorted_, [first[one] - radius, first[one] + radius + 1])
            others = order[low:high]
            others = others[label[others] != label[one]]
            others = others[within(table, others, one, radius)]
            take(one, others[distances(prints[others], prints[one]) <= radius])
    return label


def connect(key: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For rows of whole groups, in order of the key: the smallest place each is connected with over runs of its group."""
    label, table = np.arange(len(key)), pivot_table(prints)
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) << 16
    columns = np.ascontiguousarray(prints.view(np.uint8).reshape(len(key), -1).T).astype(np.int64)
    for a, b in INNER:
        run = group | columns[a] << 8 | columns[b]
        order = np.argsort(run)
        run = run[order]
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        if len(starts) == len(run):
            continue
        sizes, labels = np.diff(np.append(starts, len(run))), label[order]
        mixed = np.minimum.reduceat(labels, starts) != np.maximum.reduceat(labels, starts)
        places = np.flatnonzero(np.repeat(mixed & (sizes <= SMALL), sizes))
        some, at = run[places], order[places]
        found = [(order[:0], order[:0])]
        for apart in range(1, SMALL):
            first = np.flatnonzero(some[:-apart] == some[apart:])
            if not len(first):
                break
            x, y = at[first], at[first + apart]
            near = label[x] != label[y]
            x, y = x[near], y[near]
            near = within(table, x, y, radius)
            x, y = x[near], y[near]
            near = distances(prints[x], prints[y]) <= radius
            found.append((x[near], y[near]))
        for k in np.flatnonzero(mixed & (sizes > SMALL)):
            members = order[starts[k] : starts[k] + sizes[k]]
            classes = sweep(prints[members], label[members], radius)
            heads = members[np.unique(classes, return_index=True)[1]]
            found.append((heads[np.unique(classes, return_inverse=True)[1]], members))
        label = merged(label, np.concatenate([x for x, _ in found]), np.concatenate([y for _, y in found]))
    return label


def whole_groups(parts: Iterable[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(key, node, prints) of whole groups, about ``CHUNK`` rows at a time, from rows in order of the key."""
    held, total, wanted = [], 0, CHUNK
    for part in itertools.chain(parts, [None]):
        if part is not None and len(part):
            held.append((part.column(0).to_numpy(), part.column(1).to_numpy(), np.stack([part.column(2 + lane).to_numpy() for lane in range(LANES)], axis=1).view(np.uint64)))
            total += len(part)
        if not total or part is not None and total < wanted:
            continue
        key, node, prints = (np.concatenate([h[k] for h in held]) for k in range(3))
        # The last group may go on in the next batch.
        ready = len(key) if part is None else int(np.searchsorted(key, key[-1]))
        if ready:
            yield key[:ready], node[:ready], prints[:ready]
        held, total = [(key[ready:], node[ready:], prints[ready:])], len(key) - ready
        wanted = max(CHUNK, 2 * total)


def link(parts: Iterable[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Links from rows (key, node, f0, ...) in order of the key: from each member to one it is connected with in its group."""

    def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for key, node, prints in whole_groups(parts):
            label = connect(key, prints, radius)
            moved = np.flatnonzero(label != np.arange(len(label)))
            if len(moved):
                yield node[label[moved]], node[moved]

    for some in batches(found(), lambda pair: 16 * len(pair[0])):
        ends = np.sort(np.stack([np.concatenate([pair[i] for pair in some]) for i in (0, 1)]), axis=0)
        # The same pair meets in many tables.
        ends = np.unique(ends, axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(ends[0].copy()), pa.array(ends[1].copy())], names=["a", "b"])


def links(nodes: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) among rows (node, f0, ...), enough to connect all that meet and agree in at least ``similarity`` of their bits."""
    radius = int(BITS * (1 - similarity) + 1e-9)
    fields = ", ".join(["key long", "node long", *(f"{n} long" for n in NAMES)])
    keyed = nodes.select("node", *NAMES).mapInArrow(_spread, fields)
    together = keyed.repartition("key").sortWithinPartitions("key", "node")
    return together.mapInArrow(lambda parts: link(parts, radius), "a long, b long").distinct()


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """One row of each class of near copies, with its own columns: that with the smallest ``id`` (null ids last, then any one row).

    Classes are connected over links. Null and empty texts have one fingerprint and so form one class; a text of
    fewer words than ``width`` has one shingle. Repeated rows are copies. An empty table stays empty.
    """
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"),
        F.monotonically_increasing_id().alias("_n"), F.col(id).alias("_id"), F.col(text).alias("_text"),
    )
    # Written once, so that row numbers stay what they are when a task runs again.
    whole = materialise(fingerprints(whole, "_text", width), "documents")
    nodes = materialise(whole.groupBy(*NAMES).agg(F.min("_n").alias("node")), "nodes")
    found = components(links(nodes, similarity))
    home = materialise(nodes.join(found, "node", "left").select(*NAMES, F.coalesce("root", "node").alias("root")), "homes")
    order = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"), F.col("_n").alias("n"))
    best = whole.groupBy(*NAMES).agg(F.min(order).alias("best"))
    chosen = best.join(home, NAMES).groupBy("root").agg(F.min("best").alias("best"))
    return whole.join(chosen.select(F.col("best.n").alias("_n")), "_n", "left_semi").select("_doc.*")
