"""Hard negatives: rows of another label that score near, but not too near, a row's positives.

Scores are inner products of whole numbers, so results are exact. Vectors of one
label are packed into R-trees by sort-tile-recursion: Spark cuts them into
ranges of their first component, a task tiles a range further by the components
that spread most. The box of a node bounds each component, and with it each term
of an inner product, from both sides; the sums of these intervals bound every
score below the node. A search takes nodes by their upper bound, highest first.
A window of scores discards a box that lies outside it, or whose upper bound is
strictly below its kth score so far; at the kth score itself a smaller id may
still win, so such boxes are read.

There are two passes over the trees: those of an anchor's own label give its
positives, these set the windows, and the trees of other labels give the
negatives of all windows of an anchor in one search. Work is a grid: trees are
dealt over buckets and blocks of anchors over groups, each bucket meets each
group once, and there a block searches the trees one after the other.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise
from .vafile import scores, whole

LEAF = 256
FANOUT = 16
#: Vectors of one tree, anchors of one block, and most trees of a bucket.
TREE = 1 << 14
BLOCK = 1 << 10
TREES = 32
#: Scores that are worth a task.
UNIT = 1 << 24
EXACT = float(1 << 53)

ROWS = "id long, label long, dim int, first double, kind string, exact binary"
PACKED = "tree long, label long, dim int, kind string, ids binary, exact binary, starts binary, low binary, high binary"
FOUND = "a long, w int, id long, score long"


def thin(values: np.ndarray) -> str:
    """The smallest type that holds these whole numbers."""
    most = np.abs(values).max(initial=0)
    return "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"


def _rows(parts: Iterable[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for dim, (places, values) in whole(part.column(2), scale).items():
            kind, at = thin(values), pa.array(places)
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(at), part.column(1).take(at), pa.array(np.full(len(at), dim, np.int32)),
                 pa.array(values[:, 0] if dim else np.zeros(len(at))), pa.array([kind] * len(at)), pa.array([row.tobytes() for row in values.astype(kind)], pa.binary())],
                names=["id", "label", "dim", "first", "kind", "exact"],
            )


def tiles(values: np.ndarray, rows: np.ndarray, axes: np.ndarray, leaf: int) -> Iterator[np.ndarray]:
    """Sort-tile-recursion: ``rows`` in leaves of at most ``leaf``, cut by one axis after the other."""
    pages = -(-len(rows) // leaf)
    if pages <= 1:
        yield rows
        return
    slabs = pages if len(axes) <= 1 else int(np.ceil(pages ** (1 / len(axes))))
    ordered = rows[np.argsort(values[rows, axes[0]], kind="stable")] if len(axes) else rows
    width = leaf * -(-pages // slabs)
    for begin in range(0, len(rows), width):
        yield from tiles(values, ordered[begin : begin + width], axes[1:], leaf)


def build(ids: np.ndarray, values: np.ndarray) -> dict[str, np.ndarray]:
    """A packed tree: vectors in the order of their leaves, where leaves start, and the boxes of all nodes, leaves first, the root last."""
    leaves = list(tiles(values, np.arange(len(ids)), np.argsort(-values.std(axis=0), kind="stable"), LEAF))
    order = np.concatenate(leaves)
    starts = np.cumsum([0] + [len(x) for x in leaves[:-1]])
    low, high = [np.minimum.reduceat(values[order], starts)], [np.maximum.reduceat(values[order], starts)]
    while len(low[-1]) > 1:
        at = np.arange(0, len(low[-1]), FANOUT)
        low.append(np.minimum.reduceat(low[-1], at))
        high.append(np.maximum.reduceat(high[-1], at))
    return {"ids": ids[order], "exact": values[order], "starts": starts, "low": np.concatenate(low), "high": np.concatenate(high)}


def _trees(parts: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Trees of a range sorted by label and length; at most ``size`` vectors are held."""
    held: list[tuple[int, np.ndarray]] = []
    now, home, made = None, 0, 0

    def tree() -> pa.RecordBatch:
        nonlocal held, made
        found = build(np.array([i for i, _ in held], np.int64), np.array([v for _, v in held], np.float64).reshape(len(held), now[1]))
        kind, held, made = thin(found["exact"]), [], made + 1
        kinds = {"ids": "<i8", "starts": "<i4"}
        blobs = {name: pa.array([found[name].astype(kinds.get(name, kind)).tobytes()], pa.binary()) for name in ("ids", "exact", "starts", "low", "high")}
        whose = {"tree": pa.array([home << 32 | made], pa.int64()), "label": pa.array([now[0]], pa.int64()), "dim": pa.array([now[1]], pa.int32()), "kind": pa.array([kind])}
        return pa.RecordBatch.from_pydict(whose | blobs)

    for part in parts:
        for id, label, dim, kind, exact, home in zip(*(part.column(c).to_pylist() for c in ("id", "label", "dim", "kind", "exact", "home"))):
            if held and (now != (label, dim) or len(held) == size):
                yield tree()
            now = label, dim
            held.append((id, np.frombuffer(exact, kind)))
    if held:
        yield tree()


class Tree:
    """A packed tree as read back."""

    def __init__(self, row: dict):
        dim, kind = row["dim"], row["kind"]
        self.ids, starts = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["starts"], "<i4")
        self.exact = np.frombuffer(row["exact"], kind).astype(np.float64).reshape(len(self.ids), dim)
        self.ends = [*starts.tolist(), len(self.ids)]
        self.n_leaves = count = len(starts)
        # Nodes of a level above lie behind those of the level below, each over the next FANOUT of them.
        self.children: dict[int, range] = {}
        begin = 0
        while count > 1:
            above = -(-count // FANOUT)
            for i in range(above):
                self.children[begin + count + i] = range(begin + i * FANOUT, begin + min((i + 1) * FANOUT, count))
            begin, count = begin + count, above
        self.root = begin
        self.low, self.high = (np.frombuffer(row[name], kind).astype(np.float64).reshape(begin + 1, dim) for name in ("low", "high"))

    def scores(self, node: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and exact scores of a leaf."""
        rows = slice(self.ends[node], self.ends[node + 1])
        return self.ids[rows], (self.exact[rows] @ query).astype(np.int64) if self.safe else scores(query[None, :], self.exact[rows])[0]

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query and node, what a score below the node can be: at least, and at most. Also notes whether doubles hold all scores exactly."""
        over, under = np.maximum(queries, 0), np.minimum(queries, 0)
        least, most = over @ self.low.T + under @ self.high.T, over @ self.high.T + under @ self.low.T
        terms = np.abs(queries) @ np.maximum(np.abs(self.low), np.abs(self.high)).T
        self.safe = terms.max(initial=0) < EXACT
        # Sums below 2**53 are exact; beyond, rounding is made up for.
        slack = np.where(terms < EXACT, 0.0, terms * (queries.shape[1] + 1) * 2.0**-52)
        return least - slack, most + slack


class Asked:
    """A window of scores and the ``k`` best found in it, higher scores first, then smaller ids."""

    def __init__(self, least: int | float, most: int | float, k: int):
        self.least, self.most, self.k, self.best = least, most, k, []

    @property
    def need(self) -> int | float:
        """No score below this can be among the best."""
        return self.least if len(self.best) < self.k else max(self.least, -self.best[-1][0])

    def offer(self, found: list[tuple[int, int]]) -> None:
        self.best = sorted(self.best + [(-s, i) for s, i in found if self.least <= s <= self.most])[: self.k]


def search(tree: Tree, query: np.ndarray, own: int, windows: list[Asked], least: np.ndarray, most: np.ndarray) -> int:
    """Fill the windows of one query from one tree, best boxes first; rows with the id ``own`` do not count. Returns how many leaves were read."""
    heap, read = [(-float(most[tree.root]), tree.root)], 0
    while heap:
        bound, node = heapq.heappop(heap)
        open_ = [w for w in windows if w.need <= -bound]
        if not open_:
            break  # no later box reaches any window either
        low = float(least[node])
        if all(w.most < low for w in open_):
            continue
        floor = min(w.need for w in open_)
        if node < tree.n_leaves:
            read += 1
            ids, got = tree.scores(node, query)
            good = np.nonzero((got >= floor) & (ids != own))[0]
            if len(good):
                found = list(zip(got[good].tolist(), ids[good].tolist()))
                for w in open_:
                    w.offer(found)
        else:
            for child in tree.children[node]:
                if most[child] >= floor:
                    heapq.heappush(heap, (-float(most[child]), child))
    return read


def _search(parts: Iterable[pa.RecordBatch], k: int, share: tuple[int, int] | None) -> Iterator[pa.RecordBatch]:
    """Units of one tree and one block of anchors: positives, or, with the ``share`` of a positive score that a negative may have, negatives.

    Units of a block that come one after the other share its windows: what one tree gave lets the next be read less.
    """
    now, asked, queries, windows = None, [], None, []

    def found() -> Iterator[pa.RecordBatch]:
        out = [(anchor["a"], w, id, -score) for anchor, mine in zip(asked, windows) for w, window in enumerate(mine) for score, id in window.best]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64()))], names=["a", "w", "id", "score"])

    for part in parts:
        for row in range(len(part)):
            unit = {name: part.column(name)[row].as_py() for name in ("own", "block", "bucket", "dim", "kind", "ids", "exact", "starts", "low", "high")}
            if now != (now := (unit["own"], unit["dim"], unit["block"], unit["bucket"])):
                yield from found()
                asked = part.column("anchors")[row].as_py()
                queries = np.array([np.frombuffer(x["exact"], x["kind"]) for x in asked], np.float64).reshape(len(asked), unit["dim"])
                if share is None:
                    windows = [[Asked(-np.inf, np.inf, k)] for _ in asked]
                else:
                    windows = [[Asked(-(-share[0] * s // 100), share[1] * s // 100, k) for s in anchor["scores"]] for anchor in asked]
            tree = Tree(unit)
            least, most = tree.bounds(queries)
            for place, (anchor, mine) in enumerate(zip(asked, windows)):
                search(tree, queries[place], anchor["id"], [w for w in mine if w.least <= w.most], least[place], most[place])
    yield from found()


def forest(rows: DataFrame, size: int) -> DataFrame:
    """The written trees of written rows."""
    order = [F.asc("label"), F.asc("dim"), F.asc("first"), F.asc("id"), F.asc("row")]
    ranged = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(max(1, -(-rows.count() // size)), *order)
    packed = ranged.sortWithinPartitions(*order).withColumn("home", F.spark_partition_id().cast("long"))
    return materialise(packed.mapInArrow(lambda parts: _trees(parts, size), PACKED), "trees")


def grid(n_trees: int, vectors: int, anchors: int, tasks: int) -> tuple[int, int]:
    """How many buckets of trees and groups of anchors make the units of work: each bucket meets each group in one place.

    Anchors are sent once per bucket and trees once per group, so buckets outnumber groups as vectors do anchors. There are as many
    units as the scores are worth, at most ``tasks``, and more only to keep the trees of a bucket few.
    """
    units = max(1, min(tasks, -(-vectors * anchors // UNIT)))
    buckets = max(1, min(n_trees, max(-(-n_trees // TREES), round((units * vectors / max(1, anchors)) ** 0.5))))
    return buckets, -(-units // buckets)


def _each(name: str, n: int) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))).alias(name)


def mine(
    vectors: DataFrame, anchors: str, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows that the SQL condition ``anchors`` selects. A row's score is the inner product of floor(``scale`` * x) with
    the anchor; an anchor's positives are the ``positives`` best rows of its label, its negatives per positive the ``negatives``
    best rows of other labels with ``low`` to ``high`` per cent of the positive's score. Ties go to smaller ids.

    Rows without an id or a label, null vectors and those with a null or non-finite component take no part; vectors are compared with
    those of their length only. Rows that bear the anchor's own id count neither as positive nor as negative. Repeated rows are rows
    each, as anchors, positives and negatives. Anchors without positives, and positives without a row in their window (always so
    where their score is below zero), give no rows; an empty table gives none. Scores beyond a long are held at its ends.
    """
    spark = vectors.sparkSession
    known = vectors.select(F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(F.expr(anchors), F.lit(False)).alias("asked"))
    known = known.filter("id is not null and label is not null and v is not null")
    convert = lambda df: df.select("id", "label", "v").mapInArrow(lambda parts: _rows(parts, scale), ROWS)
    trees = forest(materialise(convert(known), "vectors"), TREE)
    asked = materialise(convert(known.filter("asked")).drop("first").withColumn("a", F.monotonically_increasing_id()), "anchors")
    sizes = trees.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("ids") / 8), F.lit(0.0))).first()
    buckets, groups = grid(int(sizes[0]), int(sizes[1]), asked.count(), 2 * spark.sparkContext.defaultParallelism)
    n_blocks = groups * max(1, -(-asked.count() // (groups * BLOCK)))
    dealt = trees.select("*", F.pmod(F.xxhash64("tree"), F.lit(buckets)).alias("bucket"), _each("group", groups))

    def found(anchors: DataFrame, same_label: bool, k: int, share=None) -> DataFrame:
        carried = [c for c in anchors.columns if c not in ("label", "dim")]
        blocks = anchors.groupBy(F.col("label").alias("own"), "dim", F.pmod("a", F.lit(n_blocks)).alias("block")).agg(F.collect_list(F.struct(*carried)).alias("anchors"))
        sent = blocks.select("*", F.pmod("block", F.lit(groups)).alias("group"), _each("bucket", buckets))
        # A merge join streams its left side: all trees of a bucket follow for one block, then those for the next.
        units = sent.hint("merge").join(dealt, ["bucket", "group", "dim"]).filter(F.col("label") == F.col("own") if same_label else F.col("label") != F.col("own"))
        rank = F.row_number().over(Window.partitionBy("a", "w").orderBy(F.desc("score"), "id"))
        best = units.drop("tree", "label", "group").mapInArrow(lambda parts: _search(parts, k, share), FOUND)
        return best.withColumn("rank", rank).filter(F.col("rank") <= k)

    paired = materialise(found(asked, True, positives).drop("w"), "positives")
    windows = paired.groupBy("a").agg(F.array_sort(F.collect_list(F.struct("rank", "score"))).alias("ranked"))
    with_windows = asked.join(windows, "a").withColumn("scores", F.transform("ranked", lambda x: x["score"])).drop("ranked")
    hard = found(with_windows, False, negatives, (low, high))
    whose = paired.select("a", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = whose.join(asked.select("a", F.col("id").alias("anchor_id")), "a")
    return hard.join(named, ["a", "w"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
