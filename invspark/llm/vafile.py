"""Exact top-k by inner product with a vector-approximation file.

Vectors are packed into blocks. Beside the exact integer components a block
keeps, per component, the number of the cell (of 16 between the block's
extremes) that the component lies in. A query scans the cells of a block, which
bound every score from above and below; vectors are then read in the order of
their best possible score, until the kth exact score exceeds what any unread
vector can reach. What a scan cannot rule out is always read: results are exact.

Work is a grid of buckets of candidate blocks and groups of query blocks; a cell
of it is a task's. The task holds the queries of the group with the k best so
far, and the candidate blocks of the bucket pass one after the other, so that
what one block gave lets the next be read less. A cell gives the k best per
query; these are ranked again over all cells, limited before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialise

CELLS = 16
BLOCK = 4096
QUERIES = 256
#: Vectors read at a time, in the order of their bounds.
READ = 32
#: Bytes of query vectors that a task holds, about.
HELD = 32 << 20

BLOCKS = "block long, dim int, n int, ids binary, exact binary, cells binary, low binary, high binary"
LONG = (-(1 << 63), (1 << 63) - 1)


def whole(vectors: pa.Array, scale: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: (rows, floor(scale * x) of their components). Vectors null, or with a null or non-finite component, are left out.

    Components are doubles that hold integers exactly up to 2**53; larger ones are whole numbers already.
    """
    flat = vectors.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    ends, there = vectors.offsets.to_numpy(), vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths, out = np.diff(ends), {}
    for dim in np.unique(lengths[there]):
        rows = np.nonzero(there & (lengths == dim))[0]
        taken = np.floor(flat[ends[rows][:, None] + np.arange(dim)[None, :]] * scale)
        finite = np.isfinite(taken).all(axis=1)
        out[int(dim)] = rows[finite], taken[finite]
    return out


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where sums stay below 2**53, else in Python's integers, held to the range of a long."""
    most = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if most < 1 << 53:
        return (queries @ vectors.T).astype(np.int64)
    exact = np.array([[int(x) for x in row] for row in queries], dtype=object) @ np.array([[int(x) for x in row] for row in vectors], dtype=object).T
    return np.array([[min(max(int(x), LONG[0]), LONG[1]) for x in row] for row in exact], dtype=np.int64).reshape(len(queries), len(vectors))


def reach(queries: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """The most that the score of each query with each vector can be, the vectors' components being between ``lower`` and ``upper``."""
    over, under = np.maximum(queries, 0), np.minimum(queries, 0)
    with np.errstate(over="ignore", invalid="ignore"):
        most = np.abs(queries).max(initial=0) * max(np.abs(lower).max(initial=0), np.abs(upper).max(initial=0)) * max(1, queries.shape[1])
        bound = over @ upper.T + under @ lower.T
        if most < 1 << 53:
            return bound
        # Rounding is made up for by the slack; what overflowed can be anything; scores are held to the range of a long.
        bound += most * 1e-12
        bound[np.isnan(bound)] = np.inf
    return np.maximum(bound, LONG[0])


def best(query_ids, queries, ids, exact, cells, low, high, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query of a unit: (its place, ids, scores) of its k best candidates with another id."""
    dims, none = np.arange(exact.shape[1]), (ids[:0], np.zeros(0, np.int64))
    return better(query_ids, queries, ids, exact, low[dims, cells], high[dims, cells], k, [none] * len(queries))


def better(query_ids, queries, ids, exact, lower, upper, k: int, held: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(place, ids, scores) of the k best of what is ``held`` and these candidates, for each query that any of them may be among the best of."""
    bound = reach(queries, lower, upper)
    certain = np.array([scored[-1] if len(scored) == k else -np.inf for _, scored in held], np.float64)
    for place in np.nonzero(bound.max(axis=1, initial=-np.inf) >= certain)[0].tolist():
        mine, (held_i, held_s) = bound[place], held[place]
        if len(held_s) == k:  # only vectors that may reach the kth are put in order
            rest = np.nonzero(mine >= certain[place])[0]
            order = rest[np.argsort(-mine[rest])]
        else:
            rest, first = None, np.argpartition(-mine, READ)[:READ] if len(mine) > READ else np.arange(len(mine))
            order = first[np.argsort(-mine[first])]
        while len(order):
            some, order = order[:READ], order[READ:]
            got = scores(queries[place : place + 1], exact[some])[0]
            other = ids[some] != query_ids[place]
            held_i, held_s = np.concatenate([held_i, ids[some][other]]), np.concatenate([held_s, got[other]])
            top = np.lexsort((held_i, -held_s))[:k]
            held_i, held_s = held_i[top], held_s[top]
            if rest is None:  # the first reads give a threshold
                rest = np.nonzero(mine >= (held_s[-1] if len(held_s) == k else -np.inf))[0]
                rest = rest[~np.isin(rest, first)]
                order = rest[np.argsort(-mine[rest])]
            elif len(held_s) == k and len(order) and mine[order[0]] < held_s[-1]:
                break
        yield place, held_i, held_s


def pack(df: DataFrame, id: str, vector: str, scale: int, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length, numbered by partition and place."""
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.spark_partition_id().cast("long").alias("p"))

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        made = 0

        def block(dim: int, home: int) -> dict:
            ids, values = (np.concatenate([x[i] for x in held[dim]]) for i in (0, 1))
            held[dim] = [(ids[size:], values[size:])]
            ids, values = ids[:size], values[:size]
            low, high = values.min(axis=0, initial=np.inf), values.max(axis=0, initial=-np.inf)
            step = np.maximum(1.0, np.floor((high - low) / CELLS) + 1)
            cells = np.minimum(CELLS - 1, (values - low) // step).astype(np.uint8)
            # A cell is bounded by the values found in it, so that no rounding of its edges matters.
            lowest, highest = np.full((len(low), CELLS), np.inf), np.full((len(low), CELLS), -np.inf)
            for c in range(CELLS):
                inside = cells == c
                lowest[:, c] = np.where(inside, values, np.inf).min(axis=0)
                highest[:, c] = np.where(inside, values, -np.inf).max(axis=0)
            blobs = (ids, values, cells, lowest, highest)
            return dict(zip(("block", "dim", "n", "ids", "exact", "cells", "low", "high"), (home << 32 | made, dim, len(ids), *(x.tobytes() for x in blobs))))

        def out(found: dict) -> pa.RecordBatch:
            nonlocal made
            made += 1
            kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(found.values(), kinds)], names=list(found))

        home = 0
        for part in parts:
            if not len(part):
                continue
            home, ids = part.column(2)[0].as_py(), part.column(0)
            for dim, (places, values) in whole(part.column(1), scale).items():
                taken = ids.take(pa.array(places))
                known = taken.is_valid().to_numpy(zero_copy_only=False)
                held.setdefault(dim, []).append((taken.drop_null().to_numpy(), values[known]))
                while sum(len(x[0]) for x in held[dim]) >= size:
                    yield out(block(dim, home))
        for dim in held:
            if sum(len(x[0]) for x in held[dim]):
                yield out(block(dim, home))

    return rows.mapInArrow(run, BLOCKS)


def unpack(row: dict, *names: str) -> list[np.ndarray]:
    kinds = {"ids": np.int64, "cells": np.uint8}
    shape = {"ids": (-1,), "exact": (row["n"], row["dim"]), "cells": (row["n"], row["dim"]), "low": (row["dim"], CELLS), "high": (row["dim"], CELLS)}
    return [np.frombuffer(row[name], dtype=kinds.get(name, np.float64)).reshape(shape[name]) for name in names]


class Asked:
    """Queries of one length, whose blocks may be of any size, and the best found for them so far."""

    def __init__(self):
        self.blocks: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.pieces: list[tuple[np.ndarray, ...]] = []
        self.held: list[list[tuple[np.ndarray, np.ndarray]]] = []

    def cut(self) -> None:
        """The blocks as pieces of ``QUERIES``, each (block, place, id, vector) of its queries."""
        blocks, self.blocks = self.blocks, []
        columns = (np.repeat([b for b, _, _ in blocks], [len(ids) for _, ids, _ in blocks]), np.concatenate([np.arange(len(ids), dtype=np.int32) for _, ids, _ in blocks]), *(np.concatenate([x[i] for x in blocks]) for i in (1, 2)))
        self.pieces = [tuple(c[at : at + QUERIES] for c in columns) for at in range(0, len(columns[0]), QUERIES)]
        self.held = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(piece[0]) for piece in self.pieces]

    def offer(self, row: dict, k: int) -> None:
        """A candidate block."""
        if self.blocks:
            self.cut()
        ids, exact, cells, low, high = unpack(row, "ids", "exact", "cells", "low", "high")
        dims = np.arange(row["dim"])
        lower, upper = low[dims, cells], high[dims, cells]
        for (_, _, query_ids, queries), held in zip(self.pieces, self.held):
            for place, found_i, found_s in better(query_ids, queries, ids, exact, lower, upper, k, held):
                held[place] = found_i, found_s

    def found(self) -> Iterator[pa.RecordBatch]:
        for (blocks, places, query_ids, _), held in zip(self.pieces, self.held):
            rows = np.repeat(np.arange(len(held)), [len(ids) for ids, _ in held])
            columns = (blocks[rows], places[rows], query_ids[rows], *(np.concatenate([x[i] for x in held]) for i in (0, 1)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["block", "place", "query_id", "vec_id", "score"])


def _search(parts: Iterable[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Cells of the grid, one after the other: first the query blocks of a cell, then its candidate blocks."""
    now, asked = None, {}
    for part in parts:
        for at in range(len(part)):
            row = {name: part.column(name)[at].as_py() for name in ("cell", "candidates", "block", "dim", "n")}
            row |= {name: part.column(name)[at].as_buffer() for name in ("ids", "exact", "cells", "low", "high")}
            if now != (now := row["cell"]):
                yield from (batch for mine in asked.values() for batch in mine.found())
                asked = {}
            if row["candidates"]:
                if row["dim"] in asked:
                    asked[row["dim"]].offer(row, k)
            else:  # copied, as a batch would stay as long as its queries
                asked.setdefault(row["dim"], Asked()).blocks.append((row["block"], *(x.copy() for x in unpack(row, "ids", "exact"))))
    yield from (batch for mine in asked.values() for batch in mine.found())


def grid(candidates: int, sent: int, asked: int, held: int, tasks: int) -> tuple[int, int]:
    """How many buckets of ``candidates`` blocks of ``sent`` bytes in all, and groups of ``asked`` query blocks of ``held`` bytes in all.

    There are as many groups as keep one within ``HELD``, and a cell for each task where there are blocks enough. Queries are sent once
    per bucket and candidates once per group, so buckets outnumber groups as their bytes do those of queries.
    """
    least = max(1, -(-held // HELD))
    buckets = max(1, min(candidates, -(-tasks // least), round((tasks * sent / max(1, held)) ** 0.5)))
    return buckets, max(least, min(asked, -(-tasks // buckets)))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 5, id: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` its k best rows of ``candidates``, by inner product of floor(scale * x).

    Rows that bear the query's own ``id`` are no candidates for it. Ties go to the smaller id. Fewer than k candidates give
    fewer rows, none gives none. Vectors null, or holding a null or non-finite component, and rows without an id take no
    part; vectors are compared with those of their length only. Repeated rows are candidates each, and queries each.
    Scores beyond a long are held at its ends.
    """
    blocks = materialise(pack(candidates, id, vector, scale, BLOCK), "vectors")
    asked = materialise(pack(queries, id, vector, scale, QUERIES), "queries")
    home = F.shiftright("block", 32)
    counts = (F.count(F.lit(1)).alias("n"), (F.coalesce(F.max(home), F.lit(0)) + 1).alias("homes"), F.coalesce(F.sum(F.col("n").cast("long") * F.col("dim") * 8), F.lit(0)).alias("bytes"))
    of_blocks, of_asked = blocks.agg(*counts).first(), asked.agg(*counts).first()
    # Any grid gives the same result.
    buckets, groups = grid(of_blocks["n"], of_blocks["bytes"], of_asked["n"], of_asked["bytes"], 2 * blocks.sparkSession.sparkContext.defaultParallelism)

    def placed(df: DataFrame, homes: int, n: int, others: int, cell, is_candidates: bool) -> DataFrame:
        # Blocks are numbered by place within their homes; counted through over all homes, neighbours go to different shares.
        mine = F.pmod(home + F.col("block").bitwiseAND((1 << 32) - 1) * homes, F.lit(n))
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(others - 1).cast("long")))
        return df.select("*", mine.alias("mine"), each.alias("other")).select(cell.alias("cell"), F.lit(is_candidates).alias("candidates"), *df.columns)

    sent = placed(asked.withColumns({c: F.lit(b"") for c in ("cells", "low", "high")}), of_asked["homes"], groups, buckets, F.col("other") * groups + F.col("mine"), False)
    dealt = placed(blocks, of_blocks["homes"], buckets, groups, F.col("mine") * groups + F.col("other"), True)
    cells = sent.unionByName(dealt).repartitionById(buckets * groups, F.col("cell").cast("int")).sortWithinPartitions("cell", "candidates")
    found = cells.mapInArrow(lambda parts: _search(parts, k), "block long, place int, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("block", "place").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
