"""Repair of conversations at least cost, and of all cheapest repairs the one whose audit comes first.

An audit is a string of one letter per edit: D(elete), I(nsert), K(eep),
R(erole). Rows of a conversation and the places its pattern of roles can be in
make a graph: a node is (rows read, place in the pattern), an arc is an edit. A
cost pass from the end gives each node the cost of finishing from there; arcs
that lie on a cheapest way stay. Among these the least audit is found by prefix
doubling: nodes are ranked by their least audit of one letter, then of two, four
and so on, each time by the pair (own rank, best rank among the nodes reached),
until every audit has ended. Ranks choose the first arc of each node, and
doubled pointers over these arcs give the nodes of a path all at once.

Texts do not wait for this. A task reads each conversation twice in one sorted
stream: first its rows without texts (two bytes are kept of each, and a digest to
know repeats), then, with the audit known, its rows with texts, which are passed
on as they come. Several short conversations are ranked together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import batches

BLANKS = " \t\n\x0b\x0c\r"
DELETE, INSERT, KEEP, REROLE = (ord(letter) for letter in "DIKR")
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
#: What an undeleted truncated row adds.
UNFINISHED = 5

# Places in the pattern (s?(ua)+)?: nothing yet, behind s, behind u, behind a. Ends are good at the first and the last.
PLACES, ENDS = 4, (0, 3)
FAR = 1 << 60
#: The place that an inserted or reroled row leads to, and that a kept row of role other, s, u, a leads to (-1: none).
NEXT = np.array([2, 2, 3, 2])
STAY = np.array([[-1] * 4, [1, -1, -1, -1], [2, 2, -1, 2], [-1, -1, 3, -1]])
ROLE_AT = {2: "user", 3: "assistant"}
CODES = {"s": 1, "u": 2, "a": 3}

SOUND, UNFIT, TRUNCATED = 0, 1, 2
#: Rows ranked at a time, and bytes of texts that wait for it.
ROWS, BYTES = 20_000, 8 << 20

SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
STEPS = "conv_id long, step long, edit string, turn long, role string, text string, " + ", ".join(f"{name} long" for name in SUMMARY) + ", audit string"


def cost_to_go(roles: np.ndarray, faults: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least cost of finishing from each node, and where each conversation's nodes begin; (rows + 1) x ``PLACES`` nodes each."""
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    first = np.concatenate([[0], np.cumsum(sizes)])
    cost = np.full((base[-1], PLACES), FAR, np.int64)
    by_size = np.argsort(-sizes, kind="stable")
    for t in range(int(sizes.max(initial=0)), -1, -1):
        some = by_size[: np.searchsorted(-sizes[by_size], -t, side="right")]
        here, ended = base[some] + t, sizes[some] == t
        value = np.full((len(some), PLACES), FAR, np.int64)
        value[np.ix_(ended, ENDS)] = 0
        going = ~ended
        if going.any():
            after, row = cost[here[going] + 1], first[some[going]] + t
            value[going] = np.min([after[np.arange(len(row))[:, None], to] + way for _, to, way in _consuming(roles[row], faults[row])], axis=0)
        # Inserts read no row: from place 2 to 3 and back, or on from the start.
        there, back = value[:, 3] + COST[INSERT], value[:, 2] + COST[INSERT]
        value[:, 2], value[:, 3] = np.minimum(value[:, 2], there), np.minimum(value[:, 3], back)
        value[:, :2] = np.minimum(value[:, :2], value[:, 2:3] + COST[INSERT])
        cost[here] = np.minimum(value, FAR)
    return cost, base


def _consuming(roles: np.ndarray, faults: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(edit, place reached, cost), per row and place, of the edits that read a row; a cost of ``FAR`` where the edit is not allowed."""
    held = np.where(faults == UNFIT, FAR, np.where(faults == TRUNCATED, UNFINISHED, 0))[:, None]
    stay = STAY[roles]
    yield KEEP, np.maximum(stay, 0), np.where(stay < 0, FAR, held + COST[KEEP])
    yield REROLE, np.broadcast_to(NEXT, stay.shape), held + COST[REROLE] + np.zeros(stay.shape, np.int64)
    yield DELETE, np.broadcast_to(np.arange(PLACES), stay.shape), np.full(stay.shape, COST[DELETE])


def cheapest_arcs(roles: np.ndarray, faults: np.ndarray, cost: np.ndarray, sizes: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(from, edit, to) of the arcs on cheapest ways; a node's number is its row in ``cost`` times ``PLACES`` plus its place."""
    reads = np.ones(len(cost), bool)
    reads[base[1:] - 1] = False
    at, flat, places = np.nonzero(reads)[0], cost.ravel(), np.arange(PLACES)
    found = []
    for edit, to, way in _consuming(roles, faults):
        found.append((at[:, None] * PLACES + places, edit, (at + 1)[:, None] * PLACES + to, way))
    nodes = np.arange(len(cost))[:, None] * PLACES
    found.append((nodes + places, INSERT, nodes + NEXT, np.full(cost.shape, COST[INSERT])))
    out = []
    for begin, edit, end, way in found:
        best = (flat[begin] < FAR) & (flat[begin] == flat[end] + way)
        out.append((begin[best], np.full(best.sum(), edit), end[best]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _least(owner: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, owner, value)
    return out


def least_ways(n: int, begin: np.ndarray, label: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per node the next node on its least way, and that arc's label; nodes without arcs are ends (themselves, label 0).

    ``rank`` orders nodes by their least string of up to 2**k labels, a string before those it begins; ``owner`` and
    ``reached`` list the nodes that lie behind that string, for it may lead to several. An end reaches itself, rank 0.
    """
    first = _least(begin, label, n)
    ends = np.nonzero(first == np.iinfo(np.int64).max)[0]
    rank = first.copy()
    rank[ends] = 0
    good = label == first[begin]
    begin, label, end = begin[good], label[good], end[good]
    owner, reached = np.concatenate([begin, ends]), np.concatenate([end, ends])
    finished = np.zeros(n, bool)
    finished[ends] = True
    while not finished[reached].all():
        best = _least(owner, rank[reached], n)
        good = rank[reached] == best[owner]
        owner, reached = owner[good], reached[good]
        rank = np.unique(rank * (n + 256) + best, return_inverse=True)[1]
        # Behind the doubled string lie the nodes that the nodes reached reach.
        order = np.argsort(owner, kind="stable")
        owner, reached = owner[order], reached[order]
        where, many = np.searchsorted(owner, reached), np.bincount(owner, minlength=n)[reached]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        pairs = np.unique(np.repeat(owner, many) * n + reached[np.repeat(where, many) + step])
        owner, reached = pairs // n, pairs % n
    target = np.arange(n)
    letter = np.zeros(n, np.int64)
    order = np.lexsort((rank[end], begin))
    chosen = order[np.unique(begin[order], return_index=True)[1]]
    target[begin[chosen]], letter[begin[chosen]] = end[chosen], label[chosen]
    return target, letter


def paths(target: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes on the ways from ``starts``, ends left out, one after the other, and how many each way has."""
    jumps = [target]
    while (jumps[-1][jumps[-1]] != jumps[-1]).any():
        jumps.append(jumps[-1][jumps[-1]])
    length, at = np.zeros(len(starts), np.int64), starts.copy()
    for k in range(len(jumps) - 1, -1, -1):  # the longest jump that does not arrive yet, then the next shorter one
        there = jumps[k][at]
        short = target[there] != there
        length, at = length + np.where(short, 1 << k, 0), np.where(short, there, at)
    length += target[at] != at
    place = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    nodes = np.repeat(starts, length)
    for k, jump in enumerate(jumps):
        nodes = np.where(place >> k & 1, jump[nodes], nodes)
    return nodes, length


@dataclass
class Conversation:
    """What is kept of a conversation: two bytes a row, its digests until repeats are known, and its texts while it waits."""

    id: int | None
    roles: bytearray = field(default_factory=bytearray)
    faults: bytearray = field(default_factory=bytearray)
    seen: set = field(default_factory=set)
    counts: dict = field(default_factory=lambda: dict.fromkeys(SUMMARY, 0))
    low: int | None = None
    high: int | None = None
    turns: int = 0
    texts: list = field(default_factory=list)
    edits: bytes = b""
    places: np.ndarray | None = None

    def add(self, row: dict) -> None:
        code = CODES.get(row["role"][:1], 0)
        if self.roles and (self.roles[-1], code) not in ((1, 2), (2, 3), (3, 2)):
            self.counts["illegal"] += 1
        fault = "blank" if row["blank"] else "duplicate" if row["digest"] in self.seen else "truncated" if row["open"] else None
        self.seen.add(row["digest"])
        if fault:
            self.counts[fault] += 1
        self.roles.append(code)
        self.faults.append(TRUNCATED if fault == "truncated" else UNFIT if fault else SOUND)
        if (turn := row["turn"]) is not None and turn != self.high:  # rows come by turn
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1

    def summary(self) -> dict:
        if self.turns:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        return {"conv_id": self.id, "step": -1, **self.counts, "audit": self.edits.decode()}


def plan(held: list[Conversation]) -> None:
    """Cost, edits and places of the given conversations."""
    sizes = np.array([len(c.roles) for c in held])
    roles, faults = (np.frombuffer(b"".join(bytes(getattr(c, name)) for c in held), np.uint8).astype(np.int64) for name in ("roles", "faults"))
    cost, base = cost_to_go(roles, faults, sizes)
    target, letter = least_ways(cost.size, *cheapest_arcs(roles, faults, cost, sizes, base))
    starts = base[:-1] * PLACES
    nodes, length = paths(target, starts)
    edits, places = letter[nodes].astype(np.uint8).tobytes(), (target[nodes] % PLACES).astype(np.uint8)
    for conversation, begin, size, total in zip(held, np.cumsum(length) - length, length, cost.ravel()[starts]):
        conversation.edits, conversation.places = edits[begin : begin + size], places[begin : begin + size]
        conversation.counts["cost"] = int(total)
        conversation.seen.clear()


class Writer:
    """Steps of one planned conversation, as its rows with texts come."""

    def __init__(self, conversation: Conversation):
        self.of, self.step = conversation, 0

    def _inserts(self) -> Iterator[dict]:
        while self.step < len(self.of.edits) and self.of.edits[self.step] == INSERT:
            yield {"conv_id": self.of.id, "step": self.step, "edit": "I", "role": ROLE_AT[int(self.of.places[self.step])], "text": ""}
            self.step += 1

    def row(self, turn: int | None, role: str, text: str) -> Iterator[dict]:
        yield from self._inserts()
        edit = self.of.edits[self.step]
        if edit == REROLE:
            role = ROLE_AT[int(self.of.places[self.step])]
        gone = edit == DELETE
        yield {"conv_id": self.of.id, "step": self.step, "edit": chr(edit), "turn": turn, "role": None if gone else role, "text": None if gone else text}
        self.step += 1

    def rest(self) -> Iterator[dict]:
        yield from self._inserts()


def _steps(rows: Iterator[dict]) -> Iterator[dict]:
    """Rows sorted by conversation, phase and place to the steps of each conversation, its summary first.

    Conversations wait until ``ROWS`` rows or ``BYTES`` of texts have come, the last one maybe in part: what follows of it
    is passed on at once.
    """
    waiting: list[Conversation] = []
    n_rows = n_bytes = 0
    writer: Writer | None = None

    def finish(goes_on: bool) -> Iterator[dict]:
        nonlocal n_rows, n_bytes, writer
        plan(waiting)
        for conversation in waiting:
            yield conversation.summary()
            writer = Writer(conversation)
            for said in conversation.texts:
                yield from writer.row(*said)
            conversation.texts.clear()
            if not goes_on or conversation is not waiting[-1]:
                yield from writer.rest()
                writer = None
        waiting.clear()
        n_rows = n_bytes = 0

    current: Conversation | None = None
    for row in rows:
        if current is None or row["conv_id"] != current.id:
            if writer is not None:
                yield from writer.rest()
                writer = None
            elif n_rows >= ROWS:
                yield from finish(False)
            current = Conversation(row["conv_id"])
            waiting.append(current)
        if row["lost"]:
            continue
        if row["phase"] == 0:
            current.add(row)
            n_rows += 1
        elif writer is not None:
            yield from writer.row(row["turn"], row["role"], row["text"])
        else:
            current.texts.append((row["turn"], row["role"], row["text"]))
            n_bytes += len(row["text"])
            if n_bytes >= BYTES:
                yield from finish(True)
    if writer is not None:
        yield from writer.rest()
    elif waiting:
        yield from finish(False)


def _output(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for some in batches(rows, lambda row: len(row.get("text") or "")):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in ddl.split(", "))])


def _filled(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, lost): conversations with faults, by crc32 of ``conv_id:turn`` modulo 20.

    0 loses the row (marked ``lost``, so that a conversation without rows is still known), 1 empties the text, 2 takes its ``.!?``,
    3 repeats the row, 4 makes the role ``user``. Nulls are one space: in the key, as role and as text; a null turn stays null.
    """
    what = F.pmod(F.crc32(F.concat(_filled("conv_id"), F.lit(":"), _filled("turn")).cast("binary")), F.lit(20))
    read = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _filled("role").alias("role"), _filled("text").alias("text"), what.alias("_what"))
    changed = read.select(
        "conv_id", "turn", F.when(F.col("_what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_what") == 1, "").when(F.col("_what") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("_what") == 0).alias("lost"), F.explode(F.array_repeat(F.lit(0), F.when(F.col("_what") == 3, 2).otherwise(1))).alias("_copy"),
    )
    return changed.drop("_copy")


def repair(rows: DataFrame) -> DataFrame:
    r"""``STEPS`` of the cheapest repair of each conversation in (conv_id, turn, role, text), and maybe ``lost``; other columns are left out.

    Rows are taken by turn, nulls first, then by role and text. A row's fault is the first that holds: blank (only space and
    ``\t\n\v\f\r``), duplicate (role and text as in an earlier row), truncated (the last other character is none of ``.!?``).
    Edits: keep (0), rerole to user or assistant (1), delete (2, the only edit of blank and duplicate rows), insert an empty row of user or
    assistant (5); an undeleted truncated row adds 5. The roles' initials must come out as ``(s?(ua)+)?``; of the cheapest audits
    the ASCII-least is taken. Roles with other initials, and empty roles, must be reroled or deleted.

    Each conversation gives a row of step -1 with the audit, its cost and counts, then one row per edit, deleted ones without role and
    text. These rows come together, in order, within one partition. Null roles and texts are one space. A null conv_id is a
    conversation, and all its rows are one. One whose rows are all ``lost`` gives a row of zeros; an empty table gives no rows.
    A conversation's audit is one value, so a task's memory grows with the rows of the longest conversation, not with their texts.
    """
    lost = F.coalesce(F.col("lost"), F.lit(False)) if "lost" in rows.columns else F.lit(False)
    read = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _filled("role").alias("role"), _filled("text").alias("text"), lost.alias("lost"))
    end = F.rtrim(F.col("text"), F.lit(BLANKS))
    digest = F.unhex(F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary")))
    null = F.lit(None)
    without = F.struct(F.lit(0).alias("phase"), null.cast("string").alias("text"), (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("open"), digest.alias("digest"))
    texts = F.struct(F.lit(1).alias("phase"), F.col("text").alias("text"), null.cast("boolean").alias("blank"), null.cast("boolean").alias("open"), null.cast("binary").alias("digest"))
    numbered = read.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")))
    twice = numbered.select("conv_id", "place", "turn", "role", "lost", F.inline(F.when(F.col("lost"), F.array(without)).otherwise(F.array(without, texts))))
    ordered = twice.sortWithinPartitions(F.asc_nulls_first("conv_id"), "phase", "place")

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _output(_steps(row for part in parts for row in part.to_pylist()), _schema(STEPS))

    return ordered.mapInArrow(run, STEPS)


def digests(steps: DataFrame) -> DataFrame:
    """Per conversation its summary and the SHA-256 of its repaired rows as ``role:text``, joined by line feeds; ``steps`` straight from ``repair``."""
    ddl = "conv_id long, " + ", ".join(f"{name} long" for name in SUMMARY) + ", audit string, repaired_sha256 string"

    def hashed(rows: Iterator[dict]) -> Iterator[dict]:
        now, digest, lines = None, hashlib.sha256(), 0
        for row in rows:
            if row["step"] < 0:
                if now is not None:
                    yield now | {"repaired_sha256": digest.hexdigest()}
                now, digest, lines = {name: row[name] for name in ("conv_id", *SUMMARY, "audit")}, hashlib.sha256(), 0
            elif row["text"] is not None:
                digest.update(f"{chr(10) if lines else ''}{row['role']}:{row['text']}".encode())
                lines += 1
        if now is not None:
            yield now | {"repaired_sha256": digest.hexdigest()}

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _output(hashed(row for part in parts for row in part.to_pylist()), _schema(ddl))

    return steps.mapInArrow(run, ddl)
