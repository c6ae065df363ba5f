"""Byte-level BPE as a finite-state transducer.

The merges are compiled into a transducer that reads bytes and emits token ids.
Its non-deterministic form is simple: after some bytes, a hypothesis is a
sequence of whole tokens and a place in the vocabulary's trie for the token
being read; a token may follow another only if encoding the two together gives
back the two (all neighbours of a BPE encoding have that property, and a
sequence whose neighbours all have it is the encoding). The deterministic form
is built while reading: a state is the set of hypotheses still possible, less
the tokens they agree on, which the arc into the state emits. Hypotheses die
within the longest token, so the lookahead is bounded, and a piece of any
length is read in one pass.

Short pieces, nearly all there are, need not owe anything while they are read:
an arc gives the token that ends at its byte, of which there is one, as what is
read so far has one encoding. The way back over these tokens from the last byte
is the encoding. Without what is owed, states are the token before and the
place in the trie only, so few of them serve very many pieces: every piece is
read through determinised arcs, and one in seven or fewer of them is new.

Decoding is a state machine over tokens: its state is the unfinished UTF-8
character (at most three bytes), so a text can be decoded token by token.

States, arcs, pair checks and memoised pieces are dropped when a bound on their
number is reached and built again when needed; results do not depend on it.
"""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .common import batches, outside

#: Bounds on what a worker remembers.
MAX_STATES = 250_000
MAX_PAIRS = 300_000
MAX_PIECES = 300_000
MAX_PIECE_BYTES = 64


def read_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: a token in base64, a space and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def merged(ranks: dict[bytes, int], piece: bytes) -> list[bytes]:
    """The definition: merge the leftmost pair of lowest rank until none is left. Used for single tokens only."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best, place = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if best == 1 << 60:
            break
        parts[place : place + 2] = [parts[place] + parts[place + 1]]
    return parts


#: Stands for the token before the first.
FIRST = (1 << 31) - 1


class State(dict):
    """Arcs by byte: (next state, ids emitted). ``last``: the ids still owed if the piece ends here."""

    __slots__ = ("hypotheses", "last")

    def __init__(self, hypotheses: tuple):
        self.hypotheses = hypotheses
        # One hypothesis stands between two tokens: its tokens are the encoding so far.
        self.last = next((owed for owed, _, node in hypotheses if node == 0), ())


class Place(dict):
    """A state for short pieces: arcs by byte, (next state, token that ends there). ``alive``: token before << 32 | node of the trie."""

    __slots__ = ("alive",)

    def __init__(self, alive: tuple[int, ...]):
        self.alive = alive


class Pieces(dict):
    """Packed ids (four bytes each) by piece; a piece that is not there is encoded, and remembered if it is short."""

    __slots__ = ("machine",)

    def __missing__(self, piece: str) -> bytes:
        return self.machine.remember(piece)


class Transducer:
    """``encode(piece)`` gives the ids of one piece."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        # The trie: step[node << 8 | byte], token[node], whether node has children; node 0 is the root.
        self.step: dict[int, int] = {}
        self.token: list[int | None] = [None]
        self.inner: list[bool] = [True]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                after = self.step.get(node << 8 | byte)
                if after is None:
                    after = self.step[node << 8 | byte] = len(self.token)
                    self.inner[node] = True
                    self.token.append(None)
                    self.inner.append(False)
                node = after
            self.token[node] = rank
        # By before << 32 | token.
        self.pairs: dict[int, bool] = {}
        self.made: dict[int, tuple[int, ...] | None] = {}
        self.pieces, self.older = Pieces(), dict[str, bytes]()
        self.pieces.machine = self
        self.states: dict[tuple, State] = {}
        self.start = State((((), FIRST, 0),))
        self.arcs_read = self.arcs_made = 0
        self._forget()

    def _forget(self) -> None:
        self.places: dict[tuple[int, ...], Place] = {}
        self.first = Place((FIRST << 32,))

    def _halves(self, token: int) -> tuple[int, ...] | None:
        """The ranks of the two parts whose merge made a token; None for a single byte."""
        if token not in self.made:
            whole = self.bytes[token]
            parts = merged({t: r for t, r in self._within(whole) if t != whole}, whole) if len(whole) > 1 else None
            self.made[token] = parts and tuple(self.ranks[part] for part in parts)
        return self.made[token]

    def _within(self, whole: bytes) -> Iterator[tuple[bytes, int]]:
        for i in range(len(whole)):
            for j in range(i + 2, len(whole) + 1):
                rank = self.ranks.get(whole[i:j])
                if rank is not None:
                    yield whole[i:j], rank

    def _follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may come after ``before`` (or first) in an encoding."""
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        if before == FIRST:
            known = self._halves(token) is None or len(self._halves(token)) == 2
        else:
            known = self._stay_apart(before, token)
        self.pairs[before << 32 | token] = known
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        """Whether two neighbouring tokens stay two.

        Undo the merges of both that touch the border, latest first. The two parts that meet there must never
        have been the next pair to merge: their merge, if any, ranks after the one that took a part away (of
        equal ranks, the left pair goes first).
        """
        ranks, spelled, made, taken = self.ranks, self.bytes, self.made, 1 << 60
        parts_l, parts_r = self._halves(left), self._halves(right)
        while True:
            joint = ranks.get(spelled[left] + spelled[right])
            if joint is not None and joint < taken:
                return False
            if parts_r is None or (parts_l is not None and left > right):
                if parts_l is None:
                    return True
                taken, left = left, parts_l[1]
                parts_l = made[left] if left in made else self._halves(left)
            else:
                taken, right = right + 1, parts_r[0]
                parts_r = made[right] if right in made else self._halves(right)

    def _arc(self, state: State, byte: int) -> tuple[State, tuple[int, ...]]:
        """Determinise one step: move every hypothesis, finish tokens, emit what all agree on."""
        after, step, pairs = [], self.step, self.pairs
        for owed, before, node in state.hypotheses:
            node = step.get(node << 8 | byte)
            if node is None:
                continue
            if self.inner[node]:
                after.append((owed, before, node))
            token = self.token[node]
            if token is not None:
                follows = pairs.get(before << 32 | token)
                if self._follows(before, token) if follows is None else follows:
                    after.append(((*owed, token), token, 0))
        emitted = after[0][0]
        if emitted:
            same = 0
            while same < len(emitted) and all(len(owed) > same and owed[same] == emitted[same] for owed, _, _ in after):
                same += 1
            emitted = emitted[:same]
            if same:
                after = [(owed[same:], before, node) for owed, before, node in after]
        key = tuple(after)
        found = self.states.get(key)
        if found is None:
            found = State(key)
            # Beyond the bound, further states live only as long as the piece.
            if len(self.states) < MAX_STATES:
                self.states[key] = found
        arc = (found, emitted)
        if len(self.states) < MAX_STATES:
            state[byte] = arc
        return arc

    def _step(self, place: Place, byte: int) -> tuple[Place, int]:
        """Determinise one step of a short piece: move every hypothesis; the token that ends here begins a further one."""
        after, ends, pairs, step, inner, token_at = [], -1, self.pairs, self.step, self.inner, self.token
        for alive in place.alive:
            node = step.get((alive & 0xFFFFFFFF) << 8 | byte)
            if node is None:
                continue
            if inner[node]:
                after.append(alive >> 32 << 32 | node)
            token = token_at[node]
            if token is not None and ends < 0:
                pair = alive >> 32 << 32 | token
                follows = pairs.get(pair)
                if self._follows(alive >> 32, token) if follows is None else follows:
                    ends = token
        after.append(ends << 32)
        key = tuple(after)
        found = self.places.get(key)
        if found is None:
            if len(self.places) >= MAX_STATES:
                self._forget()  # what the piece holds is enough to go on
            found = self.places[key] = Place(key)
        arc = place[byte] = found, ends
        self.arcs_made += 1
        return arc

    def read(self, piece: Iterable[int]) -> Iterator[int]:
        """Ids of a piece of any length, each as soon as its bytes leave no other choice."""
        state = self.start
        for byte in piece:
            arc = state.get(byte)
            state, emitted = arc if type(arc) is tuple else self._arc(state, byte)
            if emitted:
                yield from emitted
        yield from state.last

    def _read_short(self, piece: bytes) -> list[int]:
        """The ids of a short piece: the tokens that end at each byte, and the way back over them."""
        place, ended = self.first, []
        for byte in piece:
            arc = place.get(byte)
            place, token = self._step(place, byte) if arc is None else arc
            ended.append(token)
        self.arcs_read += len(ended)
        out, at, sizes = [], len(ended), self.sizes
        while at:
            token = ended[at - 1]
            out.append(token)
            at -= sizes[token]
        out.reverse()
        return out

    def encode(self, piece: bytes) -> Sequence[int]:
        """The ids of a piece. A piece that is a token as a whole is that token, even where merges do not lead to it."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        return self._read_short(piece) if len(piece) <= MAX_PIECE_BYTES else list(self.read(piece))

    def remember(self, piece: str) -> bytes:
        """The packed ids of a piece. Short pieces are remembered in two generations, each up to a bound."""
        known = self.older.get(piece)
        if known is None:
            known = array("i", self.encode(piece.encode())).tobytes()
        if len(piece) <= MAX_PIECE_BYTES:
            if len(self.pieces) >= MAX_PIECES:
                self.older = dict(self.pieces)
                self.pieces.clear()
            self.pieces[piece] = known
        return known


class Decoder:
    """Tokens to text. A state is the open character's bytes; its arcs give, by token, (text, next state).

    ``feed`` gives the characters that a token completes; a malformed byte becomes U+FFFD.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = tokens
        self.states: dict[bytes, dict[int, tuple[str, dict]]] = {}
        self.whole: dict[int, str] = {}
        self.restart()

    def _state(self, open_bytes: bytes) -> dict:
        state = self.states.get(open_bytes)
        if state is None:
            state = self.states[open_bytes] = {-1: open_bytes}
        return state

    def _arc(self, state: dict, token: int) -> tuple[str, dict]:
        text, rest = complete(state[-1] + self.tokens[token])
        arc = state[token] = (text, self._state(rest))
        if not state[-1] and not rest:
            self.whole[token] = text
        return arc

    def restart(self) -> None:
        self.state = self._state(b"")

    def feed(self, token: int) -> str:
        text, self.state = self.state.get(token) or self._arc(self.state, token)
        return text

    def end(self) -> str:
        rest = self.state[-1]
        self.restart()
        return rest.decode("utf-8", "replace")

    def text(self, tokens: list[int]) -> str:
        """A whole sequence at once; tokens of whole characters need no state."""
        found = list(map(self.whole.get, tokens))
        if None not in found:
            return "".join(found)
        self.restart()
        spelled, state, arc_to = [], self.state, self._arc
        for token in tokens:
            text, state = state.get(token) or arc_to(state, token)
            spelled.append(text)
        self.state = state
        return "".join(spelled) + self.end()


def complete(data: bytes) -> tuple[str, bytes]:
    """The whole characters at the start of ``data``, and the bytes of one that may still be completed."""
    for keep in range(1, min(3, len(data)) + 1):
        byte = data[-keep]
        if byte & 0xC0 != 0x80:  # the last lead byte: is its character still open?
            wants = 4 if 0xF0 <= byte < 0xF5 else 3 if 0xE0 <= byte < 0xF0 else 2 if 0xC2 <= byte < 0xE0 else 1
            if wants > keep and data[-keep:].decode("utf-8", "replace") == "�":
                return data[:-keep].decode("utf-8", "replace"), data[-keep:]
            break
    return data.decode("utf-8", "replace"), b""


#: Letters and spaces among the characters below U+0250, and those of them that a text may hold to be split by these classes alone:
#: no further kinds of spaces and numbers.
LETTERS, SPACES = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "\t-\r "
LATIN = re.compile("[\x00-\x7f¡-±´-¸º»¿-ɏ]*")


class Splitter:
    """``findall`` of a pattern. Texts of Latin characters go through an equal pattern whose classes are spelled out, which takes half the time."""

    def __init__(self, pattern: str):
        self.any = regex.compile(pattern)
        narrow = re.sub(r"\[[^\]]*\]", lambda m: self._spelled(m[0], "{}"), pattern)
        narrow = self._spelled(narrow, "[{}]").replace("\\S", f"[^{SPACES}]")
        # Other escapes and flags may mean different things to the two engines.
        self.latin = None if "\\" in narrow or "(?i" in narrow else re.compile(narrow)

    @staticmethod
    def _spelled(part: str, form: str) -> str:
        for name, characters in (("\\p{L}", LETTERS), ("\\p{N}", "0-9"), ("\\s", SPACES)):
            part = part.replace(name, form.format(characters))
        return part

    def findall(self, text: str) -> list[str]:
        plain = self.latin and (text.isascii() or LATIN.fullmatch(text))
        return (self.latin if plain else self.any).findall(text)


_MACHINES: dict[str, tuple[Transducer, Decoder]] = {}


def machines(data: bytes) -> tuple[Transducer, Decoder]:
    """The two machines of a rank file, compiled once per worker."""
    name = hashlib.sha256(data).hexdigest()
    if name not in _MACHINES:
        _MACHINES.clear()
        ranks = read_ranks(data)
        _MACHINES[name] = Transducer(ranks), Decoder({rank: token for token, rank in ranks.items()})
    return _MACHINES[name]


def encode_text(machine: Transducer, split: Splitter, text: str | None) -> np.ndarray:
    return np.frombuffer(b"".join(map(machine.pieces.__getitem__, split.findall(text or ""))), dtype=np.int32)


def lists(rows: list[np.ndarray]) -> pa.ListArray:
    """Arrays of ids as one Arrow column."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate([np.zeros(0, np.int32), *rows])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def unlisted(column: pa.ListArray) -> Iterator[np.ndarray]:
    """The ids of each row; none for a null row. A null id becomes -1, which no vocabulary has."""
    flat, ends = column.values.fill_null(-1).to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for row, there in enumerate(column.is_valid().to_numpy(zero_copy_only=False)):
        yield flat[ends[row] : ends[row + 1]] if there else flat[:0]


def vocabulary(spark: SparkSession, path: str):
    """A rank file as a broadcast (about a megabyte, whatever the input)."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Replace ``text`` by ``ids`` (array<int>): the BPE of each match of ``pattern``, without special tokens.

    ``path``: a rank file the driver can read. A null text counts as empty and has no ids. All other columns
    stay, except one named like ``ids``. Rows are independent: no shuffle, and repeated rows stay repeated.
    """
    data = vocabulary(df.sparkSession, path)
    kept = [c for c in outside(df, [ids]) if c != text]
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, split = machines(data.value)[0], Splitter(pattern)
        for part in parts:
            texts, others = part.column(len(kept)), [part.column(i) for i in range(len(kept))]
            done = 0
            for some in batches(texts, lambda x: len(x.as_py() or "")):
                found = lists([encode_text(machine, split, x.as_py()) for x in some])
                yield pa.RecordBatch.from_arrays([*(c.slice(done, len(some)) for c in others), found], names=[*kept, ids])
                done += len(some)

    return df.select(*kept, F.col(text).cast("string").alias("_text")).mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``: the characters the ids spell, through the incremental state machine.

    Null ids give an empty text, and so do no ids. Bytes that are not UTF-8 become U+FFFD. An id outside the
    vocabulary (or null) fails the task with a ``KeyError``: it cannot be decoded without loss.
    """
    data = vocabulary(df.sparkSession, path)
    kept = outside(df, [text])
    place = kept.index(ids)
    schema = T.StructType([df.schema[c] for c in kept] + [T.StructField(text, T.StringType(), False)])

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = machines(data.value)[1]
        for part in parts:
            done = 0
            for some in batches(unlisted(part.column(place)), lambda x: 4 * len(x)):
                texts = pa.array([machine.text(x.tolist()) for x in some], pa.string())
                columns = [c.slice(done, len(some)) for c in part.columns]
                yield pa.RecordBatch.from_arrays([*columns, texts], names=[*kept, text])
                done += len(some)

    return df.select(*kept).mapInArrow(run, schema)
