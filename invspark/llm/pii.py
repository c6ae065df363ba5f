"""Personal data replaced by surrogates.

Entities are found by pattern: e-mail addresses, IP addresses, telephone, card
and social security numbers, and names behind a form of address. A surrogate is
a keyed function of the entity alone, so it is the same in every document and
on every run. Numbers and addresses go through keyed permutations of all values
of their form (same length, script, case and separators; card numbers keep
whether their check digit holds, IP addresses their kind of network, e-mail
addresses of one domain share one). Names are built of syllables in the
script of the original, with endings by gender; each part of a name has its own
surrogate, so a later mention by surname alone stays the same person.

Two entities must not share a surrogate, and none may be a real entity of the
corpus. Both are checked over all distinct entities with joins; losers draw
again (``attempt``) until there are none. The few that drew again reach the
texts they occur in by a join on the text's hash; all others need none.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import batches, materialise
from .feistel import Permutation

EMAIL = re.compile(r"(?<![\w.%+-])[\w.%+-]+@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}")
NUMBER = re.compile(
    r"""(?P<ip>(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?!\w|\.\d))
      | (?P<phone>(?<![\w+])\+1[\ .-]?\(?\d{3}\)?[\ .-]?\d{3}[\ .-]?\d{4}(?!\w)
          | (?<![\w+])\+\d{1,3}[\ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[\ .-]?\d{2,4}){1,4}(?!\w)
          | (?<!\w)\(\d{3}\)\ ?\d{3}[\ .-]\d{4}(?!\w)
          | (?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]|\.\d))
      | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
      | (?P<card>(?<![\w.-])\d(?:[\ -]?\d){12,18}(?![\w-]|\.\d))""",
    re.VERBOSE | re.ASCII,
)
DIGIT = re.compile("[0-9]")
#: Forms of address, and the gender they tell.
ADDRESS = {
    "Mr": "m", "Mister": "m", "Herr": "m", "Monsieur": "m", "Señor": "m", "Sr": "m", "господин": "m", "Господин": "m",
    "Mrs": "f", "Ms": "f", "Miss": "f", "Frau": "f", "Madame": "f", "Mme": "f", "Señora": "f", "Sra": "f", "госпожа": "f", "Госпожа": "f",
}
#: A form of address and titles behind it; a name begins there.
NAME = re.compile(rf"\b({'|'.join(sorted(ADDRESS, key=len, reverse=True))})\b\.?[  ]+(?:(?:Dr|Prof|Professor|Doctor|Doktor)\b\.?[  ]+)*")
#: Initials with their stops, or a word with inner apostrophes and hyphens (a possessive or contracted ending is none).
WORD = re.compile(r"(?:[^\W\d_]\.-?)+(?<!-)(?!\w)|[^\W\d_]+(?:['’-](?!(?i:s|ll|d|ve|re|m|t)\b)[^\W\d_]+)*")
GAP = re.compile("[  ]+")
#: Stand between the words of a name and stay.
PARTICLES = frozenset("af al av bin da das de del della den der di do dos du e el ibn la las le los ten ter van vom von y zu zum zur".split())
#: Character classes: a character is replaced by one of its own class.
RANGES = (
    ("0", "9"), ("a", "z"), ("A", "Z"), ("ß", "ö"), ("ø", "ÿ"), ("À", "Ö"), ("Ø", "Þ"), ("Ā", "ſ"),
    ("α", "ω"), ("Α", "Ω"), ("а", "я"), ("А", "Я"), ("א", "ת"), ("ء", "غ"), ("ぁ", "ゖ"), ("ァ", "ヺ"),
    ("가", "힣"), ("一", "鿿"),
)
SPANS = [(ord(a), ord(b) - ord(a) + 1) for a, b in RANGES]
#: By script: onsets, vowels, and the endings of given names (by gender) and surnames.
SYLLABLES = {
    "LATIN": ("b c d f g h j k l m n p r s t v".split(), "a e i o u".split(), {"f": ["a", "ia", "ette"], "m": ["n", "r", "s"], "": ["son", "man", "er"]}),
    "CYRILLIC": ("б в г д ж з к л м н п р с т".split(), "а е и о у".split(), {"f": ["а", "ия"], "m": ["н", "р"], "": ["ов", "ин"]}),
    "GREEK": ("β γ δ θ κ λ μ ν π ρ σ τ".split(), "α ε ι ο υ".split(), {"f": ["α", "ια"], "m": ["ος", "ης"], "": ["ου", "ακης"]}),
}


class Entity(NamedTuple):
    start: int
    end: int
    kind: str
    value: str


def _given(word: str) -> bool:
    return unicodedata.category(word[0]) == "Lo" or any(part[:1].isupper() for part in re.split("['’-]", word))


def _name_words(text: str, at: int) -> list[tuple[int, str]]:
    """The words of a name that begins at ``at``: all that are capitalised, and initials; of a script without case, two."""
    words: list[tuple[int, str]] = []
    while m := WORD.match(text, at):
        word = m[0]
        if word not in PARTICLES:
            if word in ADDRESS or not _given(word) or len(words) == 2 and unicodedata.category(word[0]) == "Lo":
                break
            words.append((m.start(), word))
        gap = GAP.match(text, m.end())
        if not gap:
            break
        at = gap.end()
    # "Mr Smith I": a bare letter ends no name.
    while len(words) > 1 and len(words[-1][1]) == 1 and unicodedata.category(words[-1][1]) != "Lo":
        words.pop()
    return words


def detect(text: str | None) -> list[Entity]:
    """Entities in order, not overlapping; of two that overlap the one that starts first, e-mail addresses before numbers before names."""
    text, found = text or "", []
    if "@" in text:
        for m in EMAIL.finditer(text):
            found.append(Entity(m.start(), m.end(), "email", m[0]))
    for m in NUMBER.finditer(text) if DIGIT.search(text) else ():
        kind = m.lastgroup
        if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
            continue
        found.append(Entity(m.start(), m.end(), kind, m[0]))
    names: dict[str, str] = {}
    for m in NAME.finditer(text) if any(word in text for word in ADDRESS) else ():
        gender, words = ADDRESS[m[1]], _name_words(text, m.end())
        # The surname is the last word that is no initial.
        last = max((place for place, (_, word) in enumerate(words) if not word.endswith(".")), default=len(words) - 1)
        for place, (start, word) in enumerate(words):
            kind = "surname" if place == last else f"given_{gender}"
            names.setdefault(word, kind)
            found.append(Entity(start, start + len(word), names[word], word))
    # Single letters and initials stand for too much else.
    telling = {w: k for w, k in names.items() if len(w) > 1 and not w.endswith(".")}
    surnames = [w for w, k in telling.items() if k == "surname"]
    if surnames:
        # Later mentions of a surname, or of given names and surname, are the same person.
        known = {(e.start, e.end) for e in found}
        given = [w for w, k in telling.items() if k != "surname"]
        last = "|".join(map(re.escape, sorted(surnames, key=len, reverse=True)))
        first = "|".join(map(re.escape, sorted(given, key=len, reverse=True)))
        mentions = [rf"\b(?:{last})\b"]
        if first:
            mentions.append(rf"\b(?:{first})\b(?=[  ]+(?:(?:{first}|{'|'.join(sorted(PARTICLES))}|[^\W\d_]\.?)[  ]+)*(?:{last})\b)")
        for mention in mentions:
            for m in re.finditer(mention, text):
                if m.span() not in known:
                    found.append(Entity(m.start(), m.end(), names[m[0]], m[0]))
    order = {"email": 0, "ip": 1, "phone": 1, "ssn": 1, "card": 1}
    found.sort(key=lambda e: (e.start, order.get(e.kind, 2), -e.end))
    out, end = [], 0
    for e in found:
        if e.start >= end:
            out.append(e)
            end = e.end
    return out


class Surrogates:
    """``of(kind, value, attempt)``: keyed, of the same kind and form."""

    def __init__(self, key: bytes):
        self.key = key
        self._permutation = lru_cache(4096)(lambda tweak, size: Permutation(key, tweak.encode(), size))
        self.of = lru_cache(100_000)(self._of)

    def _spread(self, text: str, tweak: str) -> str:
        """Permute all strings of the form of ``text`` (its characters' classes)."""
        places, number, size = [], 0, 1
        for place, c in enumerate(text):
            for low, n in SPANS:
                if low <= ord(c) < low + n:
                    places.append((place, low, n))
                    number, size = number * n + ord(c) - low, size * n
                    break
        out, number = list(text), self._permutation(f"{tweak}/{[n for _, _, n in places]}", size)(number)
        for place, low, n in reversed(places):
            number, digit = divmod(number, n)
            out[place] = chr(low + digit)
        return "".join(out)

    def _digits(self, digits: str, tweak: str) -> str:
        moved = self._permutation(f"{tweak}/{len(digits)}", 10 ** len(digits))(int(digits or 0))
        return str(moved).zfill(len(digits)) if digits else ""

    def _of(self, kind: str, value: str, attempt: int = 0) -> str:
        return getattr(self, "_" + kind.partition("_")[0])(value, f"{kind}/{attempt}", kind)

    def _email(self, value: str, tweak: str, _: str) -> str:
        local, _, domain = value.rpartition("@")
        name, _, top = domain.rpartition(".")
        return f"{self._spread(local, f'{tweak}/{domain}')}@{self._spread(name, f'domain/{top}')}.{top}"

    def _refill(self, form: str, digits: str) -> str:
        given = iter(digits)
        return "".join(next(given) if c.isdigit() else c for c in form)

    def _phone(self, value: str, tweak: str, _: str) -> str:
        digits = re.sub(r"\D", "", value)
        # The country code stays: what follows the plus, up to the next separator (or a leading 1).
        code = re.match(r"\+(1|\d+)", value)
        kept = len(code[1]) if code and len(code[1]) < len(digits) else 0
        # Ten digits without a code are a number of the numbering plan with code 1.
        plan = digits[:kept] or ("1" if len(digits) == 10 else "")
        return self._refill(value, digits[:kept] + self._digits(digits[kept:], f"{tweak}/{plan}"))

    def _ssn(self, value: str, tweak: str, _: str) -> str:
        return self._refill(value, self._digits(re.sub(r"\D", "", value), tweak))

    def _card(self, value: str, tweak: str, _: str) -> str:
        digits = re.sub(r"\D", "", value)
        body = digits[0] + self._digits(digits[1:-1], f"{tweak}/{digits[0]}")
        off = int(digits[-1]) - check_digit(digits[:-1])
        return self._refill(value, body + str((check_digit(body) + off) % 10))

    def _ip(self, value: str, tweak: str, _: str) -> str:
        a, b, c, d = map(int, value.split("."))
        number = a << 24 | b << 16 | c << 8 | d
        bits = network(number)
        permute = self._permutation(f"{tweak}/{bits}", 1 << bits)
        if bits < 32:
            moved = number >> bits << bits | permute(number & (1 << bits) - 1)
        else:
            moved = permute(number)
            while network(moved) < 32:  # cycle-walking again: public addresses stay public
                moved = permute(moved)
        return ".".join(str(moved >> shift & 255) for shift in (24, 16, 8, 0))

    def _name(self, value: str, tweak: str, gender: str) -> str:
        script = next((s for s in SYLLABLES if s in unicodedata.name(value[0], "")), None)
        if script is None:
            return self._spread(value, tweak)
        if "-" in value.strip("-"):
            # Each part of a double name is one.
            return "-".join(self._name(part, f"{value}/{place}/{tweak}", gender) if part else "" for place, part in enumerate(value.split("-")))
        onsets, vowels, endings = SYLLABLES[script]
        drawn = int.from_bytes(hashlib.blake2b(f"{tweak}/{value}".encode(), key=hashlib.sha256(self.key).digest()).digest(), "big")

        def draw(choices: list[str]) -> str:
            nonlocal drawn
            drawn, place = divmod(drawn, len(choices))
            return choices[place]

        # Every other attempt a syllable longer: the supply of names does not end.
        length = 2 + drawn % 2 + int(tweak.rpartition("/")[2]) // 2
        drawn >>= 1
        word = "".join(draw(onsets) + draw(vowels) for _ in range(length)) + draw(endings[gender])
        return word.upper() if len(value) > 1 and value.isupper() and not value.endswith(".") else word.capitalize()

    def _surname(self, value: str, tweak: str, _: str) -> str:
        return self._name(value, tweak, "")

    def _given(self, value: str, tweak: str, kind: str) -> str:
        return self._name(value, tweak, kind[-1])


def check_digit(digits: str) -> int:
    total = sum(sum(divmod(2 * int(c), 10)) if place % 2 == 0 else int(c) for place, c in enumerate(reversed(digits)))
    return -total % 10


def network(number: int) -> int:
    """Bits that may change without leaving the kind of network: 32 for public addresses."""
    top = number >> 24
    if top in (10, 127):
        return 24
    if number >> 20 == 172 << 4 | 1:
        return 20
    return 16 if number >> 16 in (192 << 8 | 168, 169 << 8 | 254) else 32


def replace(text: str | None, surrogates: Surrogates, attempts: dict[tuple[str, str], int]) -> tuple[str | None, list[tuple[int, int, str]]]:
    """The text with surrogates, and where they stand in it: (start, end, kind)."""
    if text is None:
        return None, []
    parts, places, at, size = [], [], 0, 0
    for e in detect(text):
        made = surrogates.of(e.kind, e.value, attempts.get((e.kind, e.value), 0))
        parts += [text[at : e.start], made]
        size += e.start - at
        places.append((size, size + len(made), e.kind))
        size, at = size + len(made), e.end
    return "".join([*parts, text[at:]]), places


def occurrences(docs: DataFrame, text: str) -> DataFrame:
    """Distinct (hash, kind, value): what occurs in which text; copies of a text count once."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [(h, e.kind, e.value) for h, t in zip(part.column(0).to_pylist(), part.column(1)) for e in detect(t.as_py())]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows]) for i in range(3)], names=["hash", "kind", "value"])

    rows = docs.select(F.xxhash64(text).alias("hash"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "hash long, kind string, value string").distinct()


def assign(entities: DataFrame, key: str) -> DataFrame:
    """(kind, value, attempt, surrogate) for distinct (kind, value), without collisions.

    Of entities with one surrogate, that of the fewest attempts and then the smallest value keeps it. A surrogate that
    is a real entity of its kind (its own included) is never kept. The others draw again until none is left.
    """

    def draw(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key.encode())
        for part in parts:
            made = [surrogates.of(*row) for row in zip(*(c.to_pylist() for c in part.columns))]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(made, pa.string())], names=["kind", "value", "attempt", "surrogate"])

    schema = "kind string, value string, attempt int, surrogate string"
    drawn = materialise(entities.select("kind", "value", F.lit(0).alias("attempt")).mapInArrow(draw, schema), "surrogates")
    while True:
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "value")).alias("first"), F.count("*").alias("n"))
        shared = drawn.join(first.filter("n > 1"), ["kind", "surrogate"]).filter("value <> first.value").select("kind", "value")
        real = drawn.join(entities.select("kind", F.col("value").alias("surrogate")), ["kind", "surrogate"], "left_semi").select("kind", "value")
        losers = materialise(shared.union(real).distinct(), "collisions")
        if losers.isEmpty():
            return drawn
        again = drawn.join(losers, ["kind", "value"]).select("kind", "value", (F.col("attempt") + 1).alias("attempt")).mapInArrow(draw, schema)
        drawn = materialise(drawn.join(losers, ["kind", "value"], "left_anti").unionByName(again), "surrogates")


def pseudonymise(docs: DataFrame, key: str, text: str = "text", places: str = "surrogates") -> DataFrame:
    """Replace the personal data of ``text``; add ``places`` (start, end, kind of each surrogate, in code points).

    A null text stays null, a text without personal data stays as it is. Other columns stay, except one named like
    ``places``. Repeated rows stay repeated and get the same surrogates. ``key`` must be kept secret: with it, numbers
    could be turned back.
    """
    found = materialise(occurrences(docs, text), "occurrences")
    drawn = assign(materialise(found.select("kind", "value").distinct(), "entities"), key)
    again = found.join(drawn.filter("attempt > 0"), ["kind", "value"])
    # A table of its own: its size tells Spark how to join it.
    known = materialise(again.groupBy("hash").agg(F.collect_list(F.struct("kind", "value", "attempt")).alias("again")), "again")
    names = [c for c in docs.columns if c.lower() != places.lower()]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names if c != text]).alias("_rest") if len(names) > 1 else F.lit(0).alias("_rest"),
        F.col(text).cast("string").alias("_text"), F.xxhash64(text).alias("hash"),
    ).join(known, "hash", "left").select("_rest", "_text", "again")
    spots = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))
    schema = T.StructType([rows.schema["_rest"], T.StructField("_text", T.StringType()), T.StructField("_places", spots)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        surrogates = Surrogates(key.encode())
        for part in parts:
            done = 0
            for some in batches(zip(part.column(1), part.column(2)), lambda row: len(row[0].as_py() or "")):
                made = [replace(t.as_py(), surrogates, {(a["kind"], a["value"]): a["attempt"] for a in more.as_py() or ()}) for t, more in some]
                spots = pa.array([[dict(zip(("start", "end", "kind"), p)) for p in where] for _, where in made], kind)
                columns = [part.column(0).slice(done, len(some)), pa.array([t for t, _ in made], pa.string()), spots]
                yield pa.RecordBatch.from_arrays(columns, names=["_rest", "_text", "_places"])
                done += len(some)

    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col("_text").alias(c) if c == text else F.col(f"_rest.`{c}`") for c in names], F.col("_places").alias(places))
