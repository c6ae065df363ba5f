"""Secrets in texts: known forms, and strings that are too random for words.

Known forms are three patterns. Beyond them, runs of a character class (hex
digits, base64 characters) are candidates; a window slides over each, its
character counts change by one in and one out, and with them the sum that
Shannon's entropy is made of. A candidate whose window gets as random as its
class allows is reported, unless the allow-list knows it.

Built-in functions only. Positions are code points: the pieces between matches
and the matches themselves add up to the text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import outside, running


@dataclass(frozen=True)
class Form:
    """A known form. Matches whose ``group`` is shorter than ``least`` characters are dropped after matching."""

    kind: str
    pattern: str
    group: int
    least: int


@dataclass(frozen=True)
class Alphabet:
    """A character class; ``bits``: the entropy a window must reach; ``mixed``: a candidate must match it too."""

    kind: str
    run: str
    letters: str
    bits: float
    mixed: str


FORMS = (
    Form("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    # Runs are maximal, so the least length can stand in the pattern.
    Form("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    Form("hex", r"[0-9a-f]{16,}", 0, 16),
)
WINDOW = 20
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
ALPHABETS = (
    Alphabet("entropy_hex", r"(?<![A-Za-z0-9])[0-9A-Fa-f]{20,}(?![A-Za-z0-9])", DIGITS + LOWER[:6] + LOWER[:6].upper(), 3.0, r"[0-9]"),
    Alphabet("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", DIGITS + LOWER + LOWER.upper() + "+/_=-", 3.75, r"(?=.*[0-9])(?=.*[A-Za-z])(?=.*[^0-9A-Fa-f])"),
)
KINDS = tuple(f.kind for f in FORMS) + tuple(a.kind for a in ALPHABETS)
#: Strings that look random and are not secret: UUIDs, samples, alphabets, words joined by hyphens. A candidate may
#: hold a name and its value: samples are told by what stands behind its last separator, alphabets by what stands
#: behind its last equals sign (they hold the other separators); equals signs at the end are padding.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)(?:example|sample|dummy|placeholder)[^=/_+-]*=*$",
    r"(?i)(?:0123456789|abcdefghijklm|nopqrstuvwxyz)[^=]*=*$",
    r"^[A-Za-z]+([-_/=+][A-Za-z]+)+$",
)
#: c * log2(c), in whole millionths, so that sums do not drift while a window slides.
SCALE = 1_000_000
COSTS = [0, *(round(c * math.log2(c) * SCALE) for c in range(1, WINDOW + 1))]
#: Names used on the way; columns that bear them, or those of the results, give way.
INNER = ("_t", "_m", "_b", "_g", "_z", "_at")
SPAN = "array<struct<start: bigint, place: int, end: bigint>>"


def least_cost(candidate: Column, alphabet: Alphabet) -> Column:
    """The smallest sum of c * log2(c) over the character counts of any window; null if the candidate is shorter."""
    n = len(alphabet.letters)
    costs = F.array(*[F.lit(c).cast("long") for c in COSTS])
    cost = lambda c: F.element_at(costs, c + 1)
    codes = F.transform(F.split(candidate, "", -1), lambda c: F.instr(F.lit(alphabet.letters), c))
    # Leaving characters run WINDOW behind those that come in; 0 stands for none.
    steps = F.zip_with(codes, F.concat(F.array_repeat(F.lit(0), WINDOW), codes), lambda a, b: F.struct(F.coalesce(a, F.lit(0)).alias("a"), b.alias("b")))

    def slide(state, step):
        a, b = step["a"], step["b"]
        moved = (a != b) & (a > 0)
        came = F.when(a > 0, F.element_at(state["counts"], F.greatest(a, F.lit(1)))).otherwise(F.lit(0))
        went = F.when(b > 0, F.element_at(state["counts"], F.greatest(b, F.lit(1)))).otherwise(F.lit(0))
        total = F.when(
            moved, state["sum"] + cost(came + 1) - cost(came) - F.when(b > 0, cost(went) - cost(F.greatest(went - 1, F.lit(0)))).otherwise(F.lit(0).cast("long"))
        ).otherwise(state["sum"])
        counts = F.when(
            moved, F.transform(state["counts"], lambda c, k: c + (k + 1 == a).cast("int") - (k + 1 == b).cast("int"))
        ).otherwise(state["counts"])
        seen = state["seen"] + (a > 0).cast("int")
        full = (seen >= WINDOW) & (a > 0)
        return F.struct(
            counts.alias("counts"), total.alias("sum"), seen.alias("seen"),
            F.when(full, F.least(state["best"], total)).otherwise(state["best"]).alias("best"),
        )

    begin = F.struct(
        F.array_repeat(F.lit(0), n).alias("counts"), F.lit(0).cast("long").alias("sum"), F.lit(0).alias("seen"), F.lit(None).cast("long").alias("best")
    )
    return F.aggregate(F.filter(steps, lambda s: s["a"] > 0), begin, slide, lambda s: s["best"])


def random(candidate: Column, alphabet: Alphabet, allowed: Sequence[str] = ALLOWED) -> Column:
    """Whether some window is as random as the class asks, and the allow-list does not know the candidate."""
    most = round(WINDOW * (math.log2(WINDOW) - alphabet.bits) * SCALE)
    fair = candidate.rlike(alphabet.mixed)
    for pattern in allowed:
        fair = fair & ~candidate.rlike(pattern)
    return F.when(fair, F.coalesce(least_cost(candidate, alphabet) <= most, F.lit(False))).otherwise(F.lit(False))


def spans(texts: DataFrame, name: str, pattern: str, place: int, good, kept: list[str]) -> DataFrame:
    """Add ``name``: where ``pattern`` matches ``_t``, leftmost and non-overlapping, and ``good(match fields)`` holds."""
    there = F.col("_t").rlike(pattern)
    found = texts.select(
        *kept,
        F.when(there, F.regexp_extract_all("_t", F.lit(pattern), F.lit(0))).alias("_m"),
        F.when(there, F.split("_t", pattern, -1)).alias("_b"),
        good.alias("_g") if good is not None else F.lit(None).cast("array<boolean>").alias("_g"),
    )
    # Each match begins where the pieces and matches before it end.
    sizes = F.zip_with(F.slice("_b", F.lit(2), F.greatest(F.size("_m") - 1, F.lit(0))), F.slice("_m", F.lit(1), F.greatest(F.size("_m") - 1, F.lit(0))), lambda b, m: F.char_length(b) + F.char_length(m))
    first = F.char_length(F.get("_b", F.lit(0))).cast("long")
    sized = found.withColumn("_z", F.when(F.col("_m").isNotNull(), F.concat(F.transform(sizes, lambda x: x.cast("long")), F.array(F.lit(0).cast("long")))))
    started = sized.withColumn("_at", F.when(F.col("_m").isNotNull(), F.transform(running("_z"), lambda x: x + first)))
    placed = F.zip_with("_m", "_at", lambda m, at: F.struct(at.alias("start"), F.lit(place).alias("place"), (at + F.char_length(m)).alias("end")))
    if good is not None:
        placed = F.transform(F.filter(F.arrays_zip(placed.alias("s"), F.col("_g").alias("g")), lambda z: z["g"]), lambda z: z["s"])
    return started.select(*kept, F.coalesce(placed, F.array().cast(SPAN)).cast(SPAN).alias(name))


def scan(docs: DataFrame, text: str = "text", allowed: Sequence[str] = ALLOWED) -> DataFrame:
    """Add ``base`` and ``spans``: arrays of (kind, start, end) by start, then kind in the order of ``KINDS``, then end.

    ``base`` holds the known forms, ``spans`` those and the random strings; spans may overlap. Positions are code
    points from 0, ends exclusive. Null and empty texts have none. Rows are independent: nothing is shuffled.
    Other columns stay, except those named like the results or ``INNER``.
    """
    kept = outside(docs, ["base", "spans", *INNER, *(f"_s{i}" for i in range(len(KINDS)))])
    found = docs.select(*kept, F.coalesce(F.col(text), F.lit("")).alias("_t"))
    names: list[str] = []

    def add(pattern: str, group: int, test) -> None:
        nonlocal found
        groups = F.regexp_extract_all("_t", F.lit(pattern), F.lit(group))
        good = F.when(F.col("_t").rlike(pattern), F.transform(groups, test)) if test else None
        found = spans(found, f"_s{len(names)}", pattern, len(names), good, [*kept, "_t", *names])
        names.append(f"_s{len(names)}")

    for form in FORMS:
        long_enough = (lambda least: lambda g: F.char_length(g) >= least)(form.least)
        add(form.pattern, form.group, long_enough if form.group else None)
    for alphabet in ALPHABETS:
        add(alphabet.run, 0, (lambda a: lambda c: random(c, a, allowed))(alphabet))
    kinds = F.array(*[F.lit(k) for k in KINDS])

    def listed(some: list[str]) -> Column:
        ordered = F.array_sort(F.flatten(F.array(*some)))
        return F.transform(ordered, lambda s: F.struct(F.element_at(kinds, s["place"] + 1).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    return found.select(*kept, listed(names[: len(FORMS)]).alias("base"), listed(names).alias("spans"))
