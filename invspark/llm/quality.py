"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps what was measured
and one failure bit per rule; policies are masks over those bits, so a new
policy version, or the question what a rule costs, never reads a text again.

Built-in functions only: a text is split into words and lines, word windows are
compared through a sort of 64-bit hashes inside the row, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import BLANK, outside

WINDOW = 5
SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_capitals", "n_stutters")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measures; the rule's bit is its place in ``RULES``."""

    name: str
    fails: str


#: Places are part of the stored format: append, never reorder.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("shouting", "100 * n_capitals > 50 * word_chars"),
    Rule("stutter", "100 * n_stutters > 20 * n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
)
BITS = {rule.name: 1 << place for place, rule in enumerate(RULES)}


def mask(*names: str) -> int:
    return sum(BITS[name] for name in set(names))


BASE = mask("few_words", "repeated_windows")
#: Each version names the rules whose failure rejects a document.
POLICIES = {"v1": BASE, "v2": mask(*BITS)}
CURRENT = "v2"


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the ``MEASURES`` (longs) of a text; its other columns stay, unless they bear those names.

    Words are runs of characters other than space and ``\\t\\n\\v\\f\\r``. A null or empty text measures 0
    everywhere. ``n_repeat_words`` counts the words that lie in a five-word window found twice or more in
    the text, the first occurrence included; ``n_dup_lines`` the lines with a word that equal an earlier
    line; ``n_capitals`` the letters A to Z; ``n_stutters`` the words equal to the one before.
    Equal words and windows are found by 64-bit hashes.
    """
    kept = outside(docs, [*MEASURES, "_t", "_w", "_l", "_h", "_g", "_s", "_p"])
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(*kept, body.alias("_t")).select(
        *kept, "_t",
        F.filter(F.split("_t", BLANK, -1), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_l"),
    )
    counted = split.select(
        *kept, "_w",
        F.size("_w").cast("long").alias("n_words"),
        F.char_length(F.regexp_replace("_t", BLANK, "")).cast("long").alias("word_chars"),
        (F.char_length("_t") - F.char_length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        (F.char_length("_t") - F.char_length(F.translate("_t", CAPITALS, ""))).cast("long").alias("n_capitals"),
    )
    measures = [m for m in MEASURES if m in counted.columns]
    # A word is hashed once; a window is the hash of five such hashes.
    hashed = counted.select(*kept, *measures, F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    at = lambda i: F.get("_h", i)
    places = F.sequence(F.lit(0), F.greatest(F.size("_h") - WINDOW, F.lit(0)))
    windows = F.transform(places, lambda i: F.xxhash64(*[at(i + k) for k in range(WINDOW)]))
    stutters = F.size(F.filter("_h", lambda h, i: F.coalesce(h == F.get("_h", i - 1), F.lit(False))))
    grams = hashed.select(*kept, *measures, stutters.cast("long").alias("n_stutters"), windows.alias("_g"))
    # Only a text in which some window repeats pays for the sort.
    again = (F.col("n_words") >= WINDOW) & (F.size(F.array_distinct("_g")) < F.size("_g"))
    ordered = F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    ordered = grams.select(*kept, *measures, "n_stutters", F.when(again, ordered).alias("_s"))
    same = lambda x, i: F.coalesce(x["h"] == F.get("_s", i).getField("h"), F.lit(False))
    twice = F.filter("_s", lambda x, i: same(x, i - 1) | same(x, i + 1))
    starts = F.sort_array(F.transform(twice, lambda x: x["p"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    found = ordered.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long")))
    return found.select(*kept, *MEASURES)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """``measure`` and ``failed`` (long): bit k is set where rule k fails. Every rule is evaluated, whatever the policy."""
    measured = measure(docs, text)
    bits = [F.when(F.expr(rule.fails), F.lit(BITS[rule.name])).otherwise(F.lit(0)).cast("long") for rule in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    kept = outside(measured, ["failed", *MEASURES])
    # A generator: a filter on its columns stays above it, so that no measure is evaluated again inside a filter.
    return measured.select(*kept, F.inline(F.array(F.struct(*MEASURES, total.alias("failed")))))


def passes(policy: str = CURRENT, policies: Mapping[str, int] = POLICIES) -> Column:
    """Whether a ledger row passes a policy version."""
    return F.col("failed").bitwiseAND(F.lit(policies[policy]).cast("long")) == 0


def keep(docs: DataFrame, text: str = "text", policy: str = CURRENT) -> DataFrame:
    """The rows that pass ``policy``, with their own columns only (order and clashing names kept)."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_text"))
    return ledger(whole, "_text").filter(passes(policy)).select("_row.*")


def ablations(book: DataFrame, policy: str = CURRENT, policies: Mapping[str, int] = POLICIES) -> DataFrame:
    """For each rule of a policy: how many documents fail it, fail only it, and would pass without it.

    Rows are first counted per distinct bit pattern (at most ``2 ** len(RULES)``), whatever the input.
    """
    chosen = policies[policy]
    patterns = book.groupBy(F.col("failed").bitwiseAND(F.lit(chosen).cast("long")).alias("_bits")).agg(F.count("*").alias("_n"))
    rules = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(BITS[r.name]).cast("long").alias("bit")) for r in RULES if BITS[r.name] & chosen
    ])
    hit = F.col("_bits").bitwiseAND(F.col("bit")) != 0
    return (
        patterns.select("_bits", "_n", F.inline(rules))
        .groupBy("rule", "bit")
        .agg(
            F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("_bits") == F.col("bit"), F.col("_n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(F.col("_bits").bitwiseAND(F.bitwise_not("bit")) == 0, F.col("_n")).otherwise(0)).alias("n_kept_without"),
        )
    )
