"""Mixing sources to target weights by iterative proportional fitting.

Documents fall into cells of source, language and topic. Only the categories
that targets name are told apart, so there are at most
(sources + 1) x (languages + 1) x (topics + 1) cells, whatever the corpus; their
token counts are the one thing that reaches the driver. There the cells are
raked: scaled to each margin in turn until all margins hold. A document's
chance is its cell's weight, scaled so that the documents drawn hold the wanted
part of the corpus; where the scaled weight exceeds 1, the document is in the
sample that many times (the fraction drawn), so the sample itself has the target
shares. Repeats come on top of the wanted part.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import outside, uniform

OTHER = "(other)"
#: Names used on the way; columns that bear them give way.
INNER = ["_source", "_lang", "_topic", "_tokens", "_hash", "_weight", "_probability", "_copies"]
MARGINS = ("source", "lang", "topic")
#: No cell weighs more, however far targets pull apart.
LIMIT = 1e9
WORDS = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Targets:
    """Shares of tokens by category and margin. Categories without one keep their share of the corpus between them."""

    source: Mapping[str, float]
    lang: Mapping[str, float]
    topic: Mapping[str, float]
    #: Topics in order: the first pattern found in a text names it.
    topics: Sequence[tuple[str, str]]


def topic_of(text: str, topics: Sequence[tuple[str, str]], named: Mapping[str, float]) -> Column:
    found = F.lit(OTHER)
    for name, pattern in reversed(topics):
        found = F.when(F.col(text).rlike(pattern), F.lit(name if name in named else OTHER)).otherwise(found)
    return found


def labelled(docs: DataFrame, targets: Targets, text: str = "text", source: str = "source", lang: str = "lang") -> DataFrame:
    """Add ``_source``, ``_lang``, ``_topic`` (a named category or ``OTHER``) and ``_tokens`` (words of the text; null: 0)."""
    fold = lambda c, named: F.when(F.col(c).isin(list(named)), F.col(c)).otherwise(F.lit(OTHER))
    return docs.select(
        *outside(docs, INNER),
        fold(source, targets.source).alias("_source"), fold(lang, targets.lang).alias("_lang"),
        topic_of(text, targets.topics, targets.topic).alias("_topic"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long").alias("_tokens"),
    )


def rake(cells: Sequence[tuple], tokens: Sequence[int], shares: Sequence[Mapping[str, float]], rounds: int = 1000, close: float = 1e-12) -> tuple[np.ndarray, float]:
    """Weights of cells (tuples of categories), 1 on average over tokens, and the largest error of a margin's share.

    Categories without tokens have no part: the targets of the others grow in proportion. Targets that cannot hold
    together leave an error after ``rounds``.
    """
    tokens, weights = np.asarray(tokens, dtype=float), np.ones(len(cells))
    total, error = tokens.sum(), 0.0
    if total == 0:
        return weights, error
    plans = []
    for margin, wanted in enumerate(shares):
        names = sorted({cell[margin] for cell in cells})
        place = np.array([names.index(cell[margin]) for cell in cells])
        held = np.bincount(place, tokens, len(names))
        named = np.array([max(0.0, wanted.get(name, 0.0)) if name in wanted else 0.0 for name in names]) * (held > 0)
        free = np.array([name not in wanted for name in names]) * held
        # Unnamed categories keep their share; the named ones divide the rest.
        rest = total - free.sum()
        goal = free + (named / named.sum() * rest if named.sum() > 0 else np.where(free > 0, 0, held))
        plans.append((place, goal, len(names)))
    for _ in range(rounds):
        for place, goal, n in plans:
            now = np.bincount(place, weights * tokens, n)
            weights = np.clip(weights * np.divide(goal, now, out=np.ones(n), where=now > 0)[place], 0, LIMIT)
        error = max(np.abs(np.bincount(place, weights * tokens, n) - goal).max() / total for place, goal, n in plans)
        if error < close:
            break
    return weights, float(error)


def scale(weights: np.ndarray, tokens: Sequence[int], rate: float) -> float:
    """The factor at which min(1, factor * weight) of the tokens are ``rate`` of all (or as near as it gets: all cells whole)."""
    tokens = np.asarray(tokens, dtype=float)
    wanted, order = rate * tokens.sum(), np.argsort(-weights, kind="stable")
    if wanted <= 0:
        return max(0.0, rate)
    full = np.concatenate([[0.0], np.cumsum(tokens[order])])
    open_ = np.concatenate([np.cumsum((weights * tokens)[order][::-1])[::-1], [0.0]])
    for k in range(len(order) + 1):  # the k heaviest cells are taken whole
        if k == len(order) or open_[k] <= 0:
            break
        factor = (wanted - full[k]) / open_[k]
        if factor * weights[order[k]] <= 1:
            return max(0.0, factor)
    # Cells without tokens do not count.
    least = weights[(weights > 0) & (tokens > 0)]
    return float(1 / least.min()) if len(least) else 1.0


def probabilities(weights: np.ndarray, tokens: Sequence[int], rate: float) -> np.ndarray:
    """min(1, scale * weight), with the scale at which the expected sample holds ``rate`` of all tokens (or as near as it gets)."""
    return np.minimum(1.0, scale(weights, tokens, rate) * weights)


def mix(
    docs: DataFrame, targets: Targets, rate: float, key: str, id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
) -> DataFrame:
    """All rows of ``docs`` with ``topic``, ``n_tokens``, ``weight`` (raked), ``probability``, ``sampled``, ``sample_weight`` and ``copies``.

    Whether and how often a row is sampled depends on ``key``, its id and its text alone: repeated rows share their fate,
    runs repeat. ``rate`` is the part of all tokens that sampled rows hold, each counted once. Sampled rows weighted by
    ``sample_weight``, or taken ``copies`` times (1 or more; 0 if not sampled), have the target shares in expectation. Null categories count as unnamed.
    Own columns of those names, and of ``INNER``, give way. An empty table stays empty.
    """
    added = ["topic", "n_tokens", "weight", "probability", "sampled", "sample_weight", "copies"]
    marked = labelled(docs, targets, text, source, lang)
    keys = ["_source", "_lang", "_topic"]
    # Bounded by the number of named categories.
    cells = sorted(marked.groupBy(*keys).agg(F.sum("_tokens").alias("n")).collect())
    tokens = [cell["n"] for cell in cells]
    weights, _ = rake([tuple(cell)[:3] for cell in cells], tokens, [targets.source, targets.lang, targets.topic])
    chances, factor = probabilities(weights, tokens, rate), scale(weights, tokens, rate)
    # A sampled row of a cell taken whole is there more than once.
    rows = [(*tuple(cell)[:3], float(w), float(p), max(1.0, float(factor * w)) if cell["n"] else 1.0) for cell, w, p in zip(cells, weights, chances)]
    table = docs.sparkSession.createDataFrame(rows, "_source string, _lang string, _topic string, _weight double, _probability double, _copies double")
    drawn = marked.withColumn("_hash", F.xxhash64(text)).join(F.broadcast(table), keys)
    sampled = uniform(key, id, "_hash") < F.col("_probability")
    more = uniform(f"{key}/copies", id, "_hash") < F.col("_copies") - F.floor("_copies")
    copies = F.when(sampled, F.floor("_copies") + more.cast("long")).otherwise(F.lit(0).cast("long"))
    return drawn.select(
        *[F.col(f"`{c}`") for c in outside(docs, added)],
        F.col("_topic").alias("topic"), F.col("_tokens").alias("n_tokens"), F.col("_weight").alias("weight"), F.col("_probability").alias("probability"),
        sampled.alias("sampled"), F.when(sampled, F.col("_weight") / F.col("_probability")).alias("sample_weight"),
        copies.alias("copies"),
    )


def sample(docs: DataFrame, targets: Targets, rate: float, key: str, **columns: str) -> DataFrame:
    """The sampled rows, each as often as its ``copies`` say, with their own columns only (clashing names kept)."""
    names = {"id": "doc_id", "text": "text", "source": "source", "lang": "lang"} | columns
    whole = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[F.col(column).alias(f"_in_{name}") for name, column in names.items()]
    )
    drawn = mix(whole, targets, rate, key, **{name: f"_in_{name}" for name in names})
    repeated = drawn.filter("sampled").select("_row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("_copy"))
    return repeated.select("_row.*")
