"""Raking against a plain version; margins, chances and draws."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from invspark.llm import mixing, queries


def plain_rake(cells, tokens, shares):
    """Cell by cell, with dicts."""
    mass = dict(zip(cells, map(float, tokens)))
    total = sum(mass.values())
    goals = []
    for m, wanted in enumerate(shares):
        held = {}
        for c, t in mass.items():
            held[c[m]] = held.get(c[m], 0) + t
        free = {k: v for k, v in held.items() if k not in wanted}
        named = {k: wanted[k] for k in held if k in wanted and held[k] > 0}
        rest = total - sum(free.values())
        goals.append(free | {k: v / sum(named.values()) * rest for k, v in named.items()})
    for _ in range(500):
        for m, goal in enumerate(goals):
            now = {}
            for c, t in mass.items():
                now[c[m]] = now.get(c[m], 0) + t
            for c in mass:
                if now[c[m]] > 0:
                    mass[c] *= goal[c[m]] / now[c[m]]
    return [mass[c] / t if t else None for c, t in zip(cells, tokens)]


def test_rake_equals_plain_version():
    rng = random.Random(3)
    cells = list(itertools.product(["a", "b", "(other)"], ["x", "y"], ["p", "q"]))
    tokens = [rng.randint(1, 500) for _ in cells]
    shares = [{"a": 0.5, "b": 0.3, "none": 0.2}, {"x": 0.9, "y": 0.1}, {"p": 0.4, "q": 0.6}]
    weights, error = mixing.rake(cells, tokens, shares)
    assert error < 1e-12 and np.allclose(weights, plain_rake(cells, tokens, shares), rtol=1e-6)
    other = sum(t for c, t in zip(cells, tokens) if c[0] == "(other)")
    assert sum(w * t for c, w, t in zip(cells, weights, tokens) if c[0] == "(other)") == pytest.approx(other)


def test_probabilities_hit_the_size():
    weights, tokens = np.array([4.0, 1.0, 0.25, 0.0]), [100, 200, 400, 50]
    for rate in (0.05, 0.3, 0.6):
        p = mixing.probabilities(weights, tokens, rate)
        assert (p * tokens).sum() == pytest.approx(rate * 750) and p.max() <= 1 and p[3] == 0
    assert mixing.probabilities(weights, tokens, 1.0).tolist() == [1, 1, 1, 0]
    assert mixing.probabilities(np.ones(2), [0, 0], 0.5).tolist() == [0.5, 0.5]


def test_query_margins_and_draw(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op4_mixing"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    total = sum(r.n_tokens for r in rows)
    for r in rows:
        text = docs[r.doc_id].text
        assert r.n_tokens == len(text.encode().split())
        assert r.topic == next((n for n, p in queries.MIX.topics if re.search(p, text)), mixing.OTHER)
        assert r.sampled == (r.sample_weight is not None)
    weights, _ = mixing.rake(*zip(*[((c, ), t) for c, t in (("x", 1),)]), [{"x": 1.0}])
    assert weights.tolist() == [1.0]
    for margin, of in (("source", lambda r: r.source), ("lang", lambda r: r.lang), ("topic", lambda r: r.topic)):
        wanted = getattr(queries.MIX, margin)
        held = {of(r) for r in rows}
        scale = sum(v for k, v in wanted.items() if k in held)
        for name in held & set(wanted):
            share = sum(r.weight * r.n_tokens for r in rows if of(r) == name) / total
            assert share == pytest.approx(wanted[name] / scale, abs=1e-9)
    expected = sum(r.probability * r.n_tokens for r in rows) / total
    assert expected == pytest.approx(queries.MIX_RATE)
    drawn = sum(r.n_tokens for r in rows if r.sampled) / total
    assert abs(drawn - expected) < 0.06


ROWS = [(*r, "x", None) for r in [(1, "one two", None, None, 5), (1, "one two", None, None, 5), (2, None, "src0", "en", 1), (None, "", "src1", "xx", 2), (None, "a 1", "src1", "de", 2)]]
SCHEMA = "doc_id long, text string, source string, lang string, Weight int, _hash string, _probability string"


def test_edges(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    rows = mixing.mix(docs, queries.MIX, 0.5, "k").collect()
    assert len(rows) == 5 and [r.sampled for r in rows if r.doc_id == 1][0] == [r.sampled for r in rows if r.doc_id == 1][1]
    assert "Weight" not in rows[0].asDict() and "weight" in rows[0].asDict()
    kept = mixing.sample(docs, queries.MIX, 1e9, "k")
    assert kept.columns == docs.columns
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty, queries.MIX, 0.5, "k").count() == 0 == mixing.sample(empty, queries.MIX, 0.5, "k").count()


def shares(rows, of, size):
    total = sum(size(r) for r in rows)
    out = {}
    for r in rows:
        out[of(r)] = out.get(of(r), 0) + size(r) / total
    return out


def test_sample_holds_the_margins(spark):
    """The sample itself has the target shares: expected copies exactly, the rows of the stage nearly."""
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = queries.QUERIES["op4_mixing"](spark, sf).collect()
    tokens = {r.doc_id: r for r in rows}
    assert max(r.probability for r in rows) == 1 and max(r.copies for r in rows) > 1
    stage = [tokens[r.doc_id] for r in mixing.sample(docs, queries.MIX, queries.MIX_RATE, queries.MIX_KEY).select("doc_id").collect()]
    assert len(stage) == sum(r.copies for r in rows) and all((r.copies >= 1) == r.sampled for r in rows)
    cells = sorted({(r.source, r.lang, r.topic, r.weight, r.probability) for r in rows})
    held = [sum(r.n_tokens for r in rows if (r.source, r.lang, r.topic) == c[:3]) for c in cells]
    factor = mixing.scale(np.array([c[3] for c in cells]), held, queries.MIX_RATE)
    for margin, of in (("source", lambda r: r.source), ("lang", lambda r: r.lang), ("topic", lambda r: r.topic)):
        wanted, reached = getattr(queries.MIX, margin), shares(stage, of, lambda r: r.n_tokens)
        expected = shares([r for r in rows if r.weight > 0], of, lambda r: r.n_tokens * r.probability * max(1, factor * r.weight))
        scale = sum(v for k, v in wanted.items() if k in expected)
        for name in set(expected) & set(wanted):
            assert expected[name] == pytest.approx(wanted[name] / scale, abs=1e-6)
            assert reached.get(name, 0) == pytest.approx(wanted[name] / scale, abs=0.015)
