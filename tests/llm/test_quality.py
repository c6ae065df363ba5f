"""Quality rules against a plain version, and ablations against the definition."""

import collections
import random

from pyspark.sql import functions as F

from invspark.llm import quality, queries
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.001"


def measured(text):
    text = text or ""
    words = [w.decode() for w in text.encode().split()]
    places = collections.defaultdict(list)
    for i in range(len(words) - 4):
        places[tuple(words[i : i + 5])].append(i)
    repeated = {p for found in places.values() if len(found) > 1 for i in found for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "n_capitals": sum("A" <= c <= "Z" for c in text), "n_stutters": sum(a == b for a, b in zip(words, words[1:])),
    }


def failed(m):
    tests = (
        m["n_words"] < 10, 100 * m["n_repeat_words"] > 20 * m["n_words"], 100 * m["n_symbols"] > 10 * m["n_words"], 100 * m["n_dup_lines"] > 50 * m["n_lines"],
        100 * m["n_capitals"] > 50 * m["word_chars"], 100 * m["n_stutters"] > 20 * m["n_words"], m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 15 * m["n_words"],
    )
    return sum(1 << i for i, test in enumerate(tests) if test)


def texts():
    rng = random.Random(2)
    some = ["", " ", "\n\n", "\xa0 \x85", "a b c d e a b c d e", "a b c d e f a b c d e f a", "x " * 500, "A B\tC\x0bD\x0cE\rF\nA B\tC", "é 🙂 " * 7, "w" * 100_000, "one line\n one line\none line\n\n \none line"]
    some += [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 40))) for _ in range(150)]
    some += ["".join(rng.choice("ab #*\n\tÄ") for _ in range(rng.randint(0, 60))) for _ in range(100)]
    some.append(" ".join(str(rng.randrange(3000)) for _ in range(20_000)))
    return [None, *some]


def test_ledger_equals_plain_version(spark):
    all_texts = texts()
    rows = [(i, t, "clash", 0, None) for i, t in enumerate(all_texts)] + [(5, all_texts[5], "again", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, N_words string, _h int, lang string")
    found = quality.ledger(docs)
    assert "N_words" not in found.columns and "n_words" in found.columns and "lang" in found.columns
    got = found.collect()
    assert len(got) == len(rows)
    for row in got:
        want = measured(all_texts[row.doc_id])
        assert {k: row[k] for k in want} == want and row.failed == failed(want), all_texts[row.doc_id]


def test_keep_and_filters_agree(spark):
    docs = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts())], "doc_id long, text string, failed int")
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    wanted = {i for i, t in enumerate(texts()) if failed(measured(t)) & quality.POLICIES["v2"] == 0}
    assert {r.doc_id for r in kept.collect()} == wanted
    assert {r.doc_id for r in quality.ledger(docs).filter(quality.passes("v1")).collect()} == {i for i, t in enumerate(texts()) if failed(measured(t)) & 3 == 0}


def test_ablations(spark):
    docs = spark.createDataFrame([(t,) for t in texts()], "text string")
    bits = [failed(measured(t)) for t in texts()]
    found = {r.rule: r for r in quality.ablations(quality.ledger(docs)).collect()}
    chosen = quality.POLICIES["v2"]
    for name, bit in quality.BITS.items():
        row = found[name]
        assert row.n_failed == sum(b & bit > 0 for b in bits) and row.n_only == sum(b & chosen == bit for b in bits)
        assert row.n_kept_without == sum(b & chosen & ~bit == 0 for b in bits)


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert quality.ledger(empty).count() == 0 == quality.keep(empty).count()


def test_query_equals_sql(spark):
    assert not differences(queries.QUERIES["op10_quality_rules"](spark, SF), oracle(SF), queries.SQL["op10_quality_rules"])
