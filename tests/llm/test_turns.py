"""Conversation repair against an exhaustive search, the ranking of paths against all strings, and edge rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from invspark.llm import queries, turns
from tests.compare import differences, oracle

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        left = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not left else "duplicate" if (role, text) in seen else "truncated" if left[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def exhaustive(rows):
    """(cost, audit, repaired rows) of the best of all repairs with up to three inserts at a place."""
    found, best = faults(rows), {}

    def go(i, inserts, cost, audit, out):
        roles = "".join(r[:1] or "-" for r, _ in out)
        if not re.fullmatch(r"(s?(ua)*u?)?", roles) or cost > 2 * len(rows):
            return
        if i == len(rows) and re.fullmatch(r"(s?(ua)+)?", roles):
            best.setdefault((cost, audit), out)
        if inserts < 2:
            for role in ("user", "assistant"):
                go(i, inserts + 1, cost + 5, audit + "I", [*out, (role, "")])
        if i < len(rows):
            role, text = rows[i]
            go(i + 1, 0, cost + 2, audit + "D", out)
            if found[i] not in ("blank", "duplicate"):
                more = 5 if found[i] == "truncated" else 0
                go(i + 1, 0, cost + more, audit + "K", [*out, (role, text)])
                for other in ("user", "assistant"):
                    go(i + 1, 0, cost + more + 1, audit + "R", [*out, (other, text)])

    go(0, 0, 0, "", [])
    (cost, audit), out = min(best.items())
    return cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role if role is not None else " ", text if text is not None else " "))
    out = {}
    for conv, held in by.items():
        held.sort()
        said = [(role, text) for _, _, role, text in held]
        found, known = faults(said), {turn for there, turn, _, _ in held if there}
        gaps = max(known) - min(known) + 1 - len(known) if known else 0
        pairs = [(a[0][:1], b[0][:1]) for a, b in zip(said, said[1:])]
        out[conv] = (gaps, found.count("blank"), found.count("duplicate"), found.count("truncated"), sum(p not in (("s", "u"), ("u", "a"), ("a", "u")) for p in pairs), *exhaustive(said))
    return out


def repaired(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA)
    return {r[0]: tuple(r)[1:] for r in turns.digests(turns.repair(df)).collect()}


def sample(n):
    rng = random.Random(n)
    roles, texts = ["user", "assistant", "system", "user", "assistant", "tool", "", "use"], ["Yes.", "No!", "open", " ", "", "Why? \t", " ", "x. y"]
    rows = [(c, rng.choice([t, t, t, 2 * t, None]), rng.choice(roles), rng.choice(texts) + rng.choice(["", f" {t}", f" {t}."])) for c in range(n) for t in range(rng.randint(1, 6))]
    rows += [(None, t, "user", f"{t}.") for t in range(4)] + [(-1, None, None, None), (-2, 1, "assistant", None), (-3, -5, "user", "a.\nb!"), (-3, 5, "assistant", "é.")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limits", [(20_000, 8 << 20), (3, 4)])
def test_equals_exhaustive_search(spark, monkeypatch, limits):
    """Also where nearly nothing waits, so that rows are passed on while their conversation comes."""
    monkeypatch.setattr(turns, "ROWS", limits[0])
    monkeypatch.setattr(turns, "BYTES", limits[1])
    rows = sample(150)
    assert repaired(spark, rows) == expected(rows)


def test_steps_hold_the_repaired_rows(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "Well."), (2, 0, "system", "Be."), (2, 1, "assistant", "Ok.")]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA + ", STEP int")
    steps = [(r.conv_id, r.step, r.edit, r.turn, r.role, r.text) for r in turns.repair(df).orderBy("conv_id", "step").collect() if r.step >= 0]
    assert steps[:3] == [(1, 0, "K", 0, "user", "Hi."), (1, 1, "D", 1, None, None), (1, 2, "R", 2, "assistant", "Well.")]
    assert steps[3:] == [(2, 0, "R", 0, "user", "Be."), (2, 1, "K", 1, "assistant", "Ok.")]


def test_long_conversations(spark):
    """A conversation of a third of all rows, and one of long texts."""
    rows = [(0, t, "user" if t % 2 == 0 else "assistant", f"{t} says." + "x" * (t % 7)) for t in range(9001)]
    rows = [(c, t, r, x if x.endswith(".") else x + ".") for c, t, r, x in rows]
    rows += [(c, t, ("user", "assistant")[t], f"{c}{t}!") for c in range(1, 9000) for t in (0, 1)]
    rows += [(-7, t, ("user", "assistant")[t % 2], "long " * 700_000 + f"{t}.") for t in range(4)]
    found = repaired(spark, rows)
    assert found[0][5:7] == (2, "K" * 9000 + "D")
    assert found[-7][5:7] == (0, "KKKK") and found[5][5:7] == (0, "KK") and len(found) == 9001
    text = "\n".join(f"{r}:{x}" for c, t, r, x in rows if c == -7)
    assert found[-7][7] == hashlib.sha256(text.encode()).hexdigest()


def test_damage(spark):
    rows = [(c, t, "assistant", f"A. b! c? {c}") for c in range(40) for t in range(10)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for r in turns.damage(df).collect():
        found.setdefault((r.conv_id, r.turn), []).append((r.role, r.text, r.lost))
    for c, t, role, text in rows:
        what = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        changed = ("user" if what == 4 else role, "" if what == 1 else re.sub("[.!?]", "", text) if what == 2 else text, what == 0)
        assert found[c, t] == [changed] * (2 if what == 3 else 1)


def test_conversations_without_rows_and_empty_table(spark):
    lost = spark.createDataFrame([(3, 0, "user", "x", True), (3, 1, "user", "y", True), (4, 0, "user", "x.", False), (4, 1, "assistant", "y.", None)], SCHEMA + ", lost boolean")
    found = {r[0]: tuple(r)[1:] for r in turns.digests(turns.repair(lost)).collect()}
    assert found[3] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and found[4][6] == "KK"
    empty = spark.createDataFrame([], SCHEMA)
    assert turns.digests(turns.repair(turns.damage(empty))).count() == 0


@pytest.mark.parametrize("seed", range(30))
def test_least_ways_of_any_graph(seed):
    """Graphs where a label may lead to several nodes: the rank decides between them."""
    rng = np.random.default_rng(seed)
    n = 40
    arcs = sorted({(int(v), int(rng.integers(65, 67)), int(v + 1 + rng.integers(0, 4))) for v in range(n - 1) for _ in range(rng.integers(0, 4)) if v < n - 5})
    begin, label, end = (np.array(x, np.int64) for x in zip(*arcs))
    least = {}
    for v in range(n - 1, -1, -1):
        least[v] = min((chr(c) + least[u] for w, c, u in arcs if w == v), default="")
    target, letter = turns.least_ways(n, begin, label, end)
    nodes, length = turns.paths(target, np.arange(n))
    found = "".join(map(chr, letter[nodes]))
    for v, (stop, size) in enumerate(zip(np.cumsum(length), length)):
        assert found[stop - size : stop] == least[v]


def test_query_equals_sql(spark):
    assert not differences(queries.QUERIES["op11_conversation_repair"](spark, SF), oracle(SF), queries.SQL["op11_conversation_repair"])
