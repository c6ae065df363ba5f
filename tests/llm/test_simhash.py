"""Fingerprints and classes against all pairs; near copies at 0.8 against exact similarities."""

import collections
import random

import numpy as np
import pytest
import xxhash

from invspark.llm import queries, similar, simhash


def plain(text, width=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, ids, radius=2):
    distinct = sorted(set(prints))
    parent = {p: p for p in distinct}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for p, d in zip(prints, ids):
        if d is not None:
            least[root(p)] = min(least.get(root(p), d), d)
    return [least.get(root(p)) for p in prints]


TEXTS = [None, "", " \n", "one", "one two", "ONE two", "One Two Three four", "ä Ä", "a b c d e f g h i j k", "a\x0bb\x0cc\td", "x " * 50_000, "\xa0 y"]


def test_fingerprint_equals_plain_version(monkeypatch):
    monkeypatch.setattr(simhash, "STEP", 7)
    rng = random.Random(9)
    for text in TEXTS[:10] + [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(0, 60))) for _ in range(100)]:
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain(text)
        lanes = similar.fingerprint(text, 3)
        assert int(lanes[0]) & (1 << 64) - 1 == plain(text)


@pytest.mark.parametrize("bits, n", [(3, 8), (8, 120), (16, 500), (40, 300)])
def test_links_equal_all_pairs(monkeypatch, bits, n):
    monkeypatch.setattr(simhash, "PAIRS", 300)
    rng = np.random.default_rng(bits)
    members = np.unique(rng.integers(0, 1 << bits, n, dtype=np.uint64) | np.uint64(1 << 63))
    first, second = simhash.links(members, simhash.pivots())
    found = {(min(a, b), max(a, b)) for a, b in zip(first.tolist(), second.tolist())}
    assert len(found) == len(first)
    assert found == {(i, j) for i in range(len(members)) for j in range(i + 1, len(members)) if (int(members[i]) ^ int(members[j])).bit_count() <= 2}


def test_classes_equal_all_pairs(spark):
    """Fingerprints in dense clouds, chains and alone; through the views, the groups and the components."""
    rng = random.Random(10)
    prints = [rng.getrandbits(64) for _ in range(300)]
    for base in prints[:6]:
        for _ in range(60):
            value = base
            for _ in range(rng.randint(1, 4)):
                value ^= 1 << rng.randrange(64)
            prints.append(value)
    chain = rng.getrandbits(64)
    for i in range(40):  # each link two bits further
        chain ^= (1 << (i * 3 % 64)) | (1 << ((i * 3 + 1) % 64))
        prints.append(chain)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed + signed[:50]], "fingerprint long").repartition(3)
    home = {r.fingerprint: r.root for r in simhash.homes(df).collect()}
    groups = collections.defaultdict(set)
    for p in signed:
        groups[home[p]].add(p & (1 << 64) - 1)
    want = collections.defaultdict(set)
    for p, c in zip(prints, classes(prints, range(len(prints)))):
        want[c].add(p)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_edges(spark):
    rows = [(i, t, "c") for i, t in enumerate(TEXTS)] + [(3, "one", "again"), (None, "one", None), (None, "nobody's words at all", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Fingerprint string")
    found = simhash.classes(docs).collect()
    assert len(found) == len(rows)
    want = classes([plain(t) for _, t, _ in rows], [i for i, _, _ in rows])
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == sorted((str(i), str(c)) for (i, _, _), c in zip(rows, want))
    for keep in (simhash.keep_one, similar.keep_one):
        kept = keep(docs)
        assert kept.columns == docs.columns
        texts = [r.text for r in kept.collect()]
        assert sum(not (t or "").split() for t in texts) == 1 and texts.count("one") == 1 and sum((t or "").lower() == "one two" for t in texts) == 1
        assert next(r.doc_id for r in kept.collect() if r.text == "one") == 3
        assert keep(spark.createDataFrame([], docs.schema)).count() == 0
    assert simhash.classes(spark.createDataFrame([], docs.schema)).count() == 0


def test_query_equals_all_pairs(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.QUERIES["op5_simhash_near_dedup"](spark, sf).collect()}
    prints = [plain(t) for _, t in docs]
    assert found == {i: (f"{p:016x}", c) for (i, _), p, c in zip(docs, prints, classes(prints, [i for i, _ in docs]))}


def edited(rng, words, share):
    return [rng.choice(VOCABULARY) if rng.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(5000)]


def jaccard(a, b, width=5):
    a, b = ({tuple(x[i : i + width]) for i in range(len(x) - width + 1)} for x in (a, b))
    return len(a & b) / len(a | b)


def test_near_copies_at_the_threshold(spark):
    """Pairs of a Jaccard similarity of 0.8 and more meet (recall above 0.9), unrelated texts do not."""
    rng = random.Random(11)
    docs, pairs = [], []
    for _ in range(400):
        words = [rng.choice(VOCABULARY) for _ in range(rng.randint(80, 400))]
        copy = edited(rng, words, rng.uniform(0.005, 0.03))
        docs += [words, copy]
        pairs.append(jaccard(words, copy))
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string")
    kept = {r.doc_id for r in similar.keep_one(df).collect()}
    assert {i for i in range(0, 800, 2)} <= kept
    near = [place for place, j in enumerate(pairs) if j >= 0.8]
    caught = [place for place in near if 2 * place + 1 not in kept]
    assert len(near) > 100 and len(caught) > 0.93 * len(near)


def test_hot_group_of_near_copies(spark):
    """Many variants of one text end as one document, and links stay few."""
    rng = random.Random(12)
    words = [rng.choice(VOCABULARY) for _ in range(300)]
    docs = [edited(rng, words, 0.01) for _ in range(1500)] + [[rng.choice(VOCABULARY) for _ in range(200)] for _ in range(300)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(docs)], "doc_id long, text string").repartition(6)
    kept = sorted(r.doc_id for r in similar.keep_one(df).collect())
    assert kept[0] == 0 and kept[-300:] == list(range(1500, 1800)) and len(kept) <= 303


def flipped(rng, fingerprint, bits):
    out = fingerprint.copy()
    for bit in rng.choice(similar.BITS, bits, replace=False).tolist():
        out[bit // 64] ^= np.uint64(1 << bit % 64)
    return out


def linked(spark, prints):
    """Classes of 256-bit fingerprints (node: their place) over ``similar.links``."""
    rows = [(i, *(int(x) for x in p.view(np.int64))) for i, p in enumerate(prints)]
    nodes = spark.createDataFrame(rows, "node long, " + ", ".join(f"{n} long" for n in similar.NAMES)).repartition(5)
    edges = [(r.a, r.b) for r in similar.links(nodes).collect()]
    return simhash.roots(len(prints), np.array([a for a, _ in edges], int), np.array([b for _, b in edges], int))


def test_wide_links_of_hot_groups_equal_all_pairs(spark):
    """Members that are near a chain of others, not one reference, are connected, whatever the size of the group."""
    rng = np.random.default_rng(13)
    centre = rng.integers(0, 1 << 64, similar.LANES, dtype=np.uint64)
    spokes = [flipped(rng, centre, 40) for _ in range(60)]
    prints = np.array(spokes + [flipped(rng, spokes[i % 60], 34) for i in range(600)] + [flipped(rng, centre, 3) for _ in range(3)])
    first, second = np.nonzero(similar.distances(prints[:, None], prints[None]) <= 51)
    assert linked(spark, prints) == simhash.roots(len(prints), first, second)


def test_runs_of_any_size_connect_all_pairs():
    rng = np.random.default_rng(14)
    for size in (2, 16, 17, 150):
        for far in (35, 45, 60):
            centre = rng.integers(0, 1 << 64, similar.LANES, dtype=np.uint64)
            prints = np.array([flipped(rng, centre, int(rng.integers(5, far))) for _ in range(size)])
            # One run in every pair of bytes, so that all pairs count.
            label = similar.sweep(prints, np.arange(size), 51)
            first, second = np.nonzero(similar.distances(prints[:, None], prints[None]) <= 51)
            want = simhash.roots(size, first, second)
            assert len(set(zip(label.tolist(), want))) == len(set(want)) == len(set(label.tolist()))


def test_pivot_tables_discard_far_pairs_only(monkeypatch):
    """Of two clouds in one run, pairs across them are discarded before their bits are counted; near pairs never are."""
    rng = np.random.default_rng(16)
    centres = rng.integers(0, 1 << 64, (2, similar.LANES), dtype=np.uint64)
    for size in (12, 60):
        prints = np.array([flipped(rng, centres[i % 2], 30) for i in range(size)])
        first, second = np.triu_indices(size, 1)
        near = similar.distances(prints[first], prints[second]) <= 51
        kept = similar.within(similar.pivot_table(prints), first, second, 51)
        assert kept[near].all() and not kept[(first + second) % 2 == 1].any()
        verified, count = [], similar.distances
        monkeypatch.setattr(similar, "distances", lambda a, b: verified.append((a, b)) or count(a, b))
        label = similar.connect(np.zeros(size, np.int64), prints, 51)
        monkeypatch.undo()
        want = simhash.roots(size, first[near], second[near])
        assert all(want[a] == want[b] for a, b in enumerate(label.tolist()))
        pairs = [(a, b) for a, b in verified if a.ndim == b.ndim == 2 and len(a) != size]
        across = [np.bitwise_count((a ^ b)).sum(axis=-1) > 51 + 60 for a, b in pairs]
        assert not np.concatenate([np.zeros(1, bool), *across]).any()


def test_pairs_at_the_radius_meet(spark):
    """Pairs exactly 51 bits apart, and none of 52."""
    rng = np.random.default_rng(15)
    ones = rng.integers(0, 1 << 64, (1000, similar.LANES), dtype=np.uint64)
    prints = np.concatenate([ones, [flipped(rng, p, 51 if i < 900 else 52) for i, p in enumerate(ones)]])
    home = linked(spark, prints)
    assert sum(home[1000 + i] == i for i in range(900)) >= 0.995 * 900
    assert all(home[1000 + i] == 1000 + i for i in range(900, 1000))
