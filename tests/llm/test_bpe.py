"""The transducer against the tokenizer library, and exact round trips."""

import hashlib
import random
import re

import public_tokenizers
import pytest
import regex
import tiktoken

from invspark.llm import bpe, queries

PATH = public_tokenizers.path(queries.VOCABULARY)


@pytest.fixture(scope="module")
def machine():
    return bpe.machines(open(PATH, "rb").read())[0]


@pytest.fixture(scope="module")
def decoder():
    return bpe.machines(open(PATH, "rb").read())[1]


@pytest.fixture(scope="module")
def library(machine):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=machine.ranks, special_tokens={})


SPLIT = regex.compile(public_tokenizers.PATTERN)


def texts():
    rng = random.Random(4)
    alphabet = "aábc  \n\t1239.,!?'s日本🙂é0xAKIA=-_\x00ß<|endoftext|>"
    some = ["", " ", "<|endoftext|>", "don't we'll I'd", "  \n\n  x", "\x00" * 40]
    some += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 80))) for _ in range(500)]
    some += ["a" * 3000, " " * 3000, "=" * 999, "🙂" * 400, "ab" * 2000, "".join(rng.choice("abcdefgh") for _ in range(5000)), "".join(rng.choice("abcdefgh") for _ in range(64))]
    return some


def test_encode_equals_library(machine, library):
    for text in texts():
        assert bpe.encode_text(machine, SPLIT, text).tolist() == library.encode_ordinary(text), text[:40]


def test_small_bounds_change_nothing(machine, library, monkeypatch):
    for name, bound in (("MAX_STATES", 50), ("MAX_PAIRS", 50), ("MAX_PIECES", 20)):
        monkeypatch.setattr(bpe, name, bound)
    small = bpe.Transducer(machine.ranks)
    for text in texts()[:300]:
        assert bpe.encode_text(small, SPLIT, text).tolist() == library.encode_ordinary(text), text[:40]


def test_latin_texts_are_split_alike():
    """The spelled-out classes are those of the properties, for all characters that choose them."""
    split, rng = bpe.Splitter(public_tokenizers.PATTERN), random.Random(3)
    assert split.latin is not None and bpe.Splitter(r"(?i:'s)|\p{L}+").latin is None and bpe.Splitter(r"\w+|\p{Lu}").latin is None
    for c in map(chr, range(0x0250)):
        if bpe.LATIN.fullmatch(c):
            for pattern, chars in ((r"\p{L}", f"[{bpe.LETTERS}]"), (r"\p{N}", "[0-9]"), (r"\s", f"[{bpe.SPACES}]")):
                assert bool(regex.match(pattern, c)) == bool(re.match(chars, c)), hex(ord(c))
    alphabet = [chr(c) for c in range(1, 0x0260)] + list(" \n\t's'll  ") * 30
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        latin = "".join(c for c in text if bpe.LATIN.fullmatch(c))
        for some in (text, latin, latin.lower() + "  \n x"):
            assert split.findall(some) == SPLIT.findall(some), some


def test_short_pieces_are_read_through_determinised_arcs(machine):
    """Every byte of them by an arc, most of which earlier pieces have made; a text read again makes none."""
    fresh = bpe.Transducer(machine.ranks)
    rng = random.Random(11)
    syllables = ["ti", "on", "er", "schw", "ün", "pa", "lle", "que", "th", "ing", "re", "ab"]
    pieces = {" " + "".join(rng.choice(syllables) for _ in range(rng.randint(2, 6))) for _ in range(8000)}
    unknown = [p.encode() for p in pieces if p.encode() not in machine.ranks]
    for piece in unknown:
        fresh.encode(piece)
    assert fresh.arcs_read == sum(map(len, unknown)) and fresh.arcs_made < fresh.arcs_read / 6
    made = fresh.arcs_made
    for piece in unknown:
        fresh.encode(piece)
    assert fresh.arcs_made == made


def test_other_vocabularies():
    ranks = bpe.read_ranks(open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb").read())
    other = bpe.Transducer(ranks)
    library = tiktoken.Encoding("other", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for text in texts()[:200]:
        assert bpe.encode_text(other, SPLIT, text).tolist() == library.encode_ordinary(text), text[:40]


def test_tokens_are_emitted_before_the_piece_ends(machine):
    taken = 0

    def piece():
        nonlocal taken
        for byte in b"the" * 2000:
            taken += 1
            yield byte

    stream, most, ids = machine.read(piece()), 0, 0
    for token in stream:
        ids += len(machine.bytes[token])
        most = max(most, taken - ids)
    assert ids == 6000 and most <= 2 * max(map(len, machine.ranks))


def test_streaming_decode(decoder):
    rng = random.Random(5)
    for _ in range(500):
        ids = [rng.randrange(50_256) for _ in range(rng.randint(0, 30))]
        data = b"".join(decoder.tokens[i] for i in ids)
        decoder.restart()
        pieces = [decoder.feed(i) for i in ids]
        assert "".join(pieces) + decoder.end() == data.decode("utf-8", "replace") == decoder.text(ids)
    emoji = [decoder_id for byte in "🙂".encode() for decoder_id, token in decoder.tokens.items() if token == bytes([byte])]
    decoder.restart()
    assert [decoder.feed(i) for i in emoji] == ["", "", "", "🙂"]


def test_frames(spark, library):
    rows = [(1, "héllo wörld", "x", 3), (1, "héllo wörld", "x", 3), (None, None, None, None), (2, "", "y", 1), (3, "word " * 50_000, "z", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, IDS string, n int")
    both = bpe.decode(bpe.encode(docs, PATH, public_tokenizers.PATTERN), PATH)
    assert both.columns == ["doc_id", "n", "ids", "decoded"]
    found = both.collect()
    assert len(found) == len(rows)
    for row in found:
        text = next(t or "" for i, t, _, _ in rows if i == row.doc_id)
        assert row.ids == library.encode_ordinary(text) and row.decoded == text
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(empty, PATH, public_tokenizers.PATTERN), PATH).count() == 0
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(nulls, PATH).collect()] == ["", ""]
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([([50_256],)], "ids array<int>"), PATH).collect()


def test_query_equals_library(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.QUERIES["op1_byte_level_bpe"](spark, sf).collect()
    assert len(rows) == len(docs)
    for row in rows:
        ids = library.encode_ordinary(docs[row.doc_id])
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(docs[row.doc_id].encode()).hexdigest()
