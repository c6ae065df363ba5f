"""Registered queries, one per operator, each with production parameters over whole tables.

``QUERIES`` maps a name to ``fn(spark, sf_dir)``; ``SQL`` holds DuckDB SQL where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat, lines, mixing, negatives, pii, quality, secrets, shards, simhash, turns, vafile, warc
from .common import folder_uri, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add


@query("op10_quality_rules", r"""
WITH d AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
    FROM documents),
g AS (SELECT rid, p, list_slice(w, p, p + 4) AS gram FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS p FROM d WHERE len(w) >= 5)),
twice AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
covered AS (SELECT rid, sum(n)::BIGINT AS n FROM (
    SELECT rid, least(5, p - coalesce(lag(p) OVER (PARTITION BY rid ORDER BY p), -5)) AS n FROM twice) GROUP BY rid),
m AS (
    SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
        length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals,
        len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutters
    FROM d LEFT JOIN covered USING (rid)),
f AS (SELECT *,
        (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT + 4 * (100 * n_symbols > 10 * n_words)::BIGINT
        + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 16 * (100 * n_capitals > 50 * word_chars)::BIGINT
        + 32 * (100 * n_stutters > 20 * n_words)::BIGINT + 64 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::BIGINT AS failed
    FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
    n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
    (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed::BIGINT AS failed
FROM f""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger of every document, and the verdict of the current policy."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    base = F.col("failed").bitwiseAND(F.lit(quality.BASE).cast("long")) != 0
    return quality.ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & quality.passes()).alias("kept"), "failed",
    )


VOCABULARY = "byte_bpe_50k.tiktoken"


def encoded(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query("op1_byte_level_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document to ids and back. No SQL: merges are iterative; the tests hold it against the library."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(encoded(spark, docs), public_tokenizers.path(VOCABULARY))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query("op5_simhash_near_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and class of every document. No SQL: DuckDB has no XXH64 with a seed; tested against all pairs."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    printed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return simhash.classes(docs).select("doc_id", printed.alias("fingerprint"), "component_id")


@query("op9_exact_top_k", """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.e) = len(q.e) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of all rows for every row whose id is divisible by 50."""
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vafile.top_k(vectors, vectors.filter("vec_id % 50 = 0"))


@query("op2_warc", """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b)::BIGINT AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id > first OR (page_id IS NULL AND first IS NOT NULL) THEN first END AS refers_to
FROM f""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page to an archive and back, digests verified by the reader."""
    archives = warc.write(read(spark, sf_dir, "pages"), folder_uri(spark, "warc"))
    found = warc.read(archives, keep_payload=False)
    # A damaged record must not pass for a missing one.
    sound = F.when(F.col("error").isNull(), F.col("id")).otherwise(F.raise_error(F.col("error")).cast("long"))
    return found.select(sound.alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op3_chat_formatting", r"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
    SELECT *, regexp_replace(text, '(\\|<s>|</s>|\[ROLE\]|\[SAYS\]|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|\[IMG\]|\[AUDIO\]|\[DOC\])', '#\1', 'g') AS t FROM c),
g AS (
    SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
        (3 + sum(length(role) + length(t) + 16))::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings only, formatted and read back. Each text is a message of one part."""
    said = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(
        F.lit(-1).cast("long"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(control)
    )
    messages = said.union(added).select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts"))
    read_back = chat.render(messages).select(
        "conv_id", "formatted", "expanded_tokens",
        chat.turns(F.col("formatted")).alias("turns"), chat.under_loss(F.col("formatted"), F.col("loss")).alias("said"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("said").cast("long").alias("loss_chars"), F.sha2(F.col("said").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def joined(spans: str):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


@query("op8_secret_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known forms and random strings in every document. No SQL: sliding windows; tested against brute force."""
    found = secrets.scan(read(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(form.kind) for form in secrets.FORMS], F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


#: Stands in for the secret a deployment would pass.
PII_KEY = "sample key of the registered queries"


@query("op7_pii_surrogates")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates. No SQL: keyed permutations; tested for form, distinctness and coreference."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY).select("doc_id", "text", F.size("surrogates").cast("long").alias("n_entities"), "surrogates")


#: The hot source is held to an eighth, the languages are moved towards each other, contact pages are halved.
MIX = mixing.Targets(
    source={"src0": 0.125} | {f"src{i}": 0.875 / 19 for i in range(1, 20)},
    lang={"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15},
    topic={"contact": 0.02, "licence": 0.02, "figures": 0.04, "prose": 0.92},
    topics=(("contact", r"@\w|\+\d|\(\d{3}\)"), ("licence", r"(?i)licen[cs]e|copyright"), ("figures", r"\d"), ("prose", r"\S")),
)
MIX_RATE = 0.8
MIX_KEY = "mix"


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, chance and draw of every document. No SQL: fitting is iterative; tested against a plain version."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    return mixing.mix(docs, MIX, MIX_RATE, MIX_KEY).drop("text")


#: Byte-level ids: a text's UTF-8 bytes; 0xFF and 0xFE occur in none, so they can end documents and pad.
SHARD_KEY = b"training order"
SHARD = shards.Layout(length=2048, dtype="u1", end=0xFF, pad=0xFE, per_shard=8192)


@query("op6_training_order")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sequence as read back from the shards. No SQL: a keyed permutation; tested by an exact round trip."""
    docs = read(spark, sf_dir, "documents").select(F.col("text").cast("binary").alias("ids"))
    written = shards.write(docs, folder_uri(spark, "shards"), SHARD_KEY, SHARD)
    return shards.read(written).select("slot", "index", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"))


@query("op12_line_dedup", """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
u AS (SELECT rid, doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM u),
g AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key
    HAVING count(DISTINCT doc_id) + (count(*) > count(doc_id))::BIGINT >= 3),
m AS (SELECT k.*, g.key IS NOT NULL AND doc_id IS DISTINCT FROM top AS gone FROM k LEFT JOIN g USING (key))
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid, doc_id""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that others repeat."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op13_hard_negatives", """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid, a.vec_id AS anchor_id, c.vec_id, c.label = a.label AS same, list_dot_product(a.e, c.e)::BIGINT AS score
    FROM v a JOIN v c ON c.vec_id <> a.vec_id AND len(c.e) = len(a.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT rid, anchor_id, vec_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS place FROM s WHERE same),
r AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.rid, p.place ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
    FROM p JOIN s ON s.rid = p.rid AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every row whose id is divisible by 50; labels are first moved for every seventh id."""
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END").alias("label")
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved)
    return negatives.mine(vectors, "vec_id % 50 = 0")


def _way(edit: str, cost: str, way: str, line: str | None = None) -> str:
    """SQL of one edit before a way of finishing.

    A way is text: a cost of 12 digits, an audit, chr(1), the repaired rows. So the least text is the least cost, then the least audit.
    """
    rest = f"substr({way}, 13)"
    body = f"substr({rest}, instr({rest}, chr(1)) + 1)"
    joined = f"{line} || CASE WHEN {body} = '' THEN '' ELSE chr(10) || {body} END" if line else body
    return f"(printf('%012d', substr({way}, 1, 12)::BIGINT + {cost}) || '{edit}' || substr({rest}, 1, instr({rest}, chr(1)) - 1) || chr(1) || {joined})"


def _ways() -> str:
    """The least way from each place in the pattern whose next edit reads a row, given those behind the row."""
    fit, more, out = "fault NOT IN ('blank', 'duplicate')", "(CASE fault WHEN 'truncated' THEN 5 ELSE 0 END)", []
    for place, (to, role, keeps) in enumerate([(2, "user", {"s": 1, "u": 2}), (2, "user", {"u": 2}), (3, "assistant", {"a": 3}), (2, "user", {"u": 2})]):
        ways = [f"CASE WHEN {fit} AND substr(role, 1, 1) = '{c}' THEN {_way('K', more, f'w{q}', 'line')} END" for c, q in keeps.items()]
        changed = f"('{role}:' || text)"
        ways.append(f"CASE WHEN {fit} THEN {_way('R', '1 + ' + more, f'w{to}', changed)} END")
        ways.append(_way("D", "2", f"w{place}"))
        out.append(f"least({', '.join(ways)}) AS x{place}")
    return ", ".join(out)


def _inserted() -> str:
    """The least way from each place, inserts first; ``x`` are those whose next edit reads a row."""
    to_a, to_u = _way("I", "5", "x3", "'assistant:'"), _way("I", "5", "x2", "'user:'")
    from_start = _way("I", "5", f"least(x2, {to_a})", "'user:'")
    return f"least(x0, {from_start}) AS w0, least(x1, {from_start}) AS w1, least(x2, {to_a}) AS w2, least(x3, {to_u}) AS w3"


ENDED = "printf('%012d', 0) || chr(1)"


@query("op11_conversation_repair", rf"""
WITH RECURSIVE r AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT),
            lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT) % 20 AS what
    FROM conversations),
d AS (
    SELECT conv_id, turn, CASE what WHEN 4 THEN 'user' ELSE role END AS role,
        CASE what WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM r, range(2) t(copy) WHERE what <> 0 AND (copy = 0 OR what = 3)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM d),
f AS (
    SELECT *, role || ':' || text AS line, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
        coalesce(lag(substr(role, 1, 1)) OVER w || substr(role, 1, 1) NOT IN ('su', 'ua', 'au'), false) AS illegal
    FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
c AS (SELECT DISTINCT conv_id FROM conversations),
g AS (
    SELECT conv_id, max(n) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, (count(*) FILTER (fault = 'blank'))::BIGINT AS blank,
        (count(*) FILTER (fault = 'duplicate'))::BIGINT AS duplicate, (count(*) FILTER (fault = 'truncated'))::BIGINT AS truncated, (count(*) FILTER (illegal))::BIGINT AS illegal
    FROM f GROUP BY conv_id),
w AS (
    SELECT conv_id, n, {_inserted()} FROM (SELECT conv_id, n_rows + 1 AS n, {ENDED} AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, {ENDED} AS x3 FROM g)
    UNION ALL
    SELECT conv_id, n, {_inserted()} FROM (SELECT w.conv_id, f.n, {_ways()} FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.n - 1))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(substr(w0, 1, 12)::BIGINT, 0) AS cost, coalesce(substr(w0, 13, instr(w0, chr(1)) - 13), '') AS audit,
    sha256(coalesce(substr(w0, instr(w0, chr(1)) + 1), '')) AS repaired_sha256
FROM c LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.n = 1""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired at least cost."""
    return turns.digests(turns.repair(turns.damage(read(spark, sf_dir, "conversations"))))
