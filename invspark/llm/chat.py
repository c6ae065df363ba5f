"""Conversations as training text, with typed content parts.

A message is a list of parts: text, image, audio or document. A visitor turns
each part into text and placeholders, in order, notes which attachment a
placeholder stands for, and how many tokens a model will put in its place.
Messages become ``[ROLE]role[SAYS]content</s>``; a conversation is ``<s>``
followed by its messages.

Control strings inside a text are broken up by a backslash after their first
character (``[\\ROLE]``), and backslashes are doubled, so the template's own
marks are the only ones in the output and every text can be read back.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import running

BEGIN, ROLE, SAYS, END = "<s>", "[ROLE]", "[SAYS]", "</s>"
PLACEHOLDERS = {"image": "[IMG]", "audio": "[AUDIO]", "document": "[DOC]"}
#: Everything a text must not contain as it is: the template's marks, and those that other templates use.
CONTROLS = (BEGIN, END, ROLE, SAYS, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", *PLACEHOLDERS.values())
PART = "struct<kind: string, text: string, ref: string, width: int, height: int, seconds: double, pages: int>"


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in text)


def escaped(text: Column) -> Column:
    """Reversible: no control string is left in the result. Null stays null."""
    opening = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in sorted(set(CONTROLS)))
    return F.regexp_replace(text, rf"\\|{opening}", r"$0\\")


def unescaped(text: Column) -> Column:
    # A backslash was put after the first character of a control string, or after a backslash.
    return F.regexp_replace(text, r"\\(\\?)", "$1")


class Visitor:
    """How each kind of part is written. Each method gives (placeholder or text, tokens it expands to, reference)."""

    #: Pixels along a patch, tokens per second of sound, tokens per page: what a model's encoder makes of an attachment.
    PATCH, RATE, PAGE = 28, 25.0, 256

    def text(self, part: Column) -> tuple[Column, Column, Column]:
        return escaped(F.coalesce(part["text"], F.lit(""))), F.lit(0), F.lit(None).cast("string")

    def image(self, part: Column) -> tuple[Column, Column, Column]:
        along = lambda size: F.ceil(F.greatest(F.coalesce(size, F.lit(1)), F.lit(1)) / self.PATCH)
        return F.lit(PLACEHOLDERS["image"]), along(part["width"]) * along(part["height"]), part["ref"]

    def audio(self, part: Column) -> tuple[Column, Column, Column]:
        seconds = F.greatest(F.coalesce(F.nanvl(part["seconds"], F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
        return F.lit(PLACEHOLDERS["audio"]), F.ceil(seconds * self.RATE), part["ref"]

    def document(self, part: Column) -> tuple[Column, Column, Column]:
        return F.lit(PLACEHOLDERS["document"]), F.greatest(F.coalesce(part["pages"], F.lit(1)), F.lit(1)) * self.PAGE, part["ref"]

    def visit(self, part: Column) -> Column:
        """struct(written, kind, ref, tokens). A part of an unknown or null kind is written as its text."""
        kind = F.coalesce(part["kind"], F.lit("text"))
        written, tokens, ref = self.text(part)
        for name in PLACEHOLDERS:
            w, t, r = getattr(self, name)(part)
            written, tokens, ref = (F.when(kind == name, a).otherwise(b) for a, b in ((w, written), (t, tokens), (r, ref)))
        known = F.when(kind.isin(list(PLACEHOLDERS)), kind).otherwise(F.lit("text"))
        return F.struct(written.alias("written"), known.alias("kind"), ref.alias("ref"), tokens.cast("long").alias("tokens"))


def text_parts(text: Column) -> Column:
    """A plain text as the one part of a message."""
    fields = {"kind": F.lit("text"), "text": text}
    kinds = {"ref": "string", "width": "int", "height": "int", "seconds": "double", "pages": "int"}
    return F.array(F.struct(*[v.alias(k) for k, v in fields.items()], *[F.lit(None).cast(t).alias(k) for k, t in kinds.items()]))


def flatten(messages: DataFrame, parts: str = "parts", visitor: Visitor | None = None) -> DataFrame:
    """Add ``content`` (the parts written in order), ``attachments`` (kind, ref, tokens; in the order of their placeholders) and ``expanded_tokens``.

    Null parts, or a null list of parts, write nothing.
    """
    visitor = visitor or Visitor()
    given = F.filter(F.coalesce(F.col(parts), F.array().cast(f"array<{PART}>")), lambda p: p.isNotNull())
    visited = messages.withColumn("_visited", F.transform(given, visitor.visit))
    return visited.select(
        *[c for c in visited.columns if c not in ("_visited", "content", "attachments", "expanded_tokens")],
        F.array_join(F.transform("_visited", lambda p: p["written"]), "").alias("content"),
        F.transform(
            F.filter("_visited", lambda p: p["kind"] != "text"), lambda p: F.struct(p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))
        ).alias("attachments"),
        F.aggregate("_visited", F.lit(0).cast("long"), lambda n, p: n + p["tokens"]).alias("expanded_tokens"),
    )


def render(messages: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", parts: str = "parts", visitor: Visitor | None = None) -> DataFrame:
    """One row per conversation: ``conv``, ``formatted``, ``loss`` (spans), ``attachments`` and ``expanded_tokens``.

    Messages stand in the order of ``turn`` (nulls first); of equal turns, in that of role and content, so repeated
    rows stay, next to each other. A null role is written as an empty one. ``loss`` lists (start, length) in code
    points, from 0, of what assistants say; a role counts as assistant if it is exactly that. Rows without a
    conversation id form one conversation with a null id. A conversation is one value, so its messages meet in one task.
    """
    told = flatten(messages.select(F.col(conv).alias("_conv"), F.col(turn).alias("_turn"), F.col(role).alias("_role"), F.col(parts).alias("parts")), "parts", visitor)
    head = F.concat(F.lit(ROLE), escaped(F.coalesce("_role", F.lit(""))), F.lit(SAYS))
    lines = F.sort_array(F.collect_list(F.struct(
        F.col("_turn").alias("turn"), F.coalesce("_role", F.lit("")).alias("role"), F.col("content").alias("content"),
        head.alias("head"), F.col("attachments").alias("attachments"), F.col("expanded_tokens").alias("tokens"),
    )))
    size = lambda m: (F.char_length(m["head"]) + F.char_length(m["content"]) + len(END)).cast("long")
    placed = told.groupBy("_conv").agg(lines.alias("_lines")).withColumn("_sizes", F.transform("_lines", size)).withColumn("_at", running("_sizes"))
    said = F.zip_with("_lines", "_at", lambda m, at: F.when(
        m["role"] == "assistant",
        F.struct((at + len(BEGIN) + F.char_length(m["head"])).alias("start"), F.char_length(m["content"]).cast("long").alias("length")),
    ))
    written = F.transform("_lines", lambda m: F.concat(m["head"], m["content"], F.lit(END)))
    return placed.select(
        F.col("_conv").alias(conv),
        F.concat(F.lit(BEGIN), F.array_join(written, "")).alias("formatted"),
        F.filter(said, lambda span: span.isNotNull()).alias("loss"),
        F.flatten(F.transform("_lines", lambda m: m["attachments"])).alias("attachments"),
        F.aggregate("_lines", F.lit(0).cast("long"), lambda n, m: n + m["tokens"]).alias("expanded_tokens"),
    )


def turns(formatted: Column) -> Column:
    """Read an output back: array<struct<role, text>>. Placeholders stay in a text as they are."""
    body = F.substring(formatted, F.lit(len(BEGIN) + 1), F.char_length(formatted))
    lines = F.filter(F.split(body, _quoted(END), -1), lambda x: x != "")
    return F.transform(lines, lambda x: F.struct(
        unescaped(F.substring(F.substring_index(x, SAYS, 1), F.lit(len(ROLE) + 1), F.char_length(x))).alias("role"),
        unescaped(F.substring(x, F.char_length(F.substring_index(x, SAYS, 1)) + len(SAYS) + 1, F.char_length(x))).alias("text"),
    ))


def under_loss(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
