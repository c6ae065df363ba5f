"""Null tokens, casts and checksums."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

NULL_TOKENS = ("n/a", "")


def null_if_token(text) -> Column:
    return F.when(~text.isin(*NULL_TOKENS), text)


def count_or_zero(text) -> Column:
    """A count that may be ``n/a`` or empty, as a long."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0).cast("long"))


def literal_or_text(text, as_type: str) -> Column:
    """The value of a literal of the declared type, printed; the text itself when it is not one."""
    return F.coalesce(text.try_cast(as_type).cast("string"), text)


def md5_hex(content) -> Column:
    return F.md5(content)


def is_segmented(etag) -> Column:
    return F.contains(etag, F.lit("-"))


def segment_count(etag) -> Column:
    """How many segments an object was sent in, by its etag: 1 for a plain checksum."""
    count = F.regexp_extract(etag, "-([0-9]+)$", 1).try_cast("bigint")
    return F.when(is_segmented(etag), count).otherwise(F.lit(1).cast("long"))


def joined_etag(digests, count) -> Column:
    """The two-level checksum of an object from the hex MD5s of its segments, an array in order: MD5 of the joined digests, and their number; that of a single segment is the checksum itself."""
    whole = F.concat(F.md5(F.unhex(F.array_join(digests, ""))), F.lit("-"), count.cast("string"))
    return F.when(count == 1, F.element_at(digests, 1)).otherwise(whole)


def segmented_etag(content, segment: int) -> Column:
    """The same for a binary cell that is cut every ``segment`` bytes."""
    size = F.octet_length(content)
    last = F.greatest(F.ceil(size / F.lit(segment)), F.lit(1)).cast("long") - 1
    digests = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.md5(F.substring(content, (i * segment + 1).cast("int"), F.lit(segment))))
    return joined_etag(digests, last + 1)


def clamp(value, low, high) -> Column:
    return F.greatest(F.lit(low), F.least(value, F.lit(high)))
