"""Timestamps and durations as microseconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

STAMP = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def parse_stamp(text) -> Column:
    """Timestamp with an optional fraction; null when the text is not one."""
    return F.try_to_timestamp(text, F.lit(STAMP))


def micros(stamp) -> Column:
    return F.unix_micros(stamp.cast("timestamp"))


def duration_us(text) -> Column:
    """``H:MM:SS.ffffff`` as microseconds; null when the text is not a duration."""
    part = lambda i: F.regexp_extract(text, r"^([0-9]+):([0-9]{1,2}):([0-9]{1,2})(?:[.]([0-9]{1,6}))?$", i)
    whole = (part(1).cast("long") * 3600 + part(2).cast("long") * 60 + part(3).cast("long")) * 1_000_000
    fraction = F.rpad(part(4), 6, "0").cast("long")
    return F.when(F.rlike(text, F.lit(r"^[0-9]+:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,6})?$")), whole + fraction)
