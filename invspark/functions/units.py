"""Sizes, rates and fixed-point scaling."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MIB = 1024**2
GIB = 1024**3
TIB = 1024**4


def mib(size) -> Column:
    return size / F.lit(float(MIB))


def gib(size) -> Column:
    return size / F.lit(float(GIB))


def tib(size) -> Column:
    return size / F.lit(float(TIB))


def ratio(top, bottom, empty=None) -> Column:
    """Division with a null (or ``empty``) result for a zero divisor."""
    value = F.when(bottom != 0, top.cast("double") / bottom.cast("double"))
    return value if empty is None else F.coalesce(value, F.lit(empty))


def gibit_rate(size, seconds) -> Column:
    """Gibit/s of one transfer; null when it took no time."""
    return F.when(seconds != 0, size.cast("double") * 8 / float(GIB) / seconds)


def milli_rate(size, micros) -> Column:
    """Rate in thousandths of a byte per second as an exact long.

    Fixed point makes running sums order-free: when the last transfer ends
    the total is exactly zero, however the rows were partitioned.
    """
    exact = size.cast("decimal(20,0)") * F.lit(1_000_000_000).cast("decimal(10,0)")
    return F.when(micros > 0, F.round(exact.cast("double") / micros.cast("double")).cast("long"))


def fixed(value, digits: int = 6) -> Column:
    """A double as a long with ``digits`` decimal places."""
    return F.round(value * F.lit(float(10**digits))).cast("long")
