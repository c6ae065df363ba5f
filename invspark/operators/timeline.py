"""Transfer rates and concurrency over time.

Times are long microseconds and rates exact longs (thousandths of a byte per
second), so running sums neither drift nor depend on row order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import units
from . import ordered


def overlap(transfers: DataFrame, keys: Sequence[str], order: str = "ord", start: str = "start_us", end: str = "end_us", narrow: bool = False) -> DataFrame:
    """Flag rows that start before the previous row of their run ended; the first row is False. ``narrow``: see ``ordered.scan``."""
    seen = ordered.scan(transfers, keys, order, previous={"_end": F.col(end)}, narrow=narrow)
    return seen.withColumn("overlap", F.coalesce(F.col("_end") > F.col(start), F.lit(False))).drop("_end")


def moments(transfers: DataFrame, keys: Sequence[str], start: str = "start_us", end: str = "end_us", rate: str = "rate", extra: Sequence[Column] = ()) -> DataFrame:
    """Two rows per transfer with a positive rate: +rate at its start, -rate at its end."""
    active = transfers.filter(F.col(rate) > 0)
    ends = F.array(
        F.struct(F.col(start).alias("t"), F.col(rate).alias("delta"), F.lit(1).cast("long").alias("step")),
        F.struct(F.col(end).alias("t"), (-F.col(rate)).alias("delta"), F.lit(-1).cast("long").alias("step")),
    )
    return active.select(*keys, *extra, F.explode(ends).alias("_m")).select(*keys, *[c for c in active.select(*extra).columns], "_m.*")


def levels(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rate and concurrency from each moment ``t`` until ``next_t``; input has one row per keys and t."""
    run = ordered.scan(
        changes, keys, "t",
        sums={"_rate": F.col("delta"), "_level": F.col("step")}, following={"next_t": F.col("t")},
        shifts=ordered.MICROS, narrow=True,
    )
    return run.withColumns({"rate": F.col("_rate") + F.col("delta"), "concurrency": F.col("_level") + F.col("step")}).drop("_rate", "_level")


def level_curve(transfers: DataFrame, keys: Sequence[str], **columns) -> DataFrame:
    """(keys, t, next_t, rate, concurrency): the state after everything that happened at ``t``."""
    changes = moments(transfers, keys, **columns).groupBy(*keys, "t").agg(F.sum("delta").alias("delta"), F.sum("step").alias("step"))
    return levels(changes, keys).select(*keys, "t", "next_t", "rate", "concurrency")


def step_curve(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Segments (from_t, to_t, rate), led by an empty one at rate 0; the last has no end."""
    lead = curve.groupBy(*keys).agg(F.min("t").alias("from_t"))
    zero = lead.select(*keys, "from_t", F.col("from_t").alias("to_t"), F.lit(0).cast("long").alias("rate"))
    return zero.unionByName(curve.select(*keys, F.col("t").alias("from_t"), F.col("next_t").alias("to_t"), "rate"))


def _moved(rate: Column, micros: Column) -> Column:
    return F.coalesce(F.sum(rate.cast("decimal(20,0)") * micros.cast("decimal(18,0)")), F.lit(0))


def integral(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MiB moved (area under the rate curve), span in seconds and mean MiB/s per ``keys``."""
    area = curve.groupBy(*keys).agg(
        _moved(F.col("rate"), F.col("next_t") - F.col("t")).alias("_area"),
        (F.max("t") - F.min("t")).alias("_span"),
    )
    mib = F.col("_area").cast("double") / 1e9 / units.MIB
    seconds = F.col("_span") / 1e6
    return area.select(*keys, mib.alias("mib"), seconds.alias("span_s"), units.ratio(mib, seconds, 0.0).alias("mib_s"))


def opening_flag_integral(transfers: DataFrame, flag: str, order: str = "ord", **columns) -> DataFrame:
    """Area under the total curve, each interval credited to the flag of the event that opened it.

    Events at the same time are taken in the order (starts with the highest
    rate first, then ``order``); the last one opens the interval.
    """
    each = moments(transfers, [], extra=[F.col(flag).alias("flag"), F.col(order).alias("o")], **columns)
    changes = each.groupBy("t").agg(
        F.sum("delta").alias("delta"), F.sum("step").alias("step"),
        F.max_by("flag", F.struct(-F.col("delta"), F.col("o"))).alias("flag"),
    )
    return levels(changes, []).groupBy(F.col("flag").alias(flag)).agg(
        (_moved(F.col("rate"), F.col("next_t") - F.col("t")).cast("double") / 1e9 / units.MIB).alias("mib")
    )


def smoothed(curve: DataFrame, keys: Sequence[str], span_us: int = 3_600_000_000) -> DataFrame:
    """Mean of the curve's rate over its moments in ``(t - span, t]``."""
    return ordered.rolling_span(curve, keys, "t", F.col("rate"), span_us, "smoothed")


def concurrency_levels(curve: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per concurrency level: how many moments reached it, and for how long it held."""
    return curve.groupBy(*keys, "concurrency").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.coalesce(F.sum(F.col("next_t") - F.col("t")), F.lit(0)).alias("held_us"),
    )


def grid(transfers: DataFrame, step_us: int, start: str = "start_us", end: str = "end_us", rate: str = "rate") -> DataFrame:
    """Total rate and concurrency at every tick from the first start on; both ends of a transfer count.

    A transfer covers a range of tick numbers, so it is two changes to a
    running sum; the work does not grow with how long transfers last.
    """
    ends = transfers.agg(F.min(start).alias("first"), F.max(end).alias("last"))
    origin = ends.select("first").scalar()
    last_tick = ends.select(F.call_function("div", F.col("last") - F.col("first"), F.lit(step_us))).scalar()
    enter = F.ceil((F.col(start) - origin) / F.lit(step_us)).cast("long")
    leave = F.call_function("div", F.col(end) - origin, F.lit(step_us)) + 1
    changes = F.array(
        F.struct(enter.alias("tick"), F.col(rate).alias("delta"), F.lit(1).cast("long").alias("step")),
        F.struct(leave.alias("tick"), (-F.col(rate)).alias("delta"), F.lit(-1).cast("long").alias("step")),
    )
    known = transfers.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
    moves = (
        known.withColumn(rate, F.coalesce(rate, F.lit(0).cast("long")))
        .select(enter.alias("_in"), leave.alias("_out"), F.explode(changes).alias("_m"))
        .filter(F.col("_in") < F.col("_out"))
        .select("_m.*")
    )
    # Tick numbers in two steps, so that no long array is built in one row.
    block = 4096
    ticks = (
        ends.select(F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("last") - F.col("first"), F.lit(step_us * block)))).alias("_k"))
        .repartition("_k")
        .select(F.explode(F.sequence(F.col("_k") * block, F.col("_k") * block + (block - 1))).alias("tick"))
        .filter(F.col("tick") <= last_tick)
        .select("tick", F.lit(0).cast("long").alias("delta"), F.lit(0).cast("long").alias("step"))
    )
    summed = moves.filter(F.col("tick") <= last_tick).unionByName(ticks).groupBy("tick").agg(F.sum("delta").alias("delta"), F.sum("step").alias("step"))
    run = ordered.scan(summed, [], "tick", sums={"_r": F.col("delta"), "_c": F.col("step")}, shifts=(16,), narrow=True)
    return run.select(
        "tick",
        (origin + F.col("tick") * step_us).alias("t"),
        (F.col("_r") + F.col("delta")).alias("rate"),
        (F.col("_c") + F.col("step")).alias("concurrency"),
    )


def per_process(samples: DataFrame, least: float = 1.0) -> DataFrame:
    """Gibit/s in total and per running transfer at each tick; samples below ``least`` are masked."""
    total = F.col("rate") / 1000.0 * 8 / units.GIB
    each = F.when(F.col("concurrency") > 0, total / F.col("concurrency")).otherwise(0.0)
    shown = total >= least
    return samples.select("tick", F.when(shown, total).alias("total_rate"), F.when(shown, F.col("concurrency")).alias("concurrency"), F.when(shown, each).alias("per_process"))


def span_rates(transfers: DataFrame, keys: Sequence[str] = (), size: str = "size", start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Seconds from first start to last end, GiB moved and Gibit/s over that span."""
    base = transfers.groupBy(*keys).agg((F.max(end) - F.min(start)).alias("_us"), F.sum(size).alias("bytes"))
    seconds = F.col("_us") / 1e6
    return base.select(*keys, seconds.alias("span_s"), units.gib(F.col("bytes")).alias("gib"), units.ratio(units.gib(F.col("bytes")) * 8, seconds).alias("gibit_s"))


def elapsed_hours(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    """Hours since the first event."""
    if keys:
        first = df.groupBy(*keys).agg(F.min(time).alias("_first"))
        return ordered.attach(df, first, keys, time).withColumn("hours", (F.col(time) - F.col("_first")) / 3.6e9).drop("_first")
    return df.withColumn("hours", (F.col(time) - df.agg(F.min(time)).scalar()) / 3.6e9)
