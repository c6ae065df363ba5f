"""Order-dependent operators that never put a whole sequence into one task.

A plain window over ``partitionBy(run)`` sorts each run in one task, and a
window without keys sorts everything in one. Here a sequence is cut into
buckets of its order key (``order >> shift``). Windows run inside the buckets,
one summary row per bucket carries what later buckets need, and the summaries
are scanned the same way. Order keys are unique within ``keys``, so a bucket
holds at most ``2**shift`` rows whatever the distribution of the data.

Key columns must not be null; the order column is a long.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

# Row numbers: a million rows per bucket, a million buckets at 1e12 rows.
ROWS = (20,)
# Microseconds: 67 s per bucket, about 470,000 buckets per year of log.
MICROS = (26,)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    sums: Mapping[str, Column] | None = None,
    previous: Mapping[str, Column] | None = None,
    following: Mapping[str, Column] | None = None,
    shifts: Sequence[int] = ROWS,
    narrow: bool = False,
) -> DataFrame:
    """Add columns that depend on all earlier (or the next) rows of a sequence.

    ``sums``: sum over all earlier rows, the current one excluded, 0 at the start.
    ``previous`` / ``following``: the value on the neighbouring row, null at the ends.
    ``narrow``: the rows hold no columns beyond those named here. Windows and
    summaries then share one shuffle, and what lies before it runs once; wider
    rows are better summed map-side.
    """
    kinds = (dict(sums or {}), dict(previous or {}), dict(following or {}))
    out = _scan(df, list(keys), order, kinds, list(shifts), narrow)
    return out.select(
        *df.columns,
        *[F.col(f"_s_{n}").alias(n) for n in kinds[0]],
        *[F.col(f"_p_{n}").alias(n) for n in kinds[1]],
        *[F.col(f"_f_{n}").alias(n) for n in kinds[2]],
    )


def _scan(df, keys, order, kinds, shifts, narrow):
    sums, previous, following = kinds
    if not shifts:
        return df.withColumns(_local(keys or [F.lit(0)], order, kinds))
    bucket = f"_b{len(shifts)}"
    cut = df.withColumn(bucket, F.shiftright(F.col(order), shifts[0]))
    if narrow:
        cut = cut.repartition(*keys, bucket)
    inside = cut.withColumns(_local([*keys, bucket], order, kinds))
    summary = cut.groupBy(*keys, bucket).agg(
        *[F.sum(c).alias(f"_i_{n}") for n, c in sums.items()],
        *[F.max_by(c, order).alias(f"_i_{n}") for n, c in previous.items()],
        *[F.min_by(c, order).alias(f"_i_{n}") for n, c in following.items()],
    )
    inputs = tuple({n: F.col(f"_i_{n}") for n in kind} for kind in kinds)
    carried = _scan(summary, keys, bucket, inputs, shifts[1:], False).select(
        *keys,
        bucket,
        *[F.col(f"_s_{n}").alias(f"_c_{n}") for n in sums],
        *[F.col(f"_p_{n}").alias(f"_c_{n}") for n in previous],
        *[F.col(f"_f_{n}").alias(f"_c_{n}") for n in following],
    )
    return inside.join(carried, [*keys, bucket], "left").withColumns(
        {f"_s_{n}": F.col(f"_s_{n}") + F.col(f"_c_{n}") for n in sums}
        | {f"_p_{n}": F.when(F.col("_opens"), F.col(f"_c_{n}")).otherwise(F.col(f"_p_{n}")) for n in previous}
        | {f"_f_{n}": F.when(F.col("_closes"), F.col(f"_c_{n}")).otherwise(F.col(f"_f_{n}")) for n in following}
    )


def _local(partition, order, kinds):
    sums, previous, following = kinds
    window = Window.partitionBy(*partition).orderBy(order)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return (
        {f"_s_{n}": F.coalesce(F.sum(c).over(before), F.lit(0)) for n, c in sums.items()}
        | {f"_p_{n}": F.lag(c).over(window) for n, c in previous.items()}
        | {f"_f_{n}": F.lead(c).over(window) for n, c in following.items()}
        # The bucket's first and last rows take their neighbour from another bucket, even where values are null.
        | ({"_opens": F.lag(F.lit(True)).over(window).isNull()} if previous else {})
        | ({"_closes": F.lead(F.lit(True)).over(window).isNull()} if following else {})
    )


def numbered(df: DataFrame, keys: Sequence[str], order: str, name: str = "idx", shifts=ROWS, narrow: bool = False) -> DataFrame:
    """Row number from 0 within ``keys`` in ``order``."""
    return scan(df, keys, order, sums={name: F.lit(1).cast("long")}, shifts=shifts, narrow=narrow)


def chunks(df: DataFrame, keys: Sequence[str], order: str, size: int, name: str = "chunk", shifts=ROWS, narrow: bool = False) -> DataFrame:
    """Number of the fixed-size chunk each row falls into, in ``order``."""
    return numbered(df, keys, order, "_idx", shifts, narrow).withColumn(name, F.floor(F.col("_idx") / size)).drop("_idx")


def rolling_rows(
    df: DataFrame, keys: Sequence[str], order: str, value: Column, n: int, name: str = "rolling",
    full_only: bool = False, shifts=ROWS,
) -> DataFrame:
    """Mean over the last ``n`` rows, null until ``n`` values were seen and where one of them is null.

    Rows are shuffled once, into buckets of the order key. A bucket's last
    ``n - 1`` values are its summary; from the summaries before it each bucket
    gets the ``n - 1`` values that precede its first row, and the frames of its
    first rows are filled up from them.
    """
    rows = df.withColumns({"_value": value, "_bucket": F.shiftright(F.col(order), shifts[0])}).repartition(*keys, "_bucket")
    own, other = [*keys, "_bucket"], list(keys) or [F.lit(0)]
    backwards = F.row_number().over(Window.partitionBy(*own).orderBy(F.desc(order)))
    ends = rows.select(*own, order, "_value").withColumn("_from_end", backwards).filter(F.col("_from_end") < n)
    tails = ends.groupBy(*own).agg(F.transform(F.array_sort(F.collect_list(F.struct(order, "_value"))), lambda x: x["_value"]).alias("_tail"))
    # The n - 1 buckets before hold at least as many values, if there are that many.
    before = Window.partitionBy(*other).orderBy("_bucket").rowsBetween(1 - n, -1) if n > 1 else None
    held = F.flatten(F.collect_list("_tail").over(before)) if n > 1 else F.array().cast("array<double>")
    carried = tails.select(*own, F.slice(held, F.greatest(F.size(held) - (n - 2), F.lit(1)), F.lit(max(n - 1, 1))).alias("_carried")) if n > 1 else None
    frame = Window.partitionBy(*own).orderBy(order).rowsBetween(1 - n, 0)
    inside = rows.withColumns({"_seen": F.count(F.lit(1)).over(frame), "_known": F.count("_value").over(frame), "_mean": F.avg("_value").over(frame)})
    if carried is None:
        return inside.withColumn(name, F.col("_mean")).select(*df.columns, name)
    joined = inside.join(carried, own)
    lacking = F.lit(n) - F.col("_seen")
    there = F.size("_carried") >= lacking
    filling = F.slice("_carried", F.greatest(F.size("_carried") - lacking + 1, F.lit(1)).cast("int"), F.greatest(lacking, F.lit(0)).cast("int"))
    whole = (F.col("_known") == F.col("_seen")) & F.forall(filling, lambda x: x.isNotNull())
    total = F.col("_mean") * F.col("_seen") + F.aggregate(filling, F.lit(0.0), lambda a, x: a + x)
    mean = F.when(lacking == 0, F.when(F.col("_known") == n, F.col("_mean"))).when(there & whole, total / n)
    out = joined.filter(there) if full_only else joined
    return out.withColumn(name, mean).select(*df.columns, name)


def rolling_span(df: DataFrame, keys: Sequence[str], order: str, value: Column, span: int, name: str = "rolling") -> DataFrame:
    """Mean of ``value`` (a long) over ``(t - span, t]``; one row per ``keys`` and ``order``.

    Time is cut into buckets of one span. Whatever counts inside a bucket came
    in that bucket or the one before: a value is added at ``t``, counts in full
    at the start of the next bucket, and goes at ``t + span``. So sums run
    within buckets only: one shuffle, nothing carried further, no sliding frame.
    """
    bucket = F.floor(F.col(order) / span).cast("long")
    zero = F.lit(0).cast("long")

    def event(home: Column, t: Column, sign: int, own: bool) -> Column:
        one = F.lit(sign).cast("long")
        return F.struct(home.alias("_bucket"), t.alias(order), (F.col("_v") * sign).alias("_v"), F.when(F.col("_v").isNotNull(), one).otherwise(zero).alias("_n"), F.lit(own).alias("_own"))

    events = F.array(
        event(F.col("_b"), F.col(order), 1, True),
        event(F.col("_b") + 1, (F.col("_b") + 1) * span, 1, False),
        event(F.col("_b") + 1, F.col(order) + span, -1, False),
    )
    moves = (
        df.select(*keys, order, value.cast("long").alias("_v"), bucket.alias("_b"))
        .select(*keys, F.inline(events))
        .groupBy(*keys, "_bucket", order)
        .agg(F.coalesce(F.sum("_v"), zero).alias("_v"), F.sum("_n").alias("_n"), F.bool_or("_own").alias("_own"))
    )
    run = Window.partitionBy(*keys, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    held, count = F.sum("_v").over(run), F.sum("_n").over(run)
    return moves.select(*keys, order, "_own", held.alias("_held"), count.alias("_count")).filter("_own").select(
        *keys, order, F.when(F.col("_count") > 0, F.col("_held").cast("double") / F.col("_count")).alias(name)
    )


def attach(df: DataFrame, groups: DataFrame, on: Sequence[str], spread: str, salts: int = 16) -> DataFrame:
    """Left join of one row per group onto a large table whose groups may be very uneven.

    The rows of a group are spread over ``salts`` join keys by ``spread``, and
    the (much smaller) group table is repeated once per salt. Null keys match
    each other.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    names = [f"_on_{name}" for name in on]
    copies = groups.select(
        *[F.col(name).alias(other) for name, other in zip(on, names)],
        *[name for name in groups.columns if name not in on],
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_copy"),
    )
    same = F.col("_salt") == F.col("_copy")
    for name, other in zip(on, names):
        same = same & salted[name].eqNullSafe(copies[other])
    return salted.join(copies, same, "left").drop("_salt", "_copy", *names)
