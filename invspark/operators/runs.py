"""Figures of many runs read from their text logs (file, line_no, value)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import names, times, units
from . import lookups, ordered

# What marks each of the four line forms, and the word (from 1) each figure stands at.
#   8.00 MiB uploaded in 2.00 seconds, 4.00 MiB/s
#   5 files (avg 6.00 MiB/file) uploaded in 1.50 seconds, 0.30 s/file
#   Finished at 2001-02-03 04:05:06.000007, elapsed time = 0:01:40.250000
#   Total: 20 files; 1000.00 MiB; 10.00 MiB/s including setup time; 5.00 s/file including setup time
TRANSFER, FOLDER, FINISHED, TOTAL = "MiB uploaded in", "MiB/file) uploaded in", "Finished at", "Total:"
WORDS = {
    "transfer": {"mib": 1, "seconds": 5, "mib_s": 7},
    "folder": {"n_files": 1, "seconds": 8, "s_per_file": 10},
    "finished": {"elapsed_us": -1},
    "total": {"n_files": 2, "mib": 4, "mib_s": 6, "s_per_file": 11},
}


def matching(lines: DataFrame, pattern: str, value: str = "value") -> DataFrame:
    return lines.filter(F.contains(F.col(value), F.lit(pattern)))


def parse_lines(lines: DataFrame) -> DataFrame:
    """Each line with its form and figures; lines of no known form are dropped.

    A line is recognised by a plain substring and split into words once.
    """
    has = lambda text: F.contains("value", F.lit(text))
    form = F.when(has(TRANSFER), "transfer").when(has(FOLDER), "folder").when(has(FINISHED), "finished").when(has(TOTAL), "total")
    marked = lines.filter(has(TRANSFER) | has(FOLDER) | has(FINISHED) | has(TOTAL)).withColumns(
        {"form": form, "_words": F.split(F.trim("value"), "\\s+")}
    )

    def figure(name, kind):
        out = None
        for shape, words in WORDS.items():
            if name in words:
                hit, word = F.col("form") == shape, F.try_element_at("_words", F.lit(words[name]))
                value = times.duration_us(word) if kind == "duration" else word.try_cast(kind)
                out = F.when(hit, value) if out is None else out.when(hit, value)
        return out

    figures = {name: figure(name, "double") for name in ("mib", "seconds", "mib_s", "s_per_file")}
    return marked.withColumns(figures | {"n_files": figure("n_files", "long"), "elapsed_us": figure("elapsed_us", "duration")}).drop("_words")


def run_summary(lines: DataFrame) -> DataFrame:
    """One row per run: totals, mean transfer time and speed, overhead, flags from the title."""
    parsed = parse_lines(lines)
    one = F.col("form") == "transfer"
    base = parsed.groupBy("file").agg(
        F.max("elapsed_us").alias("total_us"),
        F.max(F.when(F.col("form") == "total", F.col("mib"))).alias("total_mib"),
        F.max(F.when(F.col("form") == "total", F.col("n_files"))).alias("total_files"),
        F.max(F.when(F.col("form") == "total", F.col("s_per_file"))).alias("s_per_file"),
        F.count_if(one).alias("n_transfers"),
        F.sum(F.when(one, units.fixed(F.col("seconds"), 2))).alias("_cs"),
        F.sum(F.when(one, units.fixed(F.col("mib"), 2))).alias("_cmib"),
        F.avg(F.when(one & (F.col("seconds") > 0), F.col("mib") / F.col("seconds"))).alias("mean_transfer_mib_s"),
    )
    tokens = F.split("file", "_")
    total_s, mean_s = F.col("total_us") / 1e6, F.col("_cs") / 100.0 / F.col("n_transfers")
    strategy = F.element_at(tokens, 1)
    return base.select(
        "file",
        names.label_ladder(tokens).alias("dataset"),
        names.digits(F.element_at(tokens, -1)).cast("int").alias("cpus"),
        (strategy != "no-collate").alias("collated"),
        (~strategy.isin("no-collate", "no-compression")).alias("compressed"),
        "total_files", "total_mib", "s_per_file", "n_transfers",
        total_s.alias("total_s"),
        units.ratio(F.col("total_mib"), total_s).alias("mib_s"),
        mean_s.alias("mean_transfer_s"),
        "mean_transfer_mib_s",
        units.ratio(F.col("_cmib"), F.col("_cs")).alias("overall_transfer_mib_s"),
        (total_s - mean_s * F.col("total_files")).alias("overhead_s"),
    )


def mean_rates(runs: DataFrame, keys: list[str], rate: str = "rate", workers: str = "cpus") -> DataFrame:
    """Mean rate per group and total rate of all its workers, sorted."""
    out = runs.groupBy(*keys).agg(F.avg(rate).alias("rate"))
    return out.withColumn("total_rate", F.col("rate") * F.col(workers)).orderBy(*keys)


def parallel_speed_up(runs: DataFrame, on: list[str], workers: str = "cpus") -> DataFrame:
    return lookups.speed_up(runs, on, workers, "rate")


def strategy_comparison(summary: DataFrame) -> DataFrame:
    return summary.groupBy("dataset", "cpus", "collated", "compressed").agg(
        F.count(F.lit(1)).alias("n_runs"), F.avg("total_s").alias("total_s"), F.avg("mib_s").alias("mib_s")
    )


def rate_lines(lines: DataFrame, n: int = 10) -> DataFrame:
    """Mibit/s of transfer lines and s/file of folder lines, each with its n-row mean where full."""
    parsed = parse_lines(lines).filter(F.col("form").isin("transfer", "folder"))
    reading = F.when(F.col("form") == "transfer", F.col("mib_s") * 8).otherwise(F.col("s_per_file"))
    rows = parsed.select("file", "form", "line_no", reading.alias("reading"))
    return ordered.rolling_rows(rows, ["file", "form"], "line_no", F.col("reading"), n, "smoothed", full_only=True)
