"""Counters over growing logs and repeated listings."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..functions import names, values
from ..operators import stats


def progress(log: DataFrame, target_files: int | None = None) -> DataFrame:
    """Files, archive members and bytes uploaded so far; the same expression serves batch and stream."""
    members = F.sum(F.greatest(values.count_or_zero(F.col("FILES_PER_ZIP")), F.lit(1)))
    out = log.agg(
        F.count(F.lit(1)).alias("n_uploads"),
        members.alias("n_files"),
        F.sum("FILE_SIZE").alias("bytes"),
    )
    return out if target_files is None else out.withColumn("fraction", F.col("n_files") / F.lit(float(target_files)))


def target_files(run_log: DataFrame, value: str = "value") -> DataFrame:
    """(target): the number of files a run set out to send, from its log's line ``Folders: <n> Files: <n>``; the first such line counts."""
    lines = run_log.filter(F.contains(value, F.lit("Folders: ")) & F.contains(value, F.lit(" Files: ")))
    number = F.try_element_at(F.split(F.trim(value), r"\s+"), F.lit(4)).try_cast("long")
    return lines.agg(F.min_by(number, "line_no").alias("target"))


def start_progress(log_stream: DataFrame, out_path: str, checkpoint: str, target_files: int | None = None):
    """Keep the totals of a log stream (a single row) in the table at ``out_path``, rewritten by each batch."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(out_path)

    return (
        progress(log_stream, target_files)
        .writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


#: A snapshot, the one before it, and the number of the change that made the row: of several rows of a snapshot the last counts.
PAIRED = "series string, taken_us long, files long, bytes long, _t long, _f long, _b long, change long"


class Neighbours(StatefulProcessor):
    """Keeps the snapshots of a series in order, and gives each with the one before it whenever either changes.

    Times are the leaves of a tree with 256 children a node, eight levels deep: one entry of the state store per node, with a bit for each
    child that holds something. A snapshot is set, and its neighbours are found, by at most some thirty entries on its way up
    and down, however many snapshots there are.
    """

    LEVELS, OFFSET = 8, 1 << 63

    def init(self, handle) -> None:
        self.nodes = handle.getMapState("nodes", "level int, prefix string", "bits string")
        self.snapshots = handle.getMapState("snapshots", "taken_us long", "files long, bytes long")
        self.changes = handle.getValueState("changes", "n long")

    def _bits(self, level: int, prefix: int) -> int:
        held = self.nodes.getValue((level, f"{prefix:x}"))
        return int(held[0], 16) if held else 0

    def _set(self, time: int) -> None:
        for level in range(self.LEVELS):
            prefix, child = time >> 8 * (level + 1), time >> 8 * level & 255
            bits = self._bits(level, prefix)
            self.nodes.updateValue((level, f"{prefix:x}"), (f"{bits | 1 << child:x}",))
            if bits:
                return  # the nodes above know of this one

    def _next(self, time: int, later: bool) -> int | None:
        """The nearest time after, or before, ``time``."""
        for level in range(self.LEVELS):
            prefix, child = time >> 8 * (level + 1), time >> 8 * level & 255
            bits = self._bits(level, prefix)
            bits = bits >> child + 1 << child + 1 if later else bits & (1 << child) - 1
            if bits:
                break
        else:
            return None
        pick = (lambda b: (b & -b).bit_length() - 1) if later else (lambda b: b.bit_length() - 1)
        found = prefix << 8 | pick(bits)
        for below in range(level - 1, -1, -1):
            found = found << 8 | pick(self._bits(below, found))
        return found

    def handleInputRows(self, key, rows, timerValues):
        touched = set()
        for row in rows:
            if row.taken_us is None:
                continue
            # Of several snapshots of one time the one that comes last counts.
            time, new = row.taken_us + self.OFFSET, not self.snapshots.containsKey((row.taken_us,))
            self.snapshots.updateValue((row.taken_us,), (row.files, row.bytes))
            if new:
                self._set(time)
            touched.add(time)
        change = self.changes.get()[0] if self.changes.exists() else 0
        after = {self._next(time, True) for time in touched} - {None}
        for time in sorted(touched | after):
            before, change = self._next(time, False), change + 1
            mine = self.snapshots.getValue((time - self.OFFSET,))
            other = (None, None, None) if before is None else (before - self.OFFSET, *self.snapshots.getValue((before - self.OFFSET,)))
            yield Row(series=key[0], taken_us=time - self.OFFSET, files=mine[0], bytes=mine[1], _t=other[0], _f=other[1], _b=other[2], change=change)
        self.changes.update((change,))

    def close(self) -> None:
        pass


@contextmanager
def _ordered_store(spark: SparkSession):
    """State with several entries per key needs the RocksDB store; a query keeps the store it was started with."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def start_growth(snapshots: DataFrame, out_path: str, checkpoint: str, series: str | None = None):
    """Keep each snapshot (taken_us, files, bytes) of a stream beside the one before it, whatever order they come in.

    Snapshots are kept in the stream's state store, per ``series`` (a column) if there are several; a trigger reads there what lies next to its
    own snapshots, nothing else, and no earlier input or result. What it writes are changes: the rows of its snapshots, and of those that
    follow them. ``read_growth`` and ``read_totals`` take the last change of each.
    """
    rows = snapshots.select((F.col(series).cast("string") if series else F.lit("")).alias("series"), "taken_us", "files", "bytes")
    paired = rows.groupBy("series").transformWithState(Neighbours(), PAIRED, "Append", "None")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    with _ordered_store(snapshots.sparkSession):
        return paired.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_totals(spark: SparkSession, out_path: str) -> DataFrame:
    """``PAIRED`` rows that ``start_growth`` has written so far, one per snapshot, as of its last change."""
    rows = spark.read.schema(PAIRED).option("recursiveFileLookup", True).parquet(out_path)
    newest = rows.groupBy("series", "taken_us").agg(F.max("change").alias("change"))
    return rows.join(newest, ["series", "taken_us", "change"]).select(*rows.columns)


def read_growth(spark: SparkSession, out_path: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rates between the snapshots so far, as ``stats.growth`` gives them for a table; ``keys`` may name ``series``."""
    return stats.growth_of(read_totals(spark, out_path), keys)


#: Groups that the state of ``start_new_logs`` lies in. A checkpoint keeps the number it was begun with.
BUCKETS = 1024


def start_new_logs(listings: DataFrame, out_path: str, checkpoint: str, wait_us: int, late_us: int | None = None, buckets: int = BUCKETS, **suffixes):
    """Report logs that no verification table followed, once each, over repeated listings (key, listed_us).

    State says which verification names have been seen, which logs wait for theirs and until when, and which were reported. A
    log and its verification may come in any order, in one listing or many triggers apart. A log is reported when the newest
    listing was taken more than ``wait_us`` after the one that first held it; a verification that comes earlier settles it, one that
    comes later does not take the report back. Time moves with every listing; an empty one may move it by a row without a key.
    Listings may come up to ``late_us`` (if not given: ``wait_us``) later than others taken after them; rows that are later still, and
    those of listings at or before 1970, are not looked at.

    Names are dealt by hash to ``buckets`` groups, and a call takes all of a group: a call costs milliseconds, a name in it
    microseconds. A trigger reads and writes the groups that its listing touches, so a whole listing costs what it holds. State of about
    a hundred bytes a log or verification is spread evenly over the groups; other keys have none. With many more than some hundred
    million names start with more groups; the number stays as long as the checkpoint.

    Each trigger takes the listings there are and writes (key) to its own folder; neither earlier listings nor results are read again.
    """
    late_us = wait_us if late_us is None else late_us
    kind, key = names.log_class(F.col("key"), **suffixes), F.col("key")
    twin = F.when(kind == "verification", key).when(kind.isNotNull(), names.verification_twin(key, **suffixes))
    # Rows of other keys stay, as time moves by them; they are dealt by their key.
    bucket = F.pmod(F.xxhash64(F.coalesce(twin, key)), F.lit(buckets)).cast("int")
    rows = listings.select(
        bucket.alias("bucket"), F.when(kind.isNotNull(), key).alias("key"), twin.alias("twin"), (kind == "verification").alias("is_check"), "listed_us",
        F.timestamp_micros("listed_us").alias("listed"),
    ).withWatermark("listed", f"{late_us} microseconds")

    def watch(_, batches, state):
        settled, waiting, twins, until, reported = state.get if state.exists else ([], [], [], [], [])
        settled, reported, held = set(settled), set(reported), {log: (name, end) for log, name, end in zip(waiting, twins, until)}
        if not state.hasTimedOut:
            for batch in batches:
                batch = batch[batch["key"].notna()]
                checks = batch["is_check"].astype(bool)
                settled.update(batch["twin"][checks])
                logs = batch[~checks & batch["listed_us"].notna()]
                for log, name, listed in zip(logs["key"], logs["twin"], logs["listed_us"].astype("int64").tolist()):
                    end = listed + wait_us
                    if log not in reported and (log not in held or end < held[log][1]):
                        held[log] = (name, end)
        # The watermark is in milliseconds, and lies behind the newest listing by what may come late.
        now = state.getCurrentWatermarkMs()
        held = {log: pair for log, pair in held.items() if pair[0] not in settled}
        due = {log: (end - late_us) // 1000 + 1 for log, (_, end) in held.items()}
        out = sorted(log for log, time in due.items() if time <= now)
        held = {log: pair for log, pair in held.items() if due[log] > now}
        reported.update(out)
        if settled or held or reported:
            state.update((list(settled), list(held), [name for name, _ in held.values()], [end for _, end in held.values()], list(reported)))
        if held:
            state.setTimeoutTimestamp(min(due[log] for log in held))
        yield pd.DataFrame({"key": out}, dtype=object)

    kept = "settled array<string>, waiting array<string>, twins array<string>, until array<bigint>, reported array<string>"
    found = rows.groupBy("bucket").applyInPandasWithState(watch, "key string", kept, "append", "EventTimeTimeout")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return found.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def quota_watch(totals: DataFrame, quota_bytes: int) -> DataFrame:
    """Share of the quota used at each snapshot and the growth since the one before."""
    return _quota(totals, stats.growth(totals), quota_bytes)


def read_quota(spark: SparkSession, out_path: str, quota_bytes: int) -> DataFrame:
    """The same of the snapshots that ``start_growth`` has taken so far."""
    totals = read_totals(spark, out_path)
    return _quota(totals, stats.growth_of(totals), quota_bytes)


def _quota(totals: DataFrame, growth: DataFrame, quota_bytes: int) -> DataFrame:
    grown = growth.select("taken_us", "bytes_added", "mib_s")
    return totals.join(grown, "taken_us", "left").select(
        "taken_us", "bytes", (F.col("bytes") * 100.0 / quota_bytes).alias("percent_used"), "bytes_added", "mib_s"
    )
