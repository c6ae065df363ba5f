"""Counters over a growing log: the stream and its batch twin."""

from pyspark.sql import functions as F

from invspark.operators import stats
from invspark.session import shared_dir
from invspark.sources import text
from invspark.streaming import progress

from .base import query
from .views import Tables

TARGET = 50_000
PROGRESS = f"""SELECT count(*) AS n_uploads, sum(greatest(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0),1))::BIGINT AS n_files, sum(FILE_SIZE)::BIGINT AS bytes,
    sum(greatest(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0),1))/{TARGET}.0::DOUBLE AS fraction FROM upload_log"""


@query("s01_progress_batch", sql=PROGRESS)
def s01(t):
    return progress.progress(t.upload_log, TARGET)


@query("s01_progress_of_run", ctes=("k AS (SELECT sum(greatest(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0),1))::BIGINT AS n, count(*) AS target FROM upload_log)",),
       sql="SELECT n AS n_files, n/target::DOUBLE AS fraction FROM k")
def s01_run(t):
    """The target is read from the run's own log, written as text."""
    where = shared_dir(t.spark, "run-log")
    counts = t.upload_log.agg(F.countDistinct("LOCAL_FOLDER").alias("d"), F.count(F.lit(1)).alias("f"))
    lines = counts.select(F.explode(F.array(F.lit("starting"), F.concat(F.lit("Folders: "), F.col("d"), F.lit(" Files: "), F.col("f")))).alias("value"))
    lines.coalesce(1).write.text(where)
    target = progress.target_files(text.read_lines(t.spark, where))
    done = progress.progress(t.upload_log).withColumn("target", target.scalar())
    return done.select("n_files", (F.col("n_files") / F.col("target").cast("double")).alias("fraction"))


class Growing(Tables):
    """The same views over a stream of the given table's file."""

    def table(self, name):
        schema = super().table(name).schema
        return self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.sf_dir)


@query("s01_progress_stream", sql=PROGRESS)
def s01_stream(t):
    out = shared_dir(t.spark, "totals")
    log = Growing(t.spark, t.sf_dir).upload_log
    progress.start_progress(log, out, shared_dir(t.spark, "progress"), TARGET).awaitTermination()
    return t.spark.read.parquet(out)


GROWTH = """SELECT taken_us, files-f AS files_added, bytes-b AS bytes_added, round((bytes-b)/1048576.0::DOUBLE/s,6) AS mib_s, round((bytes-b)/1048576.0::DOUBLE/s*8,6) AS mibit_s,
    round((bytes-b)/1048576.0::DOUBLE/s*8/1024,6) AS gibit_s, round(CASE WHEN files>f THEN s/(files-f) ELSE 0 END,6) AS s_per_file
    FROM (SELECT *, lag(files) OVER w AS f, lag(bytes) OVER w AS b, (taken_us-lag(taken_us) OVER w)/1e6::DOUBLE AS s FROM snapshots WINDOW w AS (ORDER BY taken_us)) WHERE f IS NOT NULL"""


def rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in df.dtypes])


@query("s02_growth_between_listings", sql=GROWTH)
def s02(t):
    return rounded(stats.growth(t.snapshots))


def growth_stream(t):
    """Snapshots arriving in four triggers and out of order; the folder of the changes."""
    source, out, log = (shared_dir(t.spark, name) for name in ("snapshots", "growth", "growth-log"))
    snapshots = t.snapshots.withColumn("part", F.pmod(F.xxhash64("taken_us"), F.lit(4)))
    for part in range(4):
        snapshots.filter(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        stream = t.spark.readStream.schema("taken_us long, files long, bytes long").parquet(source)
        progress.start_growth(stream, out, log).awaitTermination()
    return out


@query("s02_growth_stream", sql=GROWTH)
def s02_stream(t):
    """Late snapshots correct what was reported, from what lies next to them in the state store."""
    return rounded(progress.read_growth(t.spark, growth_stream(t)))


NEW_LOGS = """SELECT key FROM log_keys WHERE (key LIKE '%backup.csv' OR key LIKE '%files.csv')
    AND regexp_replace(key,'-(files|backup)[.]csv$','-backup-verification.csv') NOT IN (SELECT key FROM log_keys WHERE key LIKE '%backup-verification.csv')"""


HOUR = 3_600_000_000


def new_logs(t, listings):
    """Take listings (key, listed_us) one per trigger, and what they report."""
    source, out, log = (shared_dir(t.spark, name) for name in ("listings", "new-logs", "new-logs-log"))
    for listing in listings:
        listing.write.mode("append").parquet(source)
        stream = t.spark.readStream.schema("key string, listed_us long").parquet(source)
        progress.start_new_logs(stream, out, log, wait_us=24 * HOUR).awaitTermination()
    return t.spark.read.schema("key string").option("recursiveFileLookup", True).parquet(out)


def at(hour):
    """A listing's time, in hours since some day."""
    return F.lit((400_000 + hour) * HOUR).alias("listed_us")


@query("s03_new_logs_stream", sql=NEW_LOGS)
def s03(t):
    """The whole listing arrives twice, days apart; the second time nothing new is reported."""
    later = t.spark.range(1).select(F.lit(None).cast("string").alias("key"), at(200))
    return new_logs(t, [t.log_keys.select("key", at(0)), t.log_keys.select("key", at(100)), later])


@query("s03_logs_in_any_order", sql=NEW_LOGS)
def s03_any_order(t):
    """Logs and verifications in three listings of one day, many of them apart; who comes first is left to a hash."""
    part = F.pmod(F.xxhash64("key"), F.lit(3))
    later = t.spark.range(1).select(F.lit(None).cast("string").alias("key"), at(100))
    return new_logs(t, [*[t.log_keys.filter(part == n).select("key", at(6 * n)) for n in range(3)], later])


QUOTA = """SELECT taken_us, bytes, round(bytes*100.0::DOUBLE/1e13::DOUBLE,6) AS percent_used, bytes-lag(bytes) OVER w AS bytes_added,
    round((bytes-lag(bytes) OVER w)/1048576.0::DOUBLE/((taken_us-lag(taken_us) OVER w)/1e6::DOUBLE),6) AS mib_s FROM snapshots WINDOW w AS (ORDER BY taken_us)"""


@query("s04_quota_watch", sql=QUOTA)
def s04(t):
    return rounded(progress.quota_watch(t.snapshots, 10_000_000_000_000))


@query("s04_quota_stream", sql=QUOTA)
def s04_stream(t):
    return rounded(progress.read_quota(t.spark, growth_stream(t), 10_000_000_000_000))
