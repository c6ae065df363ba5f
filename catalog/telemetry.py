"""Transfer logs: summaries, windows, rates over time, run comparison."""

from pyspark.sql import functions as F

from invspark.functions import names, units, values
from invspark.operators import ordered, runs, stats, timeline
from invspark.session import shared_dir
from invspark.sources import tables

from .base import query
from .views import SITE_LABELS

RATE = "CASE WHEN seconds<>0 THEN size::DOUBLE*8/1073741824.0::DOUBLE/seconds END"
HOUR = 3_600_000_000
TICK = 120_000_000


def gibit():
    return units.gibit_rate(F.col("size"), F.col("seconds"))


def mib_s():
    return F.round(F.col("smoothed") / 1048576000.0, 6).alias("mib_s")


def rounded(df, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else c for c, kind in df.dtypes])


def curve_sql(keys: str = "compressed") -> tuple[str, ...]:
    k, by = (keys + ", ", f"PARTITION BY {keys} ") if keys else ("", "")
    return (
        f"""mv AS (SELECT {k}start_us AS t, rate AS delta, 1 AS step FROM transfers WHERE rate>0 UNION ALL SELECT {k}end_us, -rate, -1 FROM transfers WHERE rate>0)""",
        f"ch AS (SELECT {k}t, sum(delta)::BIGINT AS delta, sum(step)::BIGINT AS step FROM mv GROUP BY ALL)",
        f"""curve AS (SELECT {k}t, lead(t) OVER w AS next_t, (sum(delta) OVER w)::BIGINT AS rate, (sum(step) OVER w)::BIGINT AS concurrency
            FROM ch WINDOW w AS ({by}ORDER BY t))""",
    )


AREA = "sum(rate::HUGEINT*(next_t-t))::DOUBLE/1e9::DOUBLE/1048576.0::DOUBLE"


def curve(t, keys=("compressed",)):
    return timeline.level_curve(t.transfers, list(keys))


@query("a06_last_entry_per_key", sql="SELECT DESTINATION_KEY, arg_max(ord, ord) AS ord, arg_max(UPLOAD_TIME, ord) AS UPLOAD_TIME, arg_max(FILE_SIZE, ord) AS FILE_SIZE FROM upload_log GROUP BY 1")
def a06(t):
    return stats.last_per_key(t.upload_log.select("DESTINATION_KEY", "ord", "UPLOAD_TIME", "FILE_SIZE"), "DESTINATION_KEY", "ord")


LAST = "last AS (SELECT * FROM upload_log QUALIFY row_number() OVER (PARTITION BY DESTINATION_KEY ORDER BY ord DESC)=1)"


@query("a09_session_summary", ctes=(LAST, """g AS (SELECT count(*) AS n, sum(FILE_SIZE)/1048576.0::DOUBLE AS mib, sum(round(UPLOAD_TIME*1000000)::BIGINT)/1e6::DOUBLE AS cpu,
    (max(end_us)-min(start_us))/1e6::DOUBLE AS wall, sum(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0))::BIGINT AS src, sum(greatest(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0),1))::BIGINT AS srca FROM last)"""),
    sql="""SELECT n AS n_files, src AS n_source_files, srca AS n_source_files_all, round(wall,6) AS wall_s, round(cpu,6) AS cpu_s, round(mib,6) AS mib, round(mib/wall,6) AS mib_s_wall,
    round(mib/cpu,6) AS mib_s_cpu, round(wall/n,6) AS s_per_file_wall, round(cpu/n,6) AS s_per_file_cpu, round(wall/src,6) AS s_per_source_file_wall, round(cpu/src,6) AS s_per_source_file_cpu FROM g""")
def a09(t):
    return rounded(stats.session_summary(stats.last_per_key(t.upload_log, "DESTINATION_KEY", "ord")))


@query("a10_transfer_stats", sql="""SELECT ord, round(size/1048576.0::DOUBLE/n,6) AS avg_mib, round(dur_us/1e6::DOUBLE,6) AS elapsed_s, round(dur_us/1e6::DOUBLE/n,6) AS s_per_file,
    round(CASE WHEN dur_us<>0 THEN size/1048576.0::DOUBLE/(dur_us/1e6::DOUBLE) END,6) AS mib_s FROM (SELECT *, ord%9+1 AS n FROM transfers)""")
def a10(t):
    rows = t.transfers.withColumn("n", F.col("ord") % 9 + 1)
    return rounded(stats.transfer_stats(rows, "size", "n", "dur_us").select("ord", "avg_mib", "elapsed_s", "s_per_file", "mib_s"))


@query("a11_totals_by_type", sql="""SELECT kind, n, bytes, n_members, round(s,6) AS total_s, round(s/n,6) AS mean_s, round(n_members/n,6) AS mean_members, round(CASE WHEN n_members<>0 THEN s/n_members END,6) AS s_per_member FROM
    (SELECT CASE WHEN LOCAL_PATH LIKE '%.zip' THEN 'zip' ELSE 'file' END AS kind, count(*) AS n, sum(FILE_SIZE)::BIGINT AS bytes, sum(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0))::BIGINT AS n_members,
    sum(round(UPLOAD_TIME*1000000)::BIGINT)/1e6::DOUBLE AS s FROM upload_log GROUP BY 1)""")
def a11(t):
    return rounded(stats.by_type(t.upload_log.withColumn("kind", names.transfer_type(F.col("LOCAL_PATH"))), ["kind"]))


def described(column, source="transfers", keys="kind, compressed"):
    return f"""SELECT {keys}, count({column}) AS n, round(avg({column}),3) AS mean, round(stddev_samp({column}),3) AS std, min({column}) AS min, max({column}) AS max,
        round(quantile_cont({column},0.25),3) AS q25, round(quantile_cont({column},0.5),3) AS q50, round(quantile_cont({column},0.75),3) AS q75 FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}"""


@query("a12_size_distribution", sql=described("size"))
def a12(t):
    return rounded(stats.describe(t.transfers, ["kind", "compressed"], "size"), 3)


@query("a12_rate_distribution", ctes=f"r AS (SELECT kind, compressed, {RATE}*1000000 AS micro FROM transfers)", sql=described("micro", "r").replace("min(micro)", "round(min(micro),3)").replace("max(micro)", "round(max(micro),3)"))
def a12_rate(t):
    """Rates as they are, in doubles."""
    return rounded(stats.describe(t.transfers.withColumn("micro", gibit() * 1_000_000), ["kind", "compressed"], "micro"), 3)


@query("a12_price_distribution_at_size", ctes="r AS (SELECT l_returnflag, round(l_extendedprice*100)::BIGINT AS cents FROM lineitem)", sql=described("cents", "r", "l_returnflag"))
def a12_lines(t):
    lines = t.table("lineitem").select("l_returnflag", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"))
    return rounded(stats.describe(lines, ["l_returnflag"], "cents"), 3)


@query("a12_sizes_of_all_runs", sql="""SELECT kind, count(*) AS n, min(size) AS low, max(size) AS high, true AS ranks_hold FROM transfers GROUP BY kind""")
def a12_runs(t):
    """Sketches stored per run, merged over all runs without their rows; the ranks of what they give are counted in the transfers themselves."""
    where = shared_dir(t.spark, "sketches")
    stats.sketches(t.transfers, ["run", "kind"], "size").write.parquet(where)
    stored = t.spark.read.parquet(where)
    marks = [n / 20 for n in range(21)]
    near = stats.sketched_quantiles(stats.merged_sketches(stored, ["kind"]), ["kind"], marks, [f"q{n}" for n in range(21)])
    points = near.select("kind", "n", F.col("q0").alias("low"), F.col("q20").alias("high"), F.posexplode(F.array(*[F.col(f"q{n}") for n in range(21)])).alias("place", "value"))
    # A value that rows share has all their ranks; the wanted one must lie among them, within a hundredth of the rows.
    ranks = t.transfers.join(points, "kind").groupBy("kind", "n", "low", "high", "place").agg(
        F.count_if(F.col("size") < F.col("value")).alias("under"), F.count_if(F.col("size") <= F.col("value")).alias("upto")
    )
    slack, want = F.col("n") * 0.01 + 1, F.col("n") * F.col("place") / 20
    return ranks.groupBy("kind", "n", "low", "high").agg(F.bool_and((F.col("under") <= want + slack) & (F.col("upto") >= want - slack)).alias("ranks_hold"))


def bins_sql(value, source, bins, keys="kind, compressed"):
    return (f"""e AS (SELECT {keys}, CASE WHEN min({value})=max({value}) THEN min({value})-0.5::DOUBLE ELSE min({value})::DOUBLE END AS lo,
        CASE WHEN min({value})=max({value}) THEN max({value})+0.5::DOUBLE ELSE max({value})::DOUBLE END AS hi FROM {source} WHERE {value} IS NOT NULL GROUP BY {keys})""",
        f"""b AS (SELECT {keys}, least(floor(({value}-lo)/(hi-lo)*{bins}),{bins}-1)::BIGINT AS bin, count(*) AS n FROM {source} JOIN e USING ({keys}) WHERE {value} IS NOT NULL GROUP BY ALL)""",
        f"""h AS (SELECT {keys}, bin, lo+(hi-lo)*bin/{bins} AS from_value, lo+(hi-lo)*(bin+1)/{bins} AS to_value, coalesce(n,0) AS n
        FROM (SELECT e.*, unnest(range({bins})) AS bin FROM e) LEFT JOIN b USING ({keys}, bin))""")


@query("a13_size_histogram", ctes=bins_sql("size", "transfers", 50), sql="SELECT kind, compressed, bin, round(from_value,3) AS from_value, round(to_value,3) AS to_value, n FROM h")
def a13(t):
    return rounded(stats.histogram(t.transfers, ["kind", "compressed"], "size", 50), 3)


@query("a24_members_total", sql="SELECT sum(coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0))::BIGINT AS n_members FROM upload_log")
def a24(t):
    return t.upload_log.agg(F.sum(values.count_or_zero(F.col("FILES_PER_ZIP"))).alias("n_members"))


# Windows


@query("w06_overlap", sql="SELECT run, ord, coalesce(lag(end_us) OVER (PARTITION BY run ORDER BY ord)>start_us, false) AS overlap FROM transfers")
def w06(t):
    return timeline.overlap(t.transfers.select("run", "ord", "start_us", "end_us"), ["run"], narrow=True).select("run", "ord", "overlap")


def rolled_sql(keys, n, value=RATE):
    over = f"(PARTITION BY {keys} ORDER BY ord ROWS {n - 1} PRECEDING)"
    return f"round(CASE WHEN count({value}) OVER {over}={n} THEN avg({value}) OVER {over} END,6)"


@query("w07_rolling_mean_of_rows", sql=f"SELECT run, ord, {rolled_sql('run', 10)} AS rolling FROM transfers")
def w07(t):
    return rounded(ordered.rolling_rows(t.transfers.select("run", "ord", gibit().alias("g")), ["run"], "ord", F.col("g"), 10).select("run", "ord", "rolling"))


@query("w07_rolling_mean_over_index", sql=f"SELECT ord, {rolled_sql('1', 100)} AS rolling FROM transfers")
def w07_all(t):
    return rounded(ordered.rolling_rows(t.transfers.select("ord", gibit().alias("g")), [], "ord", F.col("g"), 100).select("ord", "rolling"))


@query("w08_rolling_mean_of_an_hour", ctes=curve_sql(), sql="""SELECT compressed, t, round(avg(rate) OVER (PARTITION BY compressed ORDER BY t RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)/1048576000.0::DOUBLE,6) AS mib_s FROM curve""")
def w08(t):
    return timeline.smoothed(curve(t), ["compressed"]).select("compressed", "t", mib_s())


@query("w09_total_rate_at_events", ctes=curve_sql(""), sql="SELECT t, rate, concurrency FROM curve")
def w09(t):
    return curve(t, ()).select("t", "rate", "concurrency")


@query("w10_step_curve", ctes=curve_sql(), sql="""SELECT compressed, t AS from_t, next_t AS to_t, rate FROM curve
    UNION ALL SELECT compressed, min(t), min(t), 0 FROM curve GROUP BY compressed""")
def w10(t):
    return timeline.step_curve(curve(t), ["compressed"])


@query("w11_throughput_integral", ctes=curve_sql(), sql=f"""SELECT compressed, round(mib,3) AS mib, round(s,6) AS span_s, round(mib/s,6) AS mib_s FROM
    (SELECT compressed, {AREA} AS mib, (max(t)-min(t))/1e6::DOUBLE AS s FROM curve GROUP BY compressed)""")
def w11(t):
    out = timeline.integral(curve(t), ["compressed"])
    return out.select("compressed", F.round("mib", 3).alias("mib"), F.round("span_s", 6).alias("span_s"), F.round("mib_s", 6).alias("mib_s"))


OPENING = (
    """mv AS (SELECT compressed, ord, start_us AS t, rate AS delta FROM transfers WHERE rate>0 UNION ALL SELECT compressed, ord, end_us, -rate FROM transfers WHERE rate>0)""",
    """sq AS (SELECT compressed, t, lead(t) OVER w AS next_t, (sum(delta) OVER (ORDER BY t, delta DESC, ord ROWS UNBOUNDED PRECEDING))::BIGINT AS rate FROM mv WINDOW w AS (ORDER BY t, delta DESC, ord))""",
)


@query("w11_integral_by_opening_flag", ctes=OPENING, sql=f"SELECT compressed, round({AREA},3) AS mib FROM sq GROUP BY compressed")
def w11_opening(t):
    return rounded(timeline.opening_flag_integral(t.transfers, "compressed"), 3)


@query("w12_concurrency_levels", ctes=curve_sql(), sql="SELECT compressed, concurrency, count(*) AS n_events, coalesce(sum(next_t-t),0)::BIGINT AS held_us FROM curve GROUP BY ALL")
def w12(t):
    return timeline.concurrency_levels(curve(t), ["compressed"])


@query("w13_elapsed_hours", sql="SELECT ord, (start_us-(SELECT min(start_us) FROM transfers))/3.6e9::DOUBLE AS hours FROM transfers")
def w13(t):
    return timeline.elapsed_hours(t.transfers.select("ord", "start_us"), "start_us").select("ord", "hours")


@query("w13_elapsed_hours_per_run", sql="SELECT run, ord, (start_us-min(start_us) OVER (PARTITION BY run))/3.6e9::DOUBLE AS hours FROM transfers")
def w13_run(t):
    return timeline.elapsed_hours(t.transfers.select("run", "ord", "start_us"), "start_us", ["run"]).select("run", "ord", "hours")


GRID = (
    "o AS (SELECT min(start_us) AS t0, max(end_us) AS t1 FROM transfers)",
    f"k AS (SELECT unnest(range((t1-t0)//{TICK}+1)) AS tick, t0 FROM o)",
    f"""g AS (SELECT tick, t0+tick*{TICK} AS t, coalesce(sum(rate),0)::BIGINT AS rate, count(ord) AS concurrency FROM k LEFT JOIN (SELECT ord, coalesce(rate,0) AS rate, start_us, end_us FROM transfers) x
        ON start_us<=t0+tick*{TICK} AND end_us>=t0+tick*{TICK} GROUP BY tick, t0)""",
)


@query("j12_active_at_ticks", ctes=GRID, sql="SELECT * FROM g")
def j12(t):
    return timeline.grid(t.transfers, TICK)


PROCESS = "SELECT tick, rate/1000.0::DOUBLE*8/1073741824.0::DOUBLE AS g, concurrency AS c FROM g"


@query("w14_rate_per_process", ctes=GRID, sql=f"""SELECT tick, round(CASE WHEN g>=0.05 THEN g END,6) AS total_rate, CASE WHEN g>=0.05 THEN c END AS concurrency,
    round(CASE WHEN g>=0.05 THEN CASE WHEN c>0 THEN g/c ELSE 0 END END,6) AS per_process FROM ({PROCESS})""")
def w14(t):
    return rounded(timeline.per_process(timeline.grid(t.transfers, TICK), 0.05))


def sites(t):
    return t.transfers.withColumns({"site": names.relabel(names.site(F.col("run")), SITE_LABELS), "workers": names.workers(F.col("run")), "threads": names.threads(F.col("run"))})


SITE_SQL = """site_runs AS (SELECT *, CASE split_part(run,'_',2) WHEN 'north' THEN 'North Hall' WHEN 'south' THEN 'South Hall' WHEN 'east' THEN 'East Hall' ELSE 'West Hall' END AS site,
    split_part(split_part(run,'_',-1),'-',1)::INT AS workers, split_part(split_part(run,'_',-1),'-',2)::INT AS threads FROM transfers)"""
PANEL = ["site", "compressed", "workers", "threads"]


@query("w15_rolling_rate_per_panel", ctes=SITE_SQL, sql=f"SELECT site, compressed, workers, threads, ord, {rolled_sql(','.join(PANEL), 20)} AS rolling FROM site_runs")
def w15(t):
    return rounded(ordered.rolling_rows(sites(t).select(*PANEL, "ord", gibit().alias("g")), PANEL, "ord", F.col("g"), 20).select(*PANEL, "ord", "rolling"))


# Run-log telemetry


@query("t01_transfer_rate", sql=f"SELECT ord, round({RATE},9) AS gibit_s FROM transfers")
def t01(t):
    return t.transfers.select("ord", F.round(gibit(), 9).alias("gibit_s"))


SPAN = "(max(end_us)-min(start_us))/1e6::DOUBLE AS s, sum(size)/1073741824.0::DOUBLE AS g"


@query("t02_rate_over_span", sql=f"SELECT compressed, round(s,6) AS span_s, round(g,6) AS gib, round(g*8/s,9) AS gibit_s FROM (SELECT compressed, {SPAN} FROM transfers GROUP BY 1)")
def t02(t):
    out = timeline.span_rates(t.transfers, ["compressed"])
    return out.select("compressed", F.round("span_s", 6).alias("span_s"), F.round("gib", 6).alias("gib"), F.round("gibit_s", 9).alias("gibit_s"))


@query("t02_rate_over_whole_span", sql=f"SELECT round(s,6) AS span_s, round(g,6) AS gib, round(g*8/s,9) AS gibit_s FROM (SELECT {SPAN} FROM transfers)")
def t02_all(t):
    out = timeline.span_rates(t.transfers)
    return out.select(F.round("span_s", 6).alias("span_s"), F.round("gib", 6).alias("gib"), F.round("gibit_s", 9).alias("gibit_s"))


@query("t03_throughput_grid", ctes=GRID, sql=f"SELECT tick, round(g,6) AS total_rate, c AS concurrency, round(CASE WHEN c>0 THEN g/c ELSE 0 END,6) AS per_process FROM ({PROCESS})")
def t03(t):
    return rounded(timeline.per_process(timeline.grid(t.transfers, TICK), 0.0))


@query("t04_sweep_totals", ctes=curve_sql(""), sql=f"SELECT round(mib,3) AS mib, round(s,6) AS span_s, round(mib/s,6) AS mib_s FROM (SELECT {AREA} AS mib, (max(t)-min(t))/1e6::DOUBLE AS s FROM curve)")
def t04(t):
    out = timeline.integral(curve(t, ()), [])
    return out.select(F.round("mib", 3).alias("mib"), F.round("span_s", 6).alias("span_s"), F.round("mib_s", 6).alias("mib_s"))


@query("t05_smoothed_total_speed", ctes=curve_sql("run"), sql="""SELECT run, t, (t-min(t) OVER ())/3.6e9::DOUBLE AS hours, round(avg(rate) OVER (PARTITION BY run ORDER BY t RANGE BETWEEN 3599999999 PRECEDING AND CURRENT ROW)/1048576000.0::DOUBLE,6) AS mib_s FROM curve""")
def t05(t):
    smooth = timeline.smoothed(curve(t, ("run",)), ["run"])
    return timeline.elapsed_hours(smooth, "t").select("run", "t", "hours", mib_s())


@query("t06_concurrency_of_runs", ctes=curve_sql("run"), sql="SELECT run, concurrency, count(*) AS n_events, coalesce(sum(next_t-t),0)::BIGINT AS held_us FROM curve GROUP BY ALL")
def t06(t):
    return timeline.concurrency_levels(curve(t, ("run",)), ["run"])


@query("t07_rate_histogram", ctes=(f"r AS (SELECT kind, compressed, {RATE}*1000000 AS micro FROM transfers)", *bins_sql("micro", "r", 100)),
       sql="SELECT kind, compressed, bin, round(from_value,3) AS from_value, round(to_value,3) AS to_value, n FROM h")
def t07(t):
    return rounded(stats.histogram(t.transfers.withColumn("micro", gibit() * 1_000_000), ["kind", "compressed"], "micro", 100), 3)


@query("t07_members_histogram", ctes=("r AS (SELECT 1 AS one, try_cast(FILES_PER_ZIP AS BIGINT) AS members FROM upload_log)", *bins_sql("members", "r", 50, "one")),
       sql="SELECT bin, round(from_value,6) AS from_value, round(to_value,6) AS to_value, n FROM h")
def t07_members(t):
    return rounded(stats.histogram(t.upload_log.select(F.col("FILES_PER_ZIP").try_cast("bigint").alias("members")), [], "members", 50))


@query("t08_size_rate_pairs", sql=f"SELECT ord, kind, size/1048576.0::DOUBLE AS mib, round({RATE},6) AS gibit_s FROM transfers")
def t08(t):
    return t.transfers.select("ord", "kind", units.mib(F.col("size")).alias("mib"), F.round(gibit(), 6).alias("gibit_s"))


@query("t09_multi_run_load", ctes=SITE_SQL, sql=f"SELECT ord, site, workers, threads, kind, compressed, round({RATE},6) AS gibit_s, rate FROM site_runs")
def t09(t):
    return rounded(tables.transfers(t.upload_log, SITE_LABELS).select("ord", "site", "workers", "threads", "kind", "compressed", "gibit_s", "rate"))


@query("t10_rates_by_setup", ctes=SITE_SQL, sql=f"SELECT site, compressed, workers, threads, count(*) AS n, round(avg({RATE}),6) AS mean_gibit_s, sum(size)::BIGINT AS bytes FROM site_runs GROUP BY ALL")
def t10(t):
    return sites(t).groupBy(*PANEL).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(gibit()), 6).alias("mean_gibit_s"), F.sum("size").alias("bytes"))


def line(pattern, i):
    return f"try_cast(regexp_extract(value,'{pattern}',{i}) AS DOUBLE)"


TR = "^([0-9.]+) MiB uploaded in ([0-9.]+) seconds, ([0-9.]+) MiB/s"
FO = "uploaded in [0-9.]+ seconds, ([0-9.]+) s/file"
PARSED = f"""tl AS (SELECT file, line_no, {line(TR, 1)} AS mib, {line(TR, 2)} AS seconds, {line(TR, 3)} AS mib_s FROM run_lines WHERE contains(value,'MiB uploaded in')),
    setup AS (SELECT file, string_split(file,'_') AS w, regexp_replace(string_split(file,'_')[-1],'[^0-9]','','g')::INT AS cpus FROM (SELECT DISTINCT file FROM run_lines))"""
DATASET = """CASE WHEN list_contains(w,'merged') THEN 'VHS-merged' WHEN list_contains(w,'vhs') THEN 'CSV-VHS' WHEN list_contains(w,'1perc') THEN 'Dummy Data 1% Small Files'
    WHEN list_contains(w,'10perc') THEN 'Dummy Data 10% Small Files' ELSE 'Dummy Data 25% Small Files' END"""
SUMMARY = (PARSED, f"""s AS (SELECT file, {DATASET} AS dataset, cpus, w[1]<>'no-collate' AS collated, w[1] NOT IN ('no-collate','no-compression') AS compressed,
    tot.k AS total_files, tot.m AS total_mib, tot.f AS s_per_file, n_transfers, total_us/1e6::DOUBLE AS total_s, cs/100.0::DOUBLE/n_transfers AS mean_transfer_s, speed AS mean_transfer_mib_s, cm/cs AS overall_transfer_mib_s
    FROM setup JOIN (SELECT file, count(*) AS n_transfers, sum(round(seconds*100)::BIGINT) AS cs, sum(round(mib*100)::BIGINT) AS cm, avg(mib/seconds) AS speed FROM tl GROUP BY file) USING (file)
    JOIN (SELECT file, regexp_extract(value,'Total: ([0-9]+) files',1)::BIGINT AS k, {line('files; ([0-9.]+) MiB', 1)} AS m, {line('; ([0-9.]+) s/file', 1)} AS f FROM run_lines WHERE contains(value,'Total:')) tot USING (file)
    JOIN (SELECT file, epoch_us(TIMESTAMP '1970-01-01'+regexp_extract(value,'elapsed time = ([0-9:.]+)',1)::INTERVAL) AS total_us FROM run_lines WHERE contains(value,'Finished at')) USING (file))""")


@query("a20_run_summary", ctes=SUMMARY, sql="""SELECT file, dataset, cpus, collated, compressed, total_files, round(total_mib,6) AS total_mib, round(s_per_file,6) AS s_per_file, n_transfers, round(total_s,6) AS total_s,
    round(total_mib/total_s,6) AS mib_s, round(mean_transfer_s,6) AS mean_transfer_s, round(mean_transfer_mib_s,6) AS mean_transfer_mib_s, round(overall_transfer_mib_s,6) AS overall_transfer_mib_s,
    round(total_s-mean_transfer_s*total_files,6) AS overhead_s FROM s""")
def a20(t):
    out = rounded(runs.run_summary(t.run_lines))
    # A sum that should vanish may round to minus zero.
    return out.withColumn("overhead_s", F.col("overhead_s") + 0.0)


def readings(t):
    parsed = runs.parse_lines(t.run_lines).filter("form = 'transfer'")
    tokens = F.split("file", "_")
    return parsed.select(names.label_ladder(tokens).alias("dataset"), names.digits(F.element_at(tokens, -1)).cast("int").alias("cpus"), (F.col("mib_s") * 8).alias("rate"))


MEANS = (PARSED, f"m AS (SELECT {DATASET} AS dataset, cpus, avg(mib_s*8) AS rate FROM tl JOIN setup USING (file) GROUP BY ALL)")


@query("a21_mean_rates", ctes=MEANS, sql="SELECT dataset, cpus, round(rate,6) AS rate, round(rate*cpus,6) AS total_rate FROM m")
def a21(t):
    return rounded(runs.mean_rates(readings(t), ["dataset", "cpus"]))


SPEEDUP = "SELECT a.dataset, a.cpus, round(a.rate,6) AS rate, round(a.rate*a.cpus/b.rate,6) AS speed_up FROM m a JOIN m b ON a.dataset=b.dataset AND b.cpus=1"


@query("j11_speed_up_join", ctes=MEANS, sql=SPEEDUP)
def j11(t):
    means = readings(t).groupBy("dataset", "cpus").agg(F.avg("rate").alias("rate"))
    return rounded(runs.parallel_speed_up(means, ["dataset"]))


TITLES = """t AS (SELECT nullif(regexp_extract(title,'([0-9]+)MiB-[0-9]+GiB',1),'')::INT AS file_mib, nullif(regexp_extract(title,'_([0-9]+)-procs',1),'')::INT AS n_procs,
    nullif(regexp_extract(title,'([0-9]+)fpf',1),'')::INT AS files_per_folder, avg(rate) AS rate FROM titled GROUP BY 1, 2, 3)"""


def by_title(t):
    figures = names.title_figures(F.col("title"))
    return t.titled.groupBy(*[c.alias(n) for n, c in figures.items()]).agg(F.avg("rate").alias("rate"))


@query("f16_title_figures", sql="""SELECT DISTINCT title, nullif(regexp_extract(title,'([0-9]+)MiB-[0-9]+GiB',1),'')::INT AS file_mib,
    nullif(regexp_extract(title,'_([0-9]+)-procs',1),'')::INT AS n_procs, nullif(regexp_extract(title,'([0-9]+)fpf',1),'')::INT AS files_per_folder FROM titled""")
def f16_title(t):
    return t.titled.select("title").distinct().withColumns(names.title_figures(F.col("title")))


@query("a21_rates_by_file_size", ctes=TITLES, sql="SELECT file_mib, files_per_folder, n_procs, round(rate,6) AS rate, round(rate*n_procs,6) AS total_rate FROM t WHERE file_mib IS NOT NULL")
def a21_size(t):
    known = by_title(t).filter("file_mib is not null")
    return rounded(runs.mean_rates(known.withColumnRenamed("rate", "r"), ["file_mib", "files_per_folder", "n_procs"], "r", "n_procs"))


@query("j11_speed_up_by_file_size", ctes=TITLES, sql="""SELECT a.file_mib, a.files_per_folder, a.n_procs, round(a.rate*a.n_procs/b.rate,6) AS speed_up
    FROM t a JOIN t b ON a.file_mib=b.file_mib AND a.files_per_folder=b.files_per_folder AND b.n_procs=1""")
def j11_size(t):
    fast = runs.parallel_speed_up(by_title(t), ["file_mib", "files_per_folder"], "n_procs")
    return rounded(fast.select("file_mib", "files_per_folder", "n_procs", "speed_up"))


@query("t11_parallel_speed_up", ctes=SUMMARY, sql="""SELECT a.file, a.cpus, round(a.mib_s*a.cpus/b.mib_s,6) AS speed_up FROM (SELECT *, total_mib/total_s AS mib_s FROM s) a
    JOIN (SELECT dataset, collated, compressed, avg(total_mib/total_s) AS mib_s FROM s WHERE cpus=1 GROUP BY ALL) b USING (dataset, collated, compressed)""")
def t11(t):
    summary = runs.run_summary(t.run_lines).select("file", "dataset", "collated", "compressed", "cpus", F.col("mib_s").alias("rate"))
    return rounded(runs.parallel_speed_up(summary, ["dataset", "collated", "compressed"]).select("file", "cpus", "speed_up"))


@query("t12_strategy_comparison", ctes=SUMMARY, sql="SELECT dataset, cpus, collated, compressed, count(*) AS n_runs, round(avg(total_s),6) AS total_s, round(avg(total_mib/total_s),6) AS mib_s FROM s GROUP BY ALL")
def t12(t):
    return rounded(runs.strategy_comparison(runs.run_summary(t.run_lines)))


@query("t13_overhead", ctes=SUMMARY, sql="SELECT file, round(total_s-mean_transfer_s*total_files,6) AS overhead_s FROM s")
def t13(t):
    return runs.run_summary(t.run_lines).select("file", (F.round("overhead_s", 6) + 0.0).alias("overhead_s"))


@query("t14_file_size_profile", ctes=("f AS (SELECT 1 AS one, size FROM files)", *bins_sql("size", "f", 50, "one")), sql="SELECT bin, round(from_value,6) AS from_value, round(to_value,6) AS to_value, n FROM h")
def t14(t):
    return rounded(stats.histogram(t.files, [], "size", 50))


@query("t14_file_size_describe", ctes="f AS (SELECT 1 AS one, size FROM files)", sql="SELECT * EXCLUDE (one) FROM (" + described("size", "f", "one") + ")")
def t14_describe(t):
    return rounded(stats.describe(t.files, [], "size"), 3)


@query("t15_rate_lines", ctes=f"""l AS (SELECT file, line_no, 'transfer' AS form, {line(TR, 3)}*8 AS reading FROM run_lines WHERE contains(value,'MiB uploaded in')
    UNION ALL SELECT file, line_no, 'folder', {line(FO, 1)} FROM run_lines WHERE contains(value,'MiB/file')), z AS (SELECT *, avg(reading) OVER w AS a, count(*) OVER w AS c FROM l WINDOW w AS (PARTITION BY file, form ORDER BY line_no ROWS 9 PRECEDING))""",
    sql="SELECT file, line_no, form, round(reading,6) AS reading, round(a,6) AS smoothed FROM z WHERE c=10")
def t15(t):
    return rounded(runs.rate_lines(t.run_lines))
