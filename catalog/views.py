"""The given tables seen as listings, manifests, logs and snapshots.

Each view exists twice: as a DataFrame (``Tables``) and as SQL (``SQL``), so a
query and its check start from the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from invspark.functions import manifests, names, paths, times, units, values
from invspark.operators import ordered
from invspark.session import spread

ROOT = "/data"
DEST = "backup"
LAKE = "lake"
SITES = ["north", "south", "east", "west"]
SITE_LABELS = {"north": "North Hall", "south": "South Hall", "east": "East Hall", "west": "West Hall"}
MEMBERS_PER_ZIP = 25
# Bytes of a segment: as sent, and as the store cut some objects anew.
SEGMENT, RECUT = 1000, 700


def div(column, n: int) -> Column:
    """Integer division that stays exact for large longs."""
    return F.call_function("div", column, F.lit(n)).cast("long")


def hundredths(cents) -> Column:
    return F.concat(div(cents, 100).cast("string"), F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        # Stored times carry no zone; reading them as UTC keeps the microsecond values.
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def listing(self) -> DataFrame:
        docs = self.table("documents")
        path = F.concat(F.lit(ROOT + "/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
        own = docs.select(F.col("doc_id").alias("ord"), path.alias("path"), F.col("n_chars").alias("size"))
        after = docs.select((F.col("doc_id") - 1).alias("ord"), path.alias("next_path"))
        is_link = (F.col("ord") % 50).isin(0, 1)
        return own.join(after, "ord", "left").select(
            "ord",
            "path",
            is_link.alias("is_link"),
            F.when(is_link, F.col("next_path")).alias("link_target"),
            paths.object_name(F.col("path"), ROOT, DEST).alias("object_name"),
            "size",
        )

    @cached_property
    def files(self) -> DataFrame:
        """The listing without its link columns: no self join behind it."""
        return self.table("documents").select(
            F.col("doc_id").alias("ord"),
            F.concat(F.lit(ROOT + "/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
            F.concat(F.lit(DEST + "/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("object_name"),
            F.col("n_chars").alias("size"),
        )

    @cached_property
    def contents(self) -> DataFrame:
        docs = self.table("documents")
        return docs.select(
            F.col("doc_id").alias("ord"),
            F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("member"),
            F.col("text").cast("binary").alias("content"),
        )

    @cached_property
    def remote(self) -> DataFrame:
        docs, labels = self.table("documents"), self.table("labels")
        md5 = F.md5(F.col("text").cast("binary"))
        etag = (
            F.when(F.col("quality") == 0, F.concat(md5, F.lit("-2")))
            .when(F.col("toxic") == 1, F.md5(F.concat("text", F.lit("?")).cast("binary")))
            .otherwise(md5)
        )
        return docs.join(labels, "doc_id").select(
            F.lit("store").alias("bucket"),
            F.concat(F.lit(DEST + "/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("key"),
            F.col("n_chars").alias("size"),
            etag.alias("etag"),
            (F.col("doc_id") * 3_600_000_000).alias("modified_us"),
        )

    @cached_property
    def page_objects(self) -> DataFrame:
        return self.table("pages").select(
            F.col("page_id").alias("ord"),
            F.regexp_replace("url", "^https?://", "").alias("key"),
            F.length("html").cast("long").alias("size"),
        )

    @cached_property
    def manifest(self) -> DataFrame:
        number = div(F.col("ord"), MEMBERS_PER_ZIP)
        names_ = F.transform(F.array_sort(F.collect_list(F.struct("ord", "name"))), lambda m: m["name"])
        text = (
            F.when(F.col("zip_no") % 13 == 12, F.lit(None).cast("string"))
            .when(F.col("zip_no") % 5 == 4, F.array_join("names", ","))
            .when(F.col("zip_no") % 6 == 5, F.array_join("names", ";"))
            .otherwise(F.array_join("names", "|"))
        )
        return (
            self.files.select("ord", F.substring("path", F.lit(len(ROOT) + 2), F.length("path")).alias("name"), number.alias("zip_no"))
            .groupBy("zip_no")
            .agg(names_.alias("names"))
            .select(paths.archive_key(F.col("zip_no"), DEST).alias("zip_key"), text.alias("text"))
        )

    @cached_property
    def store(self) -> DataFrame:
        zips = self.manifest.select(F.col("zip_key").alias("key"))
        return self.remote.select("key").unionByName(zips).unionByName(
            zips.select(F.concat("key", F.lit(".metadata")).alias("key"))
        )

    @cached_property
    def packed(self) -> DataFrame:
        """Exploded manifests at size: one archive per order, one member per line."""
        return self.distinct_lines().select(paths.archive_key(F.col("l_orderkey"), LAKE).alias("zip_key"), self._lake_member().alias("member"))

    def distinct_lines(self, condition: str = "true") -> DataFrame:
        # Distinct before strings are built: four numbers are cheaper to shuffle and compare.
        lines = self.table("lineitem").filter(condition).select("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey")
        return spread(lines, self.table("lineitem").count(), *lines.columns).distinct()

    @staticmethod
    def _lake_member() -> Column:
        return F.concat(F.lit(LAKE + "/"), F.concat_ws("-", "l_partkey", "l_linenumber", "l_suppkey"))

    @cached_property
    def lake(self) -> DataFrame:
        """Store listing at size: members, archives and manifests, each key with its class."""
        lines, orders = self.table("lineitem"), self.table("orders")
        members = (
            lines.filter(F.col("l_returnflag") != "R")
            .groupBy("l_partkey", "l_linenumber", "l_suppkey")
            .agg(F.max(F.floor("l_extendedprice").cast("long")).alias("size"))
            .select(self._lake_member().alias("key"), "size", F.lit("other").alias("kind"))
        )
        zips = orders.filter(F.col("o_orderstatus") != "P").select(
            paths.archive_key(F.col("o_orderkey"), LAKE).alias("key"), F.floor("o_totalprice").cast("long").alias("size"), F.lit("zip").alias("kind")
        )
        notes = orders.select(
            F.concat(paths.archive_key(F.col("o_orderkey"), LAKE), F.lit(".metadata")).alias("key"),
            F.lit(64).cast("long").alias("size"), F.lit("manifest").alias("kind"),
        )
        return members.unionByName(zips).unionByName(notes)

    @cached_property
    def whole_lake(self) -> DataFrame:
        """The same store without gaps: every line, order and manifest."""
        members = (
            self.table("lineitem").groupBy("l_partkey", "l_linenumber", "l_suppkey")
            .agg(F.max(F.floor("l_extendedprice").cast("long")).alias("size"))
            .select(self._lake_member().alias("key"), "size")
        )
        archive = paths.archive_key(F.col("o_orderkey"), LAKE)
        both = F.array(
            F.struct(archive.alias("key"), F.floor("o_totalprice").cast("long").alias("size")),
            F.struct(F.concat(archive, F.lit(".metadata")).alias("key"), F.lit(64).cast("long").alias("size")),
        )
        return members.unionByName(self.table("orders").select(F.inline(both)))

    @cached_property
    def stored(self) -> DataFrame:
        """A store that holds every document, some altered or in segments."""
        docs, md5 = self.table("documents"), F.md5(F.col("text").cast("binary"))
        etag = (
            F.when(F.col("doc_id") % 11 == 0, F.concat(md5, F.lit("-2")))
            .when(F.col("doc_id") % 7 == 0, F.md5(F.concat("text", F.lit("?")).cast("binary")))
            .otherwise(md5)
        )
        return docs.select(
            F.concat(F.lit(DEST + "/"), "source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("key"),
            F.col("n_chars").alias("size"), etag.alias("etag"), (F.col("doc_id") * 3_600_000_000).alias("modified_us"),
        )

    @cached_property
    def segmented(self) -> DataFrame:
        """Objects sent in segments, as they lie in the store: some altered, some cut anew, some with a wrong etag, some gone."""
        id, content = F.col("ord"), F.col("content")
        size = F.octet_length(content)
        altered = (
            F.when(id % 7 == 0, F.concat(content, F.lit(b"?")))
            .when((id % 13 == 0) & (size > 0), F.concat(F.substring(content, F.lit(1), size - 1), F.lit(b"#")))
            .otherwise(content)
        )
        etag = F.when(id % 11 == 0, values.segmented_etag(F.col("stored"), RECUT)).otherwise(values.segmented_etag(F.col("stored"), SEGMENT))
        wrong = F.concat(F.md5("stored"), F.lit("-"), values.segment_count(F.col("etag")).cast("string"))
        rows = self.contents.filter(id % 19 != 0).select("ord", "member", altered.alias("stored")).withColumn("etag", etag)
        return rows.select(F.concat(F.lit(DEST + "/"), "member").alias("key"), "stored", F.octet_length("stored").cast("long").alias("size"), F.when(id % 17 == 0, wrong).otherwise(F.col("etag")).alias("etag"))

    @cached_property
    def checks(self) -> DataFrame:
        """A check of every logged object."""
        return self.upload_log.select(
            "DESTINATION_KEY", "CHECKSUM", (F.col("ord") % 7 != 0).alias("CHECKSUM_MATCH"), (F.col("ord") % 11 != 0).alias("SIZE_MATCH")
        )

    @cached_property
    def upload_log(self) -> DataFrame:
        e = self.table("events")
        user, event = F.col("user_id"), F.col("event_id")
        is_zip = F.col("event_type").isin("click", "view")
        extension = F.when(is_zip, ".zip").when(F.col("event_type") == "error", ".symlink").otherwise(".dat")
        pick = lambda values, i: F.element_at(F.array(*[F.lit(v) for v in values]), (i + 1).cast("int"))
        n_members = event % 9 + 1
        run = F.concat(
            F.lit("x_"), pick(SITES, user % 4), F.lit("_"), pick(["Comp", "NoComp"], div(user, 4) % 2), F.lit("_"),
            pick(["8", "16", "32"], div(user, 8) % 3), F.lit("-"), pick(["1", "2"], div(user, 24) % 2),
        )
        folder = F.concat(F.lit(ROOT + "/run"), (user % 4).cast("string"), F.lit("/u"), user.cast("string"))
        members = F.transform(F.sequence(F.lit(1).cast("long"), n_members), lambda i: F.concat(F.lit("m"), i.cast("string")))
        start = F.unix_micros(F.col("ts").cast("timestamp"))
        return e.select(
            event.alias("ord"),
            folder.alias("LOCAL_FOLDER"),
            F.concat(folder, F.lit("/"), event.cast("string"), extension).alias("LOCAL_PATH"),
            ((event * 7919 % 1000 + 1) * 1_048_576).alias("FILE_SIZE"),
            run.alias("BUCKET_NAME"),
            F.concat(user.cast("string"), F.lit("/"), (event % 40).cast("string"), extension).alias("DESTINATION_KEY"),
            F.md5(F.col("props").cast("binary")).alias("CHECKSUM"),
            F.when(is_zip, F.array_join(members, "|")).alias("ZIP_CONTENTS"),
            F.when(is_zip, n_members.cast("string")).otherwise("n/a").alias("FILES_PER_ZIP"),
            F.col("value").alias("UPLOAD_TIME"),
            start.alias("start_us"),
            (start + F.round(F.col("value") * 1_000_000.0).cast("long")).alias("end_us"),
        )

    @cached_property
    def transfers(self) -> DataFrame:
        """The log with typed columns: one transfer per row."""
        run, kind = F.col("BUCKET_NAME"), names.transfer_type(F.col("LOCAL_PATH"))
        duration = F.col("end_us") - F.col("start_us")
        return self.upload_log.select(
            "ord",
            run.alias("run"),
            kind.alias("kind"),
            names.compression_used(kind, run).alias("compressed"),
            F.col("FILE_SIZE").alias("size"),
            F.col("UPLOAD_TIME").alias("seconds"),
            "start_us",
            "end_us",
            duration.alias("dur_us"),
            units.milli_rate(F.col("FILE_SIZE"), duration).alias("rate"),
        )

    @cached_property
    def verification(self) -> DataFrame:
        done = self.table("events").filter(F.col("event_type").isin("click", "purchase")).select("event_id")
        return (
            self.upload_log.join(done, F.col("ord") == F.col("event_id"))
            .select(
                "DESTINATION_KEY",
                "CHECKSUM",
                (F.col("ord") % 7 != 0).alias("CHECKSUM_MATCH"),
                (F.col("ord") % 11 != 0).alias("SIZE_MATCH"),
            )
        )

    @cached_property
    def log_keys(self) -> DataFrame:
        c = self.table("customer")
        suffix = F.when(F.col("c_nationkey") % 2 == 0, "-backup.csv").otherwise("-files.csv")
        modified = (F.col("c_custkey") * 60_000_000).alias("modified_us")
        logs = c.select(F.concat("c_name", suffix).alias("key"), modified)
        checks = c.filter(F.col("c_acctbal") > 0).select(F.concat("c_name", F.lit("-backup-verification.csv")).alias("key"), modified)
        nested = c.filter(F.col("c_mktsegment") == "MACHINERY").select(F.concat(F.lit("old/"), "c_name", F.lit("-backup.csv")).alias("key"), modified)
        return logs.unionByName(checks).unionByName(nested)

    @cached_property
    def titled(self) -> DataFrame:
        """Readings (title, rate) of runs whose titles name file size, connections and files per folder."""
        pick = lambda by, *choices: F.element_at(F.array(*[F.lit(x) for x in choices]), (F.col(by) % len(choices) + 1).cast("int"))
        size = F.when(F.col("o_custkey") % 11 == 0, "mixed").otherwise(F.concat(pick("o_custkey", "34", "64", "128", "256", "512"), F.lit("MiB-100GiB")))
        title = F.concat(size, F.lit("_"), pick("o_orderkey", "1", "2", "4", "8", "12"), F.lit("-procs_"), pick("o_orderkey", "1", "2"), F.lit("fpf"))
        return self.table("orders").select(title.alias("title"), F.round(F.col("o_totalprice") * 100).cast("long").alias("rate"))

    @cached_property
    def run_lines(self) -> DataFrame:
        """Text logs of many runs, one line per row."""
        o = self.table("orders")
        cents = F.round(F.col("o_totalprice") * 100).cast("long")
        secs = (F.col("o_custkey") % 10 + 1) * 100 + 25
        strategy = F.when(F.col("o_orderstatus") == "F", "no-collate").when(F.col("o_orderstatus") == "O", "no-compression").otherwise("collate")
        tokens = (
            F.when(F.startswith("o_orderpriority", F.lit("1")), "dummy-data_1perc")
            .when(F.startswith("o_orderpriority", F.lit("2")), "dummy-data_10perc")
            .when(F.startswith("o_orderpriority", F.lit("3")), "dummy-data_25perc")
            .when(F.startswith("o_orderpriority", F.lit("4")), "vhs_merged")
            .otherwise("vhs")
        )
        cpus = F.element_at(F.array(*[F.lit(x) for x in ("1", "2", "4", "8", "12")]), (F.col("o_custkey") % 5 + 1).cast("int"))
        base = o.select(
            F.concat_ws("_", strategy, tokens, F.concat(cpus, F.lit("-procs"))).alias("file"),
            F.col("o_orderkey").alias("n"), cents.alias("cents"), secs.alias("secs"),
        )
        line = lambda number, *parts: F.struct(number.cast("long").alias("line_no"), F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts]).alias("value"))
        cents, secs, n = F.col("cents"), F.col("secs"), F.col("n")
        rate = hundredths(F.call_function("div", cents * 100, secs))
        each = base.select("file", F.inline(F.array(
            line(n * 2, hundredths(cents), " MiB uploaded in ", hundredths(secs), " seconds, ", rate, " MiB/s"),
            line(n * 2 + 1, "2 files (avg ", hundredths(div(cents, 2)), " MiB/file) uploaded in ", hundredths(secs), " seconds, ", hundredths(div(secs, 2)), " s/file"),
        )))
        total = base.groupBy("file").agg(F.count(F.lit(1)).alias("k"), F.sum("cents").alias("cents"), F.sum("secs").alias("secs"))
        pad = lambda c, w: F.lpad(c.cast("string"), w, "0")
        clock = F.concat(div(secs, 360_000).cast("string"), F.lit(":"), pad(div(secs, 6000) % 60, 2), F.lit(":"), pad(div(secs, 100) % 60, 2), F.lit("."), pad(secs % 100 * 10_000, 6))
        closing = total.select("file", F.inline(F.array(
            line(F.lit(1_000_000_000_000), "Finished at 2001-02-03 04:05:06.000007, elapsed time = ", clock),
            line(F.lit(1_000_000_000_001), "Total: ", F.col("k").cast("string"), " files; ", hundredths(cents), " MiB; ", rate,
                 " MiB/s including setup time; ", hundredths(F.call_function("div", secs, F.col("k"))), " s/file including setup time"),
        )))
        return each.unionByName(closing)

    @cached_property
    def snapshots(self) -> DataFrame:
        """Hourly totals of the growing store."""
        hour = div(F.col("start_us"), 3_600_000_000)
        added = self.upload_log.groupBy(hour.alias("hour")).agg(
            F.count(F.lit(1)).alias("n"), F.sum("FILE_SIZE").alias("b")
        )
        run = ordered.scan(added, [], "hour", sums={"sn": F.col("n"), "sb": F.col("b")}, shifts=(16,))
        return run.select(
            (F.col("hour") * 3_600_000_000).alias("taken_us"),
            (F.col("sn") + F.col("n")).alias("files"),
            (F.col("sb") + F.col("b")).alias("bytes"),
        )

    @cached_property
    def old_logs(self) -> DataFrame:
        """Log folders of many machines: one file per order, dated."""
        return self.table("orders").select(
            F.concat(F.lit("/logs/"), F.col("o_custkey").cast("string")).alias("folder"),
            F.concat(F.lit("backup-logs-"), F.col("o_orderkey").cast("string"), F.lit(".csv")).alias("name"),
            F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("modified_us"),
        )


_PATH = "source||'/'||lang||'/'||doc_id||'.txt'"
_MEMBER = "'lake/'||l_partkey||'-'||l_linenumber||'-'||l_suppkey"


def _two_level(source: str, cut: str) -> str:
    """(doc_id, n, etag) of hex contents ``h`` cut every ``cut`` bytes."""
    return f"""SELECT doc_id, count(*) AS n, CASE WHEN count(*)=1 THEN min(d) ELSE md5(unhex(string_agg(d,'' ORDER BY i)))||'-'||count(*) END AS etag
        FROM (SELECT doc_id, i, md5(unhex(substr(h,2*i*{cut}+1,2*{cut}))) AS d FROM (SELECT *, unnest(range(greatest(1,ceil(length(h)/2/{cut})::BIGINT))) AS i FROM {source})) GROUP BY doc_id"""


def _c(x):
    return f"(({x})//100)||'.'||lpad((({x})%100)::VARCHAR,2,'0')"


SQL: dict[str, str] = {
    "listing": f"""SELECT d.doc_id AS ord, '/data/'||d.source||'/'||d.lang||'/'||d.doc_id||'.txt' AS path, d.doc_id%50 IN (0,1) AS is_link,
        CASE WHEN d.doc_id%50 IN (0,1) THEN '/data/'||n.source||'/'||n.lang||'/'||n.doc_id||'.txt' END AS link_target,
        'backup/'||d.source||'/'||d.lang||'/'||d.doc_id||'.txt' AS object_name, d.n_chars AS size
        FROM documents d LEFT JOIN documents n ON n.doc_id=d.doc_id+1""",
    "files": f"SELECT doc_id AS ord, '/data/'||{_PATH} AS path, 'backup/'||{_PATH} AS object_name, n_chars AS size FROM documents",
    "remote": f"""SELECT 'store' AS bucket, 'backup/'||{_PATH} AS key, n_chars AS size,
        CASE WHEN quality=0 THEN md5(text)||'-2' WHEN toxic=1 THEN md5(text||'?') ELSE md5(text) END AS etag,
        d.doc_id*3600000000 AS modified_us FROM documents d JOIN labels l ON d.doc_id=l.doc_id""".replace("||doc_id||", "||d.doc_id||"),
    "page_objects": "SELECT page_id AS ord, regexp_replace(url,'^https?://','') AS key, length(html)::BIGINT AS size FROM pages",
    "manifest_names": f"""SELECT doc_id//25 AS zip_no, 'backup/collated_'||(doc_id//25)||'.zip' AS zip_key, doc_id AS ord, {_PATH} AS name FROM documents""",
    "manifest": """SELECT zip_key, CASE WHEN zip_no%13=12 THEN NULL WHEN zip_no%5=4 THEN string_agg(name,',' ORDER BY ord)
        WHEN zip_no%6=5 THEN string_agg(name,';' ORDER BY ord) ELSE string_agg(name,'|' ORDER BY ord) END AS text
        FROM manifest_names GROUP BY zip_no, zip_key""",
    "store": """SELECT key FROM remote UNION ALL SELECT zip_key FROM manifest UNION ALL SELECT zip_key||'.metadata' FROM manifest""",
    "packed": f"SELECT DISTINCT 'lake/collated_'||l_orderkey||'.zip' AS zip_key, {_MEMBER} AS member FROM lineitem",
    "lake": f"""SELECT {_MEMBER} AS key, max(floor(l_extendedprice)::BIGINT) AS size FROM lineitem WHERE l_returnflag<>'R' GROUP BY 1
        UNION ALL SELECT 'lake/collated_'||o_orderkey||'.zip', floor(o_totalprice)::BIGINT FROM orders WHERE o_orderstatus<>'P'
        UNION ALL SELECT 'lake/collated_'||o_orderkey||'.zip.metadata', 64 FROM orders""",
    "whole_lake": f"""SELECT {_MEMBER} AS key, max(floor(l_extendedprice)::BIGINT) AS size FROM lineitem GROUP BY 1
        UNION ALL SELECT 'lake/collated_'||o_orderkey||'.zip', floor(o_totalprice)::BIGINT FROM orders
        UNION ALL SELECT 'lake/collated_'||o_orderkey||'.zip.metadata', 64 FROM orders""",
    "stored": f"""SELECT 'backup/'||{_PATH} AS key, n_chars AS size,
        CASE WHEN doc_id%11=0 THEN md5(text)||'-2' WHEN doc_id%7=0 THEN md5(text||'?') ELSE md5(text) END AS etag, doc_id*3600000000 AS modified_us FROM documents""",
    "sent_hex": f"SELECT doc_id, 'backup/'||{_PATH} AS key, hex(encode(text)) AS h FROM documents",
    "stored_hex": """SELECT doc_id, key, CASE WHEN doc_id%7=0 THEN h||'3F' WHEN doc_id%13=0 AND h<>'' THEN substr(h,1,length(h)-2)||'23' ELSE h END AS h,
        CASE WHEN doc_id%11=0 THEN 700 ELSE 1000 END AS cut FROM sent_hex WHERE doc_id%19<>0""",
    "sent_etags": _two_level("sent_hex", "1000"),
    "segmented": f"""SELECT s.*, length(h)//2 AS size, n, CASE WHEN doc_id%17=0 THEN md5(unhex(h))||'-'||n ELSE etag END AS etag
        FROM stored_hex s JOIN ({_two_level("stored_hex", "cut").replace("GROUP BY doc_id", "GROUP BY doc_id, cut")}) USING (doc_id)""",
    "checks": "SELECT DESTINATION_KEY, CHECKSUM, ord%7<>0 AS CHECKSUM_MATCH, ord%11<>0 AS SIZE_MATCH FROM upload_log",
    "upload_log": """SELECT event_id AS ord, '/data/run'||(user_id%4)||'/u'||user_id AS LOCAL_FOLDER,
        '/data/run'||(user_id%4)||'/u'||user_id||'/'||event_id||ext AS LOCAL_PATH,
        (event_id*7919%1000+1)*1048576 AS FILE_SIZE,
        'x_'||['north','south','east','west'][user_id%4+1]||'_'||['Comp','NoComp'][user_id//4%2+1]||'_'||['8','16','32'][user_id//8%3+1]
          ||'-'||['1','2'][user_id//24%2+1] AS BUCKET_NAME,
        user_id||'/'||(event_id%40)||ext AS DESTINATION_KEY, md5(props) AS CHECKSUM,
        CASE WHEN ext='.zip' THEN array_to_string(list_transform(range(1,event_id%9+2), lambda i: 'm'||i),'|') END AS ZIP_CONTENTS,
        CASE WHEN ext='.zip' THEN (event_id%9+1)::VARCHAR ELSE 'n/a' END AS FILES_PER_ZIP,
        value AS UPLOAD_TIME, epoch_us(ts) AS start_us, epoch_us(ts)+round(value*1000000)::BIGINT AS end_us
        FROM (SELECT *, CASE WHEN event_type IN ('click','view') THEN '.zip' WHEN event_type='error' THEN '.symlink' ELSE '.dat' END AS ext FROM events)""",
    "transfers": """SELECT ord, BUCKET_NAME AS run, CASE WHEN LOCAL_PATH LIKE '%.zip' THEN 'zip' ELSE 'file' END AS kind,
        LOCAL_PATH LIKE '%.zip' AND NOT contains(BUCKET_NAME,'NoComp') AS compressed, FILE_SIZE AS size, UPLOAD_TIME AS seconds,
        start_us, end_us, end_us-start_us AS dur_us,
        CASE WHEN end_us>start_us THEN round((FILE_SIZE::HUGEINT*1000000000)::DOUBLE/(end_us-start_us)::DOUBLE)::BIGINT END AS rate
        FROM upload_log""",
    "verification": """SELECT DESTINATION_KEY, CHECKSUM, ord%7<>0 AS CHECKSUM_MATCH, ord%11<>0 AS SIZE_MATCH FROM upload_log
        JOIN events ON event_id=ord WHERE event_type IN ('click','purchase')""",
    "log_keys": """SELECT c_name||CASE WHEN c_nationkey%2=0 THEN '-backup.csv' ELSE '-files.csv' END AS key, c_custkey*60000000 AS modified_us FROM customer
        UNION ALL SELECT c_name||'-backup-verification.csv', c_custkey*60000000 FROM customer WHERE c_acctbal>0
        UNION ALL SELECT 'old/'||c_name||'-backup.csv', c_custkey*60000000 FROM customer WHERE c_mktsegment='MACHINERY'""",
    "titled": """SELECT CASE WHEN o_custkey%11=0 THEN 'mixed' ELSE ([34,64,128,256,512])[o_custkey%5+1]||'MiB-100GiB' END||'_'||([1,2,4,8,12])[o_orderkey%5+1]||'-procs_'||
        (o_orderkey%2+1)||'fpf' AS title, round(o_totalprice*100)::BIGINT AS rate FROM orders""",
    "run_base": """SELECT CASE o_orderstatus WHEN 'F' THEN 'no-collate' WHEN 'O' THEN 'no-compression' ELSE 'collate' END||'_'||
        ['dummy-data_1perc','dummy-data_10perc','dummy-data_25perc','vhs_merged','vhs'][left(o_orderpriority,1)::INT]||'_'||
        ['1','2','4','8','12'][o_custkey%5+1]||'-procs' AS file, o_orderkey AS n, round(o_totalprice*100)::BIGINT AS cents, (o_custkey%10+1)*100+25 AS secs
        FROM orders""",
    "run_lines": f"""SELECT file, n*2 AS line_no, {_c('cents')}||' MiB uploaded in '||{_c('secs')}||' seconds, '||{_c('cents*100//secs')}||' MiB/s' AS value FROM run_base
        UNION ALL SELECT file, n*2+1, '2 files (avg '||{_c('cents//2')}||' MiB/file) uploaded in '||{_c('secs')}||' seconds, '||{_c('secs//2')}||' s/file' FROM run_base
        UNION ALL SELECT file, 1000000000000, 'Finished at 2001-02-03 04:05:06.000007, elapsed time = '||(s//360000)||':'||lpad((s//6000%60)::VARCHAR,2,'0')||':'
          ||lpad((s//100%60)::VARCHAR,2,'0')||'.'||lpad((s%100*10000)::VARCHAR,6,'0') FROM (SELECT file, sum(secs)::BIGINT AS s FROM run_base GROUP BY file)
        UNION ALL SELECT file, 1000000000001, 'Total: '||k||' files; '||{_c('c')}||' MiB; '||{_c('c*100//s')}||' MiB/s including setup time; '||{_c('s//k')}||' s/file including setup time'
          FROM (SELECT file, count(*) AS k, sum(cents)::BIGINT AS c, sum(secs)::BIGINT AS s FROM run_base GROUP BY file)""",
    "snapshots": """SELECT hour*3600000000 AS taken_us, (sum(n) OVER (ORDER BY hour))::BIGINT AS files, (sum(b) OVER (ORDER BY hour))::BIGINT AS bytes
        FROM (SELECT start_us//3600000000 AS hour, count(*) AS n, sum(FILE_SIZE)::BIGINT AS b FROM upload_log GROUP BY 1)""",
    "old_logs": """SELECT '/logs/'||o_custkey AS folder, 'backup-logs-'||o_orderkey||'.csv' AS name, epoch_us(o_orderdate) AS modified_us FROM orders""",
}
