"""Sources, sinks and store inventories."""

from pyspark.sql import functions as F

from invspark import schemas
from invspark.functions import paths, units
from invspark.operators import batching, runs, stats
from invspark.plans import actions, logs
from invspark.session import shared_dir
from invspark.sources import listing, tables, text, tree

from .archives import TREE, below, document_files, frozen_files
from .base import query
from .planning import fold
from .views import DEST, LAKE


@query("i01_tree_listing", sql="""SELECT source||'/'||lang||'/'||doc_id||'.txt' AS path, false AS is_dir, octet_length(encode(text))::BIGINT AS size FROM documents
    UNION ALL SELECT DISTINCT source||'/'||lang, true, 0 FROM documents UNION ALL SELECT DISTINCT source, true, 0 FROM documents""")
def i01(t):
    """Every document written as a file, and the tree walked level by level: folders, names and sizes."""
    where = document_files(t)
    return listing.walk_tree(t.spark, where).select(below("path", where).alias("path"), "is_dir", "size")


@query("i01_listed_files", sql="SELECT source||'/'||lang||'/'||doc_id||'.txt' AS path, octet_length(encode(text))::BIGINT AS size FROM documents")
def i01_files(t):
    """The same files as Spark's file sources list them."""
    where = document_files(t)
    path = F.regexp_extract("path", "([^/]+/[^/]+/[^/]+)$", 1)
    return listing.list_files(t.spark, where).select(path.alias("path"), "size")


TREE_ROWS = """SELECT source||'/'||lang||'/'||doc_id||'.txt' AS path, false AS is_dir, octet_length(encode(text))::BIGINT AS size FROM documents
    UNION ALL SELECT DISTINCT source||'/'||lang, true, 0 FROM documents UNION ALL SELECT DISTINCT source, true, 0 FROM documents"""


@query("i01_tree_source", sql=f"SELECT * FROM ({TREE_ROWS}) WHERE starts_with(path,'src1') AND size>=100")
def i01_source(t):
    """The tree as a data source: what the path begins with and the size are decided while it is read."""
    where = document_files(t)
    tree.register(t.spark)
    found = t.spark.read.format("tree").load(where).filter(F.startswith("path", F.lit(where + "/src1")) & (F.col("size") >= 100))
    return found.select(below("path", where).alias("path"), "is_dir", "size")


@query("i01_tree_stream", sql=TREE_ROWS)
def i01_stream(t):
    """The tree as a stream, by the time entries changed."""
    where, out, log = document_files(t), shared_dir(t.spark, "entries"), shared_dir(t.spark, "entries-log")
    tree.register(t.spark)
    entries = t.spark.readStream.format("tree").option("lag_us", 0).load(where)
    entries.writeStream.format("parquet").option("checkpointLocation", log).trigger(availableNow=True).start(out).awaitTermination()
    return t.spark.read.schema(tree.ENTRIES).parquet(out).select(below("path", where).alias("path"), "is_dir", "size")


@query("i01_frozen_listing", ctes=TREE, sql="SELECT ord, member AS path, 'backup/'||member AS object_name, size FROM tree")
def i01_frozen(t):
    """Walk a written tree and number its files in path order."""
    relative = F.regexp_extract("path", "([^/]+/[^/]+/[^/]+)$", 1)
    return frozen_files(t).select("ord", relative.alias("path"), "object_name", "size")


@query("i02_prefix_listing", sql="SELECT key, size FROM whole_lake WHERE starts_with(key,'lake/collated_')")
def i02(t):
    return listing.with_prefix(t.whole_lake, LAKE + "/collated_")


@query("i03_bucket_config", sql="SELECT lower(n_name) AS name, 'region '||n_regionkey AS description FROM nation")
def i03(t):
    where = shared_dir(t.spark, "buckets")
    entry = F.struct(F.lower("n_name").alias("name"), F.concat(F.lit("region "), F.col("n_regionkey").cast("string")).alias("description"))
    t.table("nation").select(F.to_json(F.array(entry)).alias("value")).write.text(where)
    return listing.buckets(t.spark, where, lines=True)


def _raw_log(t):
    stamp = lambda us: F.date_format(F.timestamp_micros(us), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return t.upload_log.select(
        "LOCAL_FOLDER", "LOCAL_PATH", "FILE_SIZE", "BUCKET_NAME", "DESTINATION_KEY", "CHECKSUM", "ZIP_CONTENTS", "FILES_PER_ZIP",
        F.col("UPLOAD_TIME").cast("string").alias("UPLOAD_TIME"), stamp("start_us").alias("UPLOAD_START"), stamp("end_us").alias("UPLOAD_END"),
    )


@query("i04_csv_upload_log", sql="SELECT LOCAL_PATH, FILE_SIZE, try_cast(FILES_PER_ZIP AS BIGINT) AS FILES_PER_ZIP, UPLOAD_TIME, start_us, end_us, ZIP_CONTENTS FROM upload_log")
def i04(t):
    where = shared_dir(t.spark, "log")
    tables.write_csv(_raw_log(t), where)
    return tables.read_upload_log(t.spark, [where]).select("LOCAL_PATH", "FILE_SIZE", "FILES_PER_ZIP", "UPLOAD_TIME", "start_us", "end_us", "ZIP_CONTENTS")


@query("i05_csv_append", sql="SELECT DESTINATION_KEY, CHECKSUM, CHECKSUM_MATCH, SIZE_MATCH FROM checks UNION ALL SELECT DESTINATION_KEY, CHECKSUM, CHECKSUM_MATCH, SIZE_MATCH FROM checks")
def i05(t):
    where = shared_dir(t.spark, "verification")
    for _ in range(2):
        tables.write_csv(t.checks, where, append=True)
    return tables.read_csv(t.spark, where, "DESTINATION_KEY string, CHECKSUM string, CHECKSUM_MATCH boolean, SIZE_MATCH boolean")


@query("i06_plan_hand_off", sql="SELECT zip_key AS key, text IS NULL AS extract FROM manifest")
def i06(t):
    where = shared_dir(t.spark, "extract")
    plan = t.manifest.select(F.col("zip_key").alias("key"), F.col("text").isNull().alias("extract"))
    tables.write_plan(plan, where, schemas.EXTRACT_PLAN)
    return tables.read_plan(t.spark, where, schemas.EXTRACT_PLAN)


@query("i07_appended_upload_log", sql="SELECT kind, count(*) AS n, sum(size)::BIGINT AS bytes FROM transfers GROUP BY kind")
def i07(t):
    where = shared_dir(t.spark, "uploads")
    for kind in ("zip", "file"):
        tables.append_log(t.transfers.filter(F.col("kind") == kind).select("ord", "kind", "size"), where)
    return t.spark.read.schema("ord long, kind string, size long").parquet(where).groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


def _fields(prefix):
    return f"""'{prefix}' AS BUCKET_NAME, CASE WHEN ord%4=0 THEN NULL ELSE start END AS s, CASE WHEN ord%4=0 THEN NULL ELSE start+ord%900+1 END AS e"""


LOG_ROWS = ("f AS (SELECT ord, size FROM files)", fold("f", 50_000, 12, 500, "ord, size"), f"""sent AS (SELECT parent AS LOCAL_FOLDER, path AS LOCAL_PATH, size AS FILE_SIZE, object_name AS DESTINATION_KEY, md5(path) AS CHECKSUM,
      'n/a' AS ZIP_CONTENTS, 'n/a' AS FILES_PER_ZIP, 'n/a' AS none, {_fields('one')} FROM (SELECT *, regexp_replace(path,'/[^/]*$','') AS parent, ord*1000003::BIGINT AS start FROM files)
    UNION ALL SELECT '/work', '/work/'||id||'.zip', bytes, 'backup/collated_'||id||'.zip', md5(id::VARCHAR), CASE WHEN n>5 THEN list_aggregate(names[1:5],'string_agg','|')||' abbreviated' ELSE list_aggregate(names,'string_agg','|') END, n::VARCHAR, '',
      {_fields('many')} FROM (SELECT part*1000000+batch AS id, min(fold.ord) AS ord, count(*) AS n, sum(fold.size)::BIGINT AS bytes, list(object_name ORDER BY fold.ord) AS names, min(fold.ord)*1000003::BIGINT AS start FROM fold JOIN files USING (ord) GROUP BY part, batch))""")


@query("i07_log_rows", ctes=LOG_ROWS, sql="""SELECT LOCAL_FOLDER, LOCAL_PATH, FILE_SIZE, BUCKET_NAME, DESTINATION_KEY, CHECKSUM, ZIP_CONTENTS, FILES_PER_ZIP,
    CASE WHEN s IS NULL THEN none ELSE printf('%.6f',(e-s)/1e6::DOUBLE) END AS UPLOAD_TIME, CASE WHEN s IS NULL THEN none ELSE strftime(make_timestamp(s),'%Y-%m-%d %H:%M:%S.%f') END AS UPLOAD_START,
    CASE WHEN s IS NULL THEN none ELSE strftime(make_timestamp(e),'%Y-%m-%d %H:%M:%S.%f') END AS UPLOAD_END FROM sent""")
def i07_rows(t):
    """Both forms of rows, appended by two jobs to one log and read back."""
    timed = lambda df: df.withColumn("start_us", F.when(F.col("ord") % 4 != 0, F.col("ord") * 1_000_003)).withColumn("end_us", F.col("start_us") + F.col("ord") % 900 + 1)
    files = timed(t.files.select("ord", "path", "object_name", "size", F.md5("path").alias("md5")))
    batched = batching.assign_batches(t.files.select("ord", "object_name", "size"), 50_000, 12, 500)
    names_ = F.transform(F.sort_array(F.collect_list(F.struct("ord", "object_name"))), lambda m: m["object_name"])
    built = batched.groupBy("id").agg(F.min("ord").alias("ord"), F.sum("size").alias("size"), names_.alias("members"))
    number = F.col("id").cast("string")
    archives = timed(built.select("ord", F.concat(F.lit("/work/"), number, F.lit(".zip")).alias("path"), paths.archive_key(F.col("id"), DEST).alias("zip_key"), "size", F.md5(number).alias("md5"), "members"))
    where = shared_dir(t.spark, "log")
    tables.append_log(logs.file_rows(files, "one"), where)
    tables.append_log(logs.archive_rows(archives, "many"), where)
    return t.spark.read.parquet(where)


@query("i09_text_log_lines", sql="SELECT file, count(*) AS n, count_if(contains(value,'MiB uploaded in'))::BIGINT AS n_transfers FROM run_lines WHERE contains(value,'uploaded in') GROUP BY file")
def i09(t):
    where = shared_dir(t.spark, "runs")
    # Spread over files by run; each run's lines may lie in several files.
    t.run_lines.select("file", "value").write.partitionBy("file").text(where)
    lines = text.read_lines(t.spark, where).withColumn("file", F.url_decode(F.url_decode(F.regexp_extract("file", "file=([^/]+)/", 1))))
    found = runs.matching(lines, "uploaded in")
    return found.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.contains("value", F.lit("MiB uploaded in"))).alias("n_transfers"))


@query("i10_export_paths", sql="SELECT ord, '/base/data/'||substr(path,7) AS path FROM files WHERE NOT contains(path,'/fr/')")
def i10(t):
    relative = F.substring("path", F.lit(7), F.length("path"))
    lines = t.files.select("ord", F.when(F.contains("path", F.lit("/fr/")), F.concat(F.lit("  name: "), relative)).otherwise(F.concat(F.lit("  path: "), relative)).alias("value"))
    return text.export_paths(lines, "/base/data")


@query("i11_generated_tree", sql="SELECT '/'||c_custkey||'/'||c_custkey||'_'||j||'.f' AS path, 34*1048576::BIGINT AS size FROM customer, range(1,4) AS r(j)")
def i11(t):
    folders = t.table("customer").select(F.concat(F.lit("/"), F.col("c_custkey").cast("string")).alias("folder"))
    return listing.synthetic_tree(folders, 3, 34 * units.MIB)


@query("i12_contents_report", sql="""SELECT s.key, round(s.size/1048576.0::DOUBLE,2) AS mib, s.modified_us, coalesce(m.text,'n/a') AS contents FROM
    (SELECT key, size, modified_us FROM stored UNION ALL SELECT zip_key, length(zip_key)*70000, 0 FROM manifest) s LEFT JOIN manifest m ON m.zip_key=s.key""")
def i12(t):
    zips = t.manifest.select(F.col("zip_key").alias("key"), (F.length("zip_key") * 70000).cast("long").alias("size"), F.lit(0).cast("long").alias("modified_us"))
    return actions.report(t.stored.select("key", "size", "modified_us").unionByName(zips), t.manifest)


CHANGED = """newer AS (SELECT key, size, CASE WHEN starts_with(key,'backup/src2/') AND size%2=0 THEN etag||'x' ELSE etag END AS etag FROM stored WHERE NOT (starts_with(key,'backup/src1/') AND size%3=0)
    UNION ALL SELECT replace(key,'backup/src2/','backup/src2b/'), size, NULL FROM stored WHERE starts_with(key,'backup/src2/'))"""


@query("j01_changes_between_listings", ctes=CHANGED, sql="""SELECT coalesce(o.key,n.key) AS key, CASE WHEN o.key IS NULL THEN 'added' WHEN n.key IS NULL THEN 'removed' ELSE 'changed' END AS change,
    o.size AS old_size, n.size AS new_size, o.etag AS old_etag, n.etag AS new_etag FROM stored o FULL JOIN newer n ON o.key=n.key
    WHERE o.key IS NULL OR n.key IS NULL OR o.size IS DISTINCT FROM n.size OR o.etag IS DISTINCT FROM n.etag""")
def j01_changes(t):
    """Two full listings as snapshots with digests; only ranges that differ are read."""
    from invspark.sources import snapshots

    old = t.stored.select("key", "size", "etag")
    other = F.startswith("key", F.lit("backup/src2/"))
    kept = old.filter(~(F.startswith("key", F.lit("backup/src1/")) & (F.col("size") % 3 == 0)))
    newer = kept.withColumn("etag", F.when(other & (F.col("size") % 2 == 0), F.concat("etag", F.lit("x"))).otherwise(F.col("etag")))
    added = old.filter(other).select(F.regexp_replace("key", "^backup/src2/", "backup/src2b/").alias("key"), "size", F.lit(None).cast("string").alias("etag"))
    first, second = shared_dir(t.spark, "snapshot"), shared_dir(t.spark, "snapshot")
    snapshots.save(old, first, ranges=16)
    snapshots.save(newer.unionByName(added), second, like=first, ranges=16)
    found = snapshots.changes(t.spark, first, second, old)
    return found.select("key", "change", *[F.col(f"{side}.{name}").alias(f"{side}_{name}") for name in ("size", "etag") for side in ("old", "new")])


@query("a02_totals", sql="""SELECT split_part(key,'/',1) AS top, count(*) AS n, sum(size)::BIGINT AS bytes, sum(size)/1048576.0::DOUBLE AS mib, sum(size)/1073741824.0::DOUBLE AS gib,
    sum(size)/1099511627776.0::DOUBLE AS tib FROM page_objects GROUP BY 1""")
def a02(t):
    return stats.totals(t.page_objects.withColumn("top", paths.first_component(F.col("key"))), ["top"])


@query("a02_bucket_size", sql="SELECT count(*) AS n, sum(size)::BIGINT AS bytes, sum(size)/1048576.0::DOUBLE AS mib, sum(size)/1073741824.0::DOUBLE AS gib, sum(size)/1099511627776.0::DOUBLE AS tib FROM whole_lake")
def a02_all(t):
    return stats.totals(t.whole_lake)


@query("a08_top_folders", sql="SELECT 'pages' AS bucket_name, split_part(key,'/',1) AS prefix, min(ord) AS first_ord FROM page_objects WHERE contains(key,'/') GROUP BY 2")
def a08(t):
    return stats.top_folders(t.page_objects.withColumn("bucket", F.lit("pages"))).orderBy("first_ord")


@query("a18_quota", sql="""SELECT bucket, count(*) AS n, sum(size)::BIGINT AS bytes, sum(size)/1073741824.0::DOUBLE AS gib, sum(size)::BIGINT*100.0::DOUBLE/1000000000 AS percent_of_quota FROM
    (SELECT split_part(key,'/',1) AS bucket, size FROM page_objects UNION ALL SELECT 'lake', size FROM whole_lake) GROUP BY bucket""")
def a18(t):
    objects = t.page_objects.select(paths.first_component(F.col("key")).alias("bucket"), "size").unionByName(t.whole_lake.select(F.lit("lake").alias("bucket"), "size"))
    return stats.quota(objects, 1_000_000_000)


@query("a22_download_session", sql="SELECT bool_and(size>0) AS all_ok, count(*) AS n, sum(size)::BIGINT AS bytes, round(avg(size),6) AS mean_bytes FROM whole_lake")
def a22(t):
    done = t.whole_lake.withColumn("ok", F.col("size") > 0)
    return done.agg(stats.all_true(F.col("ok")).alias("all_ok"), F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.round(F.avg("size"), 6).alias("mean_bytes"))
