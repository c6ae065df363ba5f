"""Scalar functions, projections and predicates."""

from pyspark.sql import functions as F

from invspark.functions import manifests, names, paths, times, units, values
from invspark.operators import batching, folders, links, selection, lookups
from invspark.session import materialise
from invspark.sources import listing

from .base import query
from .views import DEST, ROOT, SEGMENT, SITE_LABELS

PARENT = "regexp_replace({0},'/?[^/]*$','')"


@query("f01_dirname_basename", sql=f"SELECT key, {PARENT.format('key')} AS dir, list_last(string_split(key,'/')) AS base FROM page_objects")
def f01(t):
    return t.page_objects.select("key", paths.parent_dir(F.col("key")).alias("dir"), paths.base_name(F.col("key")).alias("base"))


@query("f02_depth_and_ancestors", sql="""SELECT path, len(string_split(path,'/'))::BIGINT AS depth, string_split(ltrim(path,'/'),'/')[1] AS top,
    array_to_string(list_transform(range(1, len(string_split(ltrim(path,'/'),'/'))+1), lambda i: '/'||array_to_string(string_split(ltrim(path,'/'),'/')[1:i],'/')),';') AS above
    FROM files""")
def f02(t):
    path = F.col("path")
    return t.files.select(
        "path", paths.depth(path).alias("depth"), paths.first_component(F.regexp_replace(path, "^/", "")).alias("top"),
        F.array_join(paths.ancestors(path), ";").alias("above"),
    )


@query("f03_strip_folder", sql="""SELECT ord, CASE WHEN starts_with(LOCAL_PATH,LOCAL_FOLDER) THEN substr(LOCAL_PATH,length(LOCAL_FOLDER)+2) ELSE LOCAL_PATH END AS name FROM upload_log""")
def f03(t):
    return t.upload_log.select("ord", paths.strip_prefix(F.col("LOCAL_PATH"), F.col("LOCAL_FOLDER")).alias("name"))


@query("f04_archive_key", sql="SELECT o_orderkey, 'backup/collated_'||o_orderkey||'.zip' AS zip_key FROM orders")
def f04(t):
    return t.table("orders").select("o_orderkey", paths.archive_key(F.col("o_orderkey"), DEST).alias("zip_key"))


PARSED = """list_filter(CASE WHEN contains(text,'|') THEN string_split(text,'|') WHEN contains(text,';') THEN string_split(text,';')
    ELSE string_split(text,',') END, lambda x: x<>'')"""


@query("f05_parse_manifest", sql=f"SELECT zip_key, array_to_string({PARSED},'\n') AS names, len({PARSED})::INT AS n FROM manifest")
def f05(t):
    parsed = manifests.parse(F.col("text"))
    return t.manifest.select("zip_key", F.array_join(parsed, "\n").alias("names"), F.when(parsed.isNotNull(), F.size(parsed)).alias("n"))


@query("f06_qualified_members", sql=f"SELECT zip_key, array_to_string(list_transform({PARSED}, lambda x: 'backup/'||x),'\n') AS keys FROM manifest")
def f06(t):
    return t.manifest.select("zip_key", F.array_join(manifests.qualify(manifests.parse(F.col("text")), F.col("zip_key")), "\n").alias("keys"))


@query("f07_abbreviated_members", sql="""SELECT ord, CASE WHEN len(string_split(ZIP_CONTENTS,'|'))>5 THEN array_to_string(string_split(ZIP_CONTENTS,'|')[1:5],'|')||' abbreviated'
    ELSE ZIP_CONTENTS END AS shown FROM upload_log WHERE ZIP_CONTENTS IS NOT NULL""")
def f07(t):
    log = t.upload_log.filter(F.col("ZIP_CONTENTS").isNotNull())
    return log.select("ord", manifests.abbreviate(F.split("ZIP_CONTENTS", "[|]")).alias("shown"))


@query("f08_unit_scaling", sql="""SELECT ord, size/1048576.0::DOUBLE AS mib, size/1073741824.0::DOUBLE AS gib, size/1099511627776.0::DOUBLE AS tib,
    round(CASE WHEN seconds<>0 THEN size::DOUBLE*8/1073741824.0::DOUBLE/seconds END, 9) AS gibit_s FROM transfers""")
def f08(t):
    size = F.col("size")
    return t.transfers.select(
        "ord", units.mib(size).alias("mib"), units.gib(size).alias("gib"), units.tib(size).alias("tib"),
        F.round(units.gibit_rate(size, F.col("seconds")), 9).alias("gibit_s"),
    )


STAMP_SQL = """SELECT event_id, CASE WHEN event_id%4=1 THEN strftime(ts,'%Y-%m-%d %H:%M:%S') WHEN event_id%4=2 THEN 'n/a'
    ELSE strftime(ts,'%Y-%m-%d %H:%M:%S.%f') END AS text FROM events"""


def stamps(t):
    whole = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("event_id") % 4 == 1, whole).when(F.col("event_id") % 4 == 2, "n/a").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return t.table("events").select("event_id", text.alias("text"))


@query("f09_parse_timestamps", ctes=f"stamps AS ({STAMP_SQL})", sql="SELECT event_id, epoch_us(try_cast(text AS TIMESTAMP)) AS us FROM stamps")
def f09(t):
    return stamps(t).select("event_id", times.micros(times.parse_stamp(F.col("text"))).alias("us"))


@query("f10_elapsed_and_durations", sql="""SELECT file, epoch_us(TIMESTAMP '1970-01-01' + regexp_extract(value,'elapsed time = ([0-9:.]+)',1)::INTERVAL) AS us
    FROM run_lines WHERE contains(value,'Finished at')""")
def f10(t):
    lines = t.run_lines.filter(F.contains("value", F.lit("Finished at")))
    return lines.select("file", times.duration_us(F.regexp_extract("value", "elapsed time = ([0-9:.]+)", 1)).alias("us"))


@query("f11_null_tokens", sql="SELECT ord, CASE WHEN FILES_PER_ZIP NOT IN ('n/a','') THEN FILES_PER_ZIP END AS text, coalesce(try_cast(FILES_PER_ZIP AS BIGINT),0) AS n FROM upload_log")
def f11(t):
    text = F.col("FILES_PER_ZIP")
    return t.upload_log.select("ord", values.null_if_token(text).alias("text"), values.count_or_zero(text).alias("n"))


@query("f12_verification_name", sql="SELECT key, regexp_replace(key,'-(files[.]csv|backup[.]csv)$','-backup-verification.csv') AS twin FROM log_keys")
def f12(t):
    return t.log_keys.select("key", names.verification_twin(F.col("key")).alias("twin"))


@query("f13_run_name_tokens", sql="""SELECT ord, split_part(BUCKET_NAME,'_',2) AS site, split_part(split_part(BUCKET_NAME,'_',-1),'-',1)::INT AS workers,
    split_part(split_part(BUCKET_NAME,'_',-1),'-',2)::INT AS threads FROM upload_log""")
def f13(t):
    run = F.col("BUCKET_NAME")
    return t.upload_log.select("ord", names.site(run).alias("site"), names.workers(run).alias("workers"), names.threads(run).alias("threads"))


@query("f14_digits_only", sql="SELECT o_orderkey, regexp_replace(o_orderpriority,'[^0-9]','','g') AS digits FROM orders")
def f14(t):
    return t.table("orders").select("o_orderkey", names.digits(F.col("o_orderpriority")).alias("digits"))


@query("f15_site_labels", sql="""SELECT ord, CASE split_part(BUCKET_NAME,'_',2) WHEN 'north' THEN 'North Hall' WHEN 'south' THEN 'South Hall'
    WHEN 'east' THEN 'East Hall' WHEN 'west' THEN 'West Hall' END AS site FROM upload_log""")
def f15(t):
    return t.upload_log.select("ord", names.relabel(names.site(F.col("BUCKET_NAME")), SITE_LABELS).alias("site"))


@query("f16_dataset_labels", sql="""SELECT file, line_no, CASE WHEN list_contains(w,'merged') AND list_contains(w,'vhs') THEN 'VHS-merged'
    WHEN list_contains(w,'vhs') THEN 'CSV-VHS' WHEN list_contains(w,'1perc') THEN 'Dummy Data 1% Small Files'
    WHEN list_contains(w,'10perc') THEN 'Dummy Data 10% Small Files' WHEN list_contains(w,'25perc') THEN 'Dummy Data 25% Small Files' ELSE 'Unknown' END AS dataset
    FROM (SELECT *, string_split(file,'_') AS w FROM run_lines)""")
def f16(t):
    return t.run_lines.select("file", "line_no", names.label_ladder(F.split("file", "_")).alias("dataset"))


@query("f17_type_and_compression", sql="""SELECT ord, CASE WHEN LOCAL_PATH LIKE '%.zip' THEN 'zip' ELSE 'file' END AS kind,
    LOCAL_PATH LIKE '%.zip' AND NOT contains(BUCKET_NAME,'NoComp') AS compressed FROM upload_log""")
def f17(t):
    kind = names.transfer_type(F.col("LOCAL_PATH"))
    return t.upload_log.select("ord", kind.alias("kind"), names.compression_used(kind, F.col("BUCKET_NAME")).alias("compressed"))


@query("f18_md5_of_contents", sql="SELECT doc_id AS ord, md5(text) AS md5, octet_length(encode(text))::BIGINT AS size FROM documents")
def f18(t):
    return t.contents.select("ord", values.md5_hex(F.col("content")).alias("md5"), F.octet_length("content").cast("long").alias("size"))


@query("f19_two_level_etag", sql="SELECT key, n AS n_segments, etag FROM sent_etags JOIN sent_hex USING (doc_id)")
def f19_two_level(t):
    """The checksum that a store gives an object sent in segments."""
    etag = values.segmented_etag(F.col("content"), SEGMENT)
    rows = t.contents.select(F.concat(F.lit(DEST + "/"), "member").alias("key"), etag.alias("etag"))
    return rows.select("key", values.segment_count(F.col("etag")).alias("n_segments"), "etag")


@query("f19_segmented_etag", sql="SELECT key, contains(etag,'-') AS segmented FROM stored")
def f19(t):
    return t.stored.select("key", values.is_segmented(F.col("etag")).alias("segmented"))


@query("f20_literal_or_text", sql="SELECT ord, coalesce(try_cast(FILES_PER_ZIP AS BIGINT)::VARCHAR, FILES_PER_ZIP) AS value FROM upload_log")
def f20(t):
    return t.upload_log.select("ord", values.literal_or_text(F.col("FILES_PER_ZIP"), "bigint").alias("value"))


@query("f21_clamped_arithmetic", sql="""SELECT l_orderkey, l_linenumber, floor(l_quantity/7)::BIGINT AS lo, ceil(l_quantity/7)::BIGINT AS hi,
    greatest(10.0::DOUBLE, least(l_quantity, 40.0::DOUBLE)) AS clamped FROM lineitem""")
def f21(t):
    q = F.col("l_quantity")
    return t.table("lineitem").select("l_orderkey", "l_linenumber", F.floor(q / 7).alias("lo"), F.ceil(q / 7).alias("hi"), values.clamp(q, 10.0, 40.0).alias("clamped"))


# Projections, filters, predicates


@query("p01_object_names", sql="SELECT path, 'backup/'||substr(path,7) AS object_name FROM files")
def p01(t):
    return t.files.select("path", paths.object_name(F.col("path"), ROOT, DEST).alias("object_name"))


@query("p02_key_class", sql="""SELECT key, CASE WHEN regexp_full_match(key,'.*collated_[0-9]+\\.zip') THEN 'zip' WHEN regexp_full_match(key,'.*collated_[0-9]+\\.zip\\.metadata') THEN 'manifest'
    ELSE 'other' END AS class FROM whole_lake""")
def p02(t):
    return t.whole_lake.select("key", names.key_class(F.col("key")).alias("class"))


@query("p03_loose_match", sql="SELECT key, regexp_matches(key,'collated_.*\\.zip$','i') AS expand FROM whole_lake WHERE NOT regexp_matches(key,'collated_.*\\.zip\\.metadata','i')")
def p03(t):
    return selection.downloadable(t.whole_lake.select("key"))


@query("p04_remaining_objects", sql="SELECT key, size FROM whole_lake WHERE NOT regexp_matches(key,'collated_[0-9]+\\.zip(\\.metadata)?$')")
def p04(t):
    return selection.remaining(t.whole_lake)


@query("p05_route", sql="SELECT ord, size, CASE WHEN size<=2048/2 THEN 'zip' ELSE 'file' END AS type FROM files")
def p05(t):
    return t.files.select("ord", "size", batching.route(F.col("size"), 2048).alias("type"))


def _folders(t):
    return t.files.withColumn("folder", paths.parent_dir(F.col("path")))


def _excluded(t):
    # Folders with a toxic document.
    bad = t.table("labels").filter("toxic = 1").select(F.col("doc_id").alias("ord"))
    return _folders(t).join(bad, "ord").select("folder").distinct()


@query("p06_excluded_folders", ctes="""d AS (SELECT *, regexp_replace(path,'/?[^/]*$','') AS folder FROM files),
    e AS (SELECT DISTINCT folder FROM d JOIN labels ON doc_id=ord WHERE toxic=1)""",
    sql="SELECT ord, path FROM d WHERE folder NOT IN (SELECT folder FROM e)")
def p06(t):
    return selection.exclude_folders(_folders(t), _excluded(t)).select("ord", "path")


@query("p06_excluded_subtrees", ctes="""e AS (SELECT DISTINCT '/data/'||source AS folder FROM documents JOIN labels USING (doc_id) WHERE toxic=1 AND quality=0)""",
    sql="SELECT ord, path FROM files WHERE NOT EXISTS (SELECT 1 FROM e WHERE starts_with(path, folder||'/'))")
def p06_subtree(t):
    docs = t.table("documents").join(t.table("labels").filter("toxic = 1 and quality = 0"), "doc_id")
    top = docs.select(F.concat(F.lit(ROOT + "/"), "source").alias("folder"))
    return selection.exclude_folders(_folders(t), top, subtree=True).select("ord", "path")


@query("p06_excluded_intervals", ctes="""e AS (SELECT DISTINCT '/data/'||source AS folder FROM documents JOIN labels USING (doc_id) WHERE toxic=1 AND quality=0)""",
    sql="SELECT path, size FROM files WHERE NOT EXISTS (SELECT 1 FROM e WHERE starts_with(path, folder||'/'))")
def p06_intervals(t):
    """The same by intervals of the frozen listing: no folder is spread over those above it."""
    docs = t.table("documents").join(t.table("labels").filter("toxic = 1 and quality = 0"), "doc_id")
    top = docs.select(F.concat(F.lit(ROOT + "/"), "source").alias("folder")).distinct()
    frozen = materialise(listing.in_path_order(t.files.select("path", "size")), "frozen")
    return folders.outside(frozen, folders.intervals(frozen).join(top, "folder", "left_semi")).select("path", "size")


@query("p07_links_and_files", sql="SELECT is_link, count(*) AS n, sum(size)::BIGINT AS bytes FROM listing GROUP BY is_link")
def p07(t):
    found, files = selection.split_links(t.listing)
    return found.unionByName(files).groupBy("is_link").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


CHAIN = """hops AS (SELECT ord, path, link_target AS target, object_name, 1 AS n FROM listing WHERE is_link
    UNION ALL SELECT h.ord, h.path, l.link_target, h.object_name, n+1 FROM hops h JOIN listing l ON l.path=h.target WHERE l.is_link AND n<(SELECT count(*)+1 FROM listing WHERE is_link)),
    resolved AS (SELECT h.ord, h.path, h.object_name, h.target FROM hops h LEFT JOIN listing l ON l.path=h.target WHERE h.target IS NOT NULL AND NOT coalesce(l.is_link,false))"""


@query("p08_follow_links", ctes=CHAIN, sql="""SELECT ord, path, object_name, size FROM listing WHERE NOT is_link
    UNION ALL SELECT r.ord, r.target, r.object_name, coalesce(f.size,0) FROM resolved r LEFT JOIN listing f ON f.path=r.target""")
def p08(t):
    return links.follow(t.listing).select("ord", "path", "object_name", "size")


PAIRS = (CHAIN, "pairs AS (SELECT path AS given, path AS resolved FROM listing WHERE NOT is_link UNION ALL SELECT l.path, r.target FROM listing l LEFT JOIN resolved r ON r.path=l.path WHERE l.is_link)")


@query("p09_path_pairs", ctes=PAIRS, sql="SELECT given, resolved FROM pairs")
def p09_pairs(t):
    return links.path_pairs(t.listing)


@query("p09_differing_paths", ctes=PAIRS, sql="SELECT count(*) AS n, count_if(given IS DISTINCT FROM resolved)::BIGINT AS n_differing FROM pairs")
def p09(t):
    return links.moved(links.path_pairs(t.listing))


@query("p10_rebase", sql="""SELECT ord, CASE WHEN regexp_matches(LOCAL_FOLDER,'(^|/)run[01](/|$)') THEN '/mnt/pool/rds-7'||regexp_replace(LOCAL_FOLDER,'^/data/run[01]','') ELSE LOCAL_FOLDER END AS path
    FROM upload_log""")
def p10(t):
    base = paths.base_up_to(F.lit("/mnt/pool/rds-7/users"), "rds-[^/]*")
    return t.upload_log.select("ord", paths.rebase(F.col("LOCAL_FOLDER"), "run[01]", base).alias("path"))


@query("p11_pruned_columns", sql="SELECT ord, FILE_SIZE, UPLOAD_TIME FROM upload_log")
def p11(t):
    log = t.upload_log
    return log.drop(*[c for c in log.columns if c not in ("ord", "FILE_SIZE", "UPLOAD_TIME")])


@query("p12_drop_incomplete", ctes=f"stamps AS ({STAMP_SQL})", sql="SELECT event_id, epoch_us(try_cast(text AS TIMESTAMP)) AS us FROM stamps WHERE try_cast(text AS TIMESTAMP) IS NOT NULL")
def p12(t):
    return stamps(t).select("event_id", times.micros(times.parse_stamp(F.col("text"))).alias("us")).dropna(subset=["us"])


@query("p13_root_logs", sql="""SELECT key, CASE WHEN key LIKE '%backup-verification.csv' THEN 'verification' WHEN key LIKE '%backup.csv' THEN 'log' ELSE 'previous log' END AS log_class
    FROM log_keys WHERE NOT contains(key,'/')""")
def p13(t):
    return selection.root_logs(t.log_keys).select("key", "log_class")


@query("p14_without_symlinks", sql="SELECT ord, DESTINATION_KEY FROM upload_log WHERE NOT ends_with(DESTINATION_KEY,'.symlink')")
def p14(t):
    return t.upload_log.filter(~F.endswith("DESTINATION_KEY", F.lit(".symlink"))).select("ord", "DESTINATION_KEY")


@query("p15_count_uncollated", sql="SELECT count(*) AS n FROM whole_lake WHERE NOT contains(key,'collated_')")
def p15(t):
    return t.whole_lake.filter(~F.contains("key", F.lit("collated_"))).agg(F.count(F.lit(1)).alias("n"))


@query("p16_log_presence", sql="""SELECT c_name, coalesce(max(CASE WHEN key=c_name||'-backup.csv' THEN 2 WHEN key=c_name||'-files.csv' THEN 1 END),0) AS state
    FROM customer JOIN log_keys ON regexp_extract(key,'^Customer#[0-9]+')=c_name GROUP BY c_name""")
def p16(t):
    logs = t.log_keys.withColumn("c_name", F.regexp_extract("key", "^Customer#[0-9]+", 0))
    state = selection.log_state(F.col("key"), F.concat("c_name", F.lit("-backup.csv")), F.concat("c_name", F.lit("-files.csv")))
    return logs.join(t.table("customer").select("c_name"), "c_name", "left_semi").groupBy("c_name").agg(state.alias("state"))


@query("p17_needs_download", sql="SELECT key FROM remote WHERE trim(key) NOT IN (SELECT object_name FROM listing WHERE is_link)")
def p17(t):
    here = t.listing.filter("is_link").select(F.col("object_name").alias("path"))
    return lookups.missing_local(t.remote, here).select("key")
