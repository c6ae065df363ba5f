"""Archive completeness, audits and action tables."""

from pyspark.sql import functions as F

from invspark.functions import names, values
from invspark.operators import lookups, stats
from invspark.plans import actions, archive, segments, verify
from invspark.session import materialise, mounted_dir
from invspark.sources import tree

from .base import query
from .views import DEST, LAKE, SEGMENT

VERDICTS = """zips AS (SELECT key AS zip_key FROM lake WHERE key LIKE '%.zip'),
    c AS MATERIALIZED (SELECT zip_key, count(*) AS total, count(key) AS found FROM packed LEFT JOIN (SELECT key FROM lake WHERE key NOT LIKE '%.zip' AND key NOT LIKE '%.metadata') ON key=member GROUP BY zip_key),
    verdicts AS MATERIALIZED (SELECT z.zip_key, coalesce(total,0) AS total, coalesce(found,0) AS found, coalesce(found<>total,true) AS extract, coalesce(found=total,false) AS deletable
      FROM zips z LEFT JOIN c USING (zip_key))"""


def verdicts(t):
    zips = t.lake.filter(F.col("kind") == "zip").select(F.col("key").alias("zip_key"))
    return verify.completeness(zips, t.packed, t.lake, unique=True, kind="kind")


@query("j04_existing_members", sql="SELECT zip_key, member FROM packed WHERE member IN (SELECT key FROM lake)")
def j04(t):
    return verify.existing_members(t.packed, t.lake, unique=True).select("zip_key", "member")


@query("j05_folded_flags", ctes=VERDICTS, sql="SELECT key, coalesce(extract,false) AS extract FROM lake LEFT JOIN verdicts ON zip_key=key")
def j05(t):
    flags = verdicts(t).select(F.col("zip_key").alias("key"), "extract")
    return lookups.fold_flag(t.lake.select("key"), flags, "key", "extract")


@query("j06_counts_for_all_archives", ctes=VERDICTS, sql="SELECT zip_key, found FROM verdicts")
def j06(t):
    return verdicts(t).select("zip_key", "found")


@query("a05_archive_completeness", ctes=VERDICTS, sql="SELECT * FROM verdicts")
def a05(t):
    return verdicts(t)


@query("a05_manifest_completeness", ctes="""n AS (SELECT zip_key, unnest(list_distinct(string_split_regex(text,'[|;,]'))) AS name FROM manifest),
    c AS (SELECT zip_key, count(*) AS total, count(key) AS found FROM n LEFT JOIN remote ON key='backup/'||name GROUP BY zip_key)""",
    sql="SELECT m.zip_key, coalesce(total,0) AS total, coalesce(found,0) AS found, coalesce(found<>total,true) AS extract, coalesce(found=total,false) AS deletable FROM manifest m LEFT JOIN c USING (zip_key)")
def a05_manifests(t):
    return verify.completeness(t.manifest, verify.explode_members(t.manifest), t.store)


@query("a05_loose_completeness", ctes=VERDICTS.replace("lake WHERE key NOT LIKE '%.zip' AND key NOT LIKE '%.metadata'", "lake"), sql="SELECT * FROM verdicts")
def a05_loose(t):
    """Archives and manifests in the store count as members found, too."""
    zips = t.lake.filter(names.is_zip(F.col("key"))).select(F.col("key").alias("zip_key"))
    return verify.completeness(zips, t.packed, t.lake, unique=True, strict=False)


@query("i08_manifest_members", ctes="""n AS (SELECT zip_key, unnest(list_distinct(list_filter(CASE WHEN contains(text,'|') THEN string_split(text,'|') WHEN contains(text,';') THEN string_split(text,';')
    ELSE string_split(text,',') END, lambda x: x<>''))) AS name FROM manifest)""", sql="SELECT zip_key, 'backup/'||name AS member FROM n")
def i08(t):
    """Manifests written as text objects, read back and parsed."""
    from invspark.plans import archive
    from invspark.session import materialise, shared_dir
    from invspark.sources import text

    where = shared_dir(t.spark, "manifests")
    materialise(archive.write_manifests(t.manifest.filter("text is not null"), where), "written")
    return verify.explode_members(text.read_manifests(t.spark, where)).select("zip_key", "member")


@query("i08_manifest_source", sql="SELECT zip_key, text FROM manifest WHERE text IS NOT NULL")
def i08_source(t):
    """The same manifests by the data source of their name."""
    where = mounted_dir(t.spark, "manifests")
    materialise(archive.write_manifests(t.manifest.filter("text is not null"), where), "written")
    tree.register(t.spark)
    return t.spark.read.format("manifests").load(where)


@query("j07_not_yet_verified", sql="""SELECT ord, DESTINATION_KEY FROM upload_log WHERE NOT ends_with(DESTINATION_KEY,'.symlink')
    AND DESTINATION_KEY NOT IN (SELECT DESTINATION_KEY FROM verification)""")
def j07(t):
    return verify.to_verify(t.upload_log, t.verification).select("ord", "DESTINATION_KEY")


@query("j08_logs_without_verification", sql="""SELECT key FROM log_keys WHERE (key LIKE '%backup.csv' OR key LIKE '%files.csv')
    AND regexp_replace(key,'-(files|backup)[.]csv$','-backup-verification.csv') NOT IN (SELECT key FROM log_keys WHERE key LIKE '%backup-verification.csv')""")
def j08(t):
    return lookups.unverified_logs(t.log_keys).select("key")


@query("j09_orphan_manifests", sql="SELECT key FROM lake WHERE key LIKE '%.metadata' AND replace(key,'.metadata','') NOT IN (SELECT key FROM lake WHERE key LIKE '%.zip')")
def j09(t):
    return lookups.orphan_manifests(t.lake).select("key")


DECISIONS = """SELECT 'backup/'||source||'/'||lang||'/'||doc_id||'.txt' AS key, CASE WHEN etag IS NULL THEN 'upload' WHEN etag=md5(text) THEN 'skip' WHEN contains(etag,'-') THEN 'skip segmented' ELSE 'replace' END AS decision
    FROM documents LEFT JOIN remote r ON r.key='backup/'||source||'/'||lang||'/'||doc_id||'.txt'"""


@query("j10_sync_decision", sql=DECISIONS)
def j10(t):
    members = t.contents.select(F.concat(F.lit(DEST + "/"), "member").alias("key"), F.md5("content").alias("md5"))
    return lookups.sync_decision(members, t.remote).select("key", "decision")


@query("a03_any_and_all", sql="""SELECT DESTINATION_KEY, bool_and(CHECKSUM_MATCH) AS all_match, bool_or(SIZE_MATCH) AS any_size FROM checks GROUP BY 1""")
def a03(t):
    return t.checks.groupBy("DESTINATION_KEY").agg(
        stats.all_true(F.col("CHECKSUM_MATCH")).alias("all_match"), stats.any_true(F.col("SIZE_MATCH")).alias("any_size")
    )


@query("a03_empty_all", sql="SELECT count(*) AS n, coalesce(bool_and(CHECKSUM_MATCH),true) AS checksums_match, coalesce(bool_and(SIZE_MATCH),true) AS sizes_match FROM checks WHERE DESTINATION_KEY=''")
def a03_empty(t):
    return verify.audit_verdict(t.checks.filter("DESTINATION_KEY = ''"))


@query("a04_session_verdict", sql="""SELECT coalesce(bool_and(dur_us>0) FILTER (kind='zip'),true) AS zips_ok, coalesce(bool_and(dur_us>0) FILTER (kind='file'),true) AS files_ok,
    coalesce(bool_and(dur_us>0),true) AS success FROM transfers""")
def a04(t):
    return stats.verdict(t.transfers.withColumn("ok", F.col("dur_us") > 0))


@query("c03_content_audit", sql="""SELECT key AS DESTINATION_KEY, etag AS CHECKSUM, etag=md5(text) AS CHECKSUM_MATCH, md5(text) AS NEW_CHECKSUM, size AS FILE_SIZE,
    octet_length(encode(text))::BIGINT AS SIZE_ON_S3, size=octet_length(encode(text)) AS SIZE_MATCH FROM stored JOIN documents ON key='backup/'||source||'/'||lang||'/'||doc_id||'.txt'""")
def c03(t):
    log = t.stored.select(F.col("key").alias("DESTINATION_KEY"), F.col("etag").alias("CHECKSUM"), F.col("size").alias("FILE_SIZE"))
    objects = t.contents.select(
        F.concat(F.lit(DEST + "/"), "member").alias("key"), F.md5("content").alias("md5"), F.octet_length("content").cast("long").alias("size")
    )
    return verify.audit(log, objects)


def sent_and_stored(t):
    """The log of sent segments, and the store's objects written as files."""
    sized = t.contents.select(F.concat(F.lit(DEST + "/"), "member").alias("key"), "content", F.octet_length("content").cast("long").alias("size"))
    cut = segments.segments(sized.select(F.struct("key", "content").alias("object"), "size"), SEGMENT, key="object")
    start, length = F.col("start"), F.col("end") - F.col("start")
    logged = cut.select("object.key", "segment", "start", "end", F.md5(F.substring("object.content", (start + 1).cast("int"), length.cast("int"))).alias("md5"))
    where = mounted_dir(t.spark, "segmented")
    files = t.segmented.select(F.col("key").alias("zip_key"), F.col("stored").alias("content")).repartition("zip_key")
    materialise(archive.write_contents(files, where), "written")
    return logged, t.segmented.select("key", "size", "etag", F.concat(F.lit(where + "/"), "key").alias("path"))


PIECES = """pieces AS (SELECT s.key, i+1 AS segment, i*1000 AS start, least((i+1)*1000,length(s.h)//2) AS "end", r.key IS NULL AS gone, md5(unhex(substr(s.h,2000*i+1,2000))) AS logged_md5,
      CASE WHEN length(r.h)//2>=least((i+1)*1000,length(s.h)//2) THEN md5(unhex(substr(r.h,2000*i+1,2*(least((i+1)*1000,length(s.h)//2)-i*1000)))) END AS md5
    FROM (SELECT *, unnest(range(greatest(1,ceil(length(h)/2000)::BIGINT))) AS i FROM sent_hex) s LEFT JOIN segmented r ON r.key=s.key)"""


@query("c03_segmented_audit", ctes=PIECES, sql="""SELECT p.key, count(*) AS n_segments, count_if(md5 IS DISTINCT FROM logged_md5)::BIGINT AS n_differing, any_value(e.etag) AS logged_etag, any_value(r.etag) AS etag,
    CASE WHEN any_value(r.key) IS NULL THEN 'missing' WHEN bool_or(md5 IS DISTINCT FROM logged_md5) OR any_value(r.size)<>max("end") THEN 'altered'
      WHEN any_value(r.etag)=any_value(e.etag) THEN 'same' WHEN any_value(r.n)<>count(*) THEN 're-cut' ELSE 'etag differs' END AS verdict
    FROM pieces p JOIN sent_hex USING (key) JOIN sent_etags e USING (doc_id) LEFT JOIN segmented r ON r.key=p.key GROUP BY p.key""")
def c03_segmented(t):
    """Every object sent in segments: its stored bytes read by range, and both levels of its checksum compared."""
    logged, stored = sent_and_stored(t)
    compared = materialise(segments.compare(logged, stored), "compared")
    return segments.audit(compared, stored)


@query("c03_differing_segments", ctes=PIECES, sql="""SELECT key, segment, start, "end", logged_md5, md5, CASE WHEN gone THEN 'missing' WHEN md5 IS NULL THEN 'EndsEarly' END AS error FROM pieces WHERE md5 IS DISTINCT FROM logged_md5""")
def c03_differing(t):
    """Only what must be sent again, by segment."""
    return segments.differing(segments.compare(*sent_and_stored(t)))


@query("j10_segmented_decision", sql="""SELECT s.key, CASE WHEN r.etag IS NULL THEN 'upload' WHEN r.etag=e.etag OR r.etag=md5(unhex(s.h)) THEN 'skip' WHEN contains(r.etag,'-') AND (NOT contains(e.etag,'-') AND split_part(r.etag,'-',2)<>'1' OR contains(e.etag,'-') AND split_part(r.etag,'-',2)<>split_part(e.etag,'-',2)) THEN 'skip segmented' ELSE 'replace' END AS decision
    FROM sent_hex s JOIN sent_etags e USING (doc_id) LEFT JOIN segmented r ON r.key=s.key""")
def j10_segmented(t):
    """Members compared with objects in segments, where both are cut alike."""
    members = t.contents.select(F.concat(F.lit(DEST + "/"), "member").alias("key"), F.md5("content").alias("md5"), values.segmented_etag(F.col("content"), SEGMENT).alias("segmented_etag"))
    return lookups.sync_decision(members, t.segmented).select("key", "decision")


@query("c03_audit_verdict", sql="SELECT count(*) AS n, bool_and(CHECKSUM_MATCH) AS checksums_match, bool_and(SIZE_MATCH) AS sizes_match FROM checks")
def c03_verdict(t):
    return verify.audit_verdict(t.checks)


@query("c05_delete_plan", ctes=VERDICTS, sql="""SELECT 'delete' AS action, zip_key AS key, zip_key||'.metadata' AS target, 'all members in store' AS reason FROM verdicts WHERE deletable
    UNION ALL SELECT 'keep', zip_key, NULL, CASE WHEN total=0 THEN 'no readable manifest' ELSE 'members missing' END FROM verdicts WHERE NOT deletable""")
def c05(t):
    return actions.delete_archives(verdicts(t))


@query("c05_orphan_delete_plan", sql="SELECT 'delete' AS action, key, NULL::VARCHAR AS target, 'archive is gone' AS reason FROM lake WHERE key LIKE '%.metadata' AND NOT EXISTS (SELECT 1 FROM lake z WHERE z.key=replace(lake.key,'.metadata',''))")
def c05_orphans(t):
    return actions.delete_orphans(t.lake)


@query("c06_move_plan", sql="SELECT 'copy' AS action, key, 'archive/'||key AS target, 'move' AS reason FROM whole_lake")
def c06(t):
    return actions.move(t.whole_lake, "archive")


@query("c06_delete_copied", sql="SELECT 'delete' AS action, key, NULL::VARCHAR AS target, 'copied' AS reason FROM whole_lake WHERE size>20000")
def c06_second(t):
    results = t.whole_lake.select("key", F.when(F.col("size") > 20000, "done").otherwise("failed").alias("status"))
    return actions.delete_copied(actions.move(t.whole_lake, "archive"), results)


@query("c07_download_plan", sql="""SELECT CASE WHEN regexp_matches(key,'collated_.*\\.zip$','i') THEN 'fetch and extract' ELSE 'fetch' END AS action, key, NULL::VARCHAR AS target, 'not present' AS reason
    FROM whole_lake WHERE NOT regexp_matches(key,'collated_.*\\.zip\\.metadata','i') AND key NOT IN (SELECT member FROM packed JOIN lineitem ON member='lake/'||l_partkey||'-'||l_linenumber||'-'||l_suppkey WHERE l_linestatus='O')""")
def c07(t):
    here = t.table("lineitem").filter("l_linestatus = 'O'").select(t._lake_member().alias("path"))
    return actions.download(t.whole_lake, here)


@query("c08_bulk_delete_plan", sql="SELECT 'delete' AS action, key, NULL::VARCHAR AS target, 'listed' AS reason, NULL::VARCHAR AS status, NULL::VARCHAR AS error FROM whole_lake WHERE starts_with(key,'lake/collated_1')")
def c08(t):
    return actions.delete_listed(t.whole_lake, LAKE + "/collated_1")


@query("c09_log_retention", ctes="""aged AS (SELECT folder, name, ((SELECT max(modified_us) FROM old_logs)-modified_us)//86400000000>=400 AS old FROM old_logs),
    ok AS (SELECT folder FROM aged GROUP BY folder HAVING count(*)>2 AND count_if(old)>0 AND count(*)-count_if(old)>2)""",
    sql="SELECT 'delete' AS action, folder||'/'||name AS key, NULL::VARCHAR AS target, 'old log' AS reason FROM aged WHERE old AND folder IN (SELECT folder FROM ok)")
def c09(t):
    now = t.old_logs.agg(F.max("modified_us")).scalar()
    return actions.retention(t.old_logs, now, min_age_days=400)
