"""Upload planning: diff, routing, batching, roll-ups, folder statistics."""

from pyspark.sql import functions as F

from invspark.functions import names, paths, units
from invspark.operators import batching, folders, lookups, ordered, reconcile, stats
from invspark.plans import segments, upload, verify
from invspark.session import materialise, shared_dir
from invspark.sources import listing

from .base import query
from .views import DEST, LAKE, ROOT

MAX, COUNT, PART = 20_000, 40, 250

MISSING = "missing AS (SELECT * FROM files WHERE object_name NOT IN (SELECT key FROM remote))"


def fold(source: str, max_size: int, count: int, part: int, columns: str) -> str:
    """Next-fit as a recursive query: one step per row, all parts side by side."""
    full = f"((f.cum+t.size>{max_size} AND f.cum>0) OR f.n>={count})"
    return f"""ordered AS MATERIALIZED (SELECT {columns}, ord//{part} AS part, row_number() OVER (PARTITION BY ord//{part} ORDER BY ord) AS rn FROM {source}),
    fold AS (SELECT part, rn, ord, size, 0::BIGINT AS batch, size AS cum, 1::BIGINT AS n FROM ordered WHERE rn=1
      UNION ALL SELECT t.part, t.rn, t.ord, t.size, CASE WHEN {full} THEN f.batch+1 ELSE f.batch END,
        CASE WHEN {full} THEN t.size ELSE f.cum+t.size END, CASE WHEN {full} THEN 1 ELSE f.n+1 END
      FROM fold f JOIN ordered t ON t.part=f.part AND t.rn=f.rn+1)"""


SMALL = f"small AS (SELECT * FROM missing WHERE size<={MAX}/2)"
PLAN = (MISSING, SMALL, fold("small", MAX, COUNT, PART, "ord, path, object_name, size"))


def plan(t):
    return upload.upload_plan(t.files, t.remote, MAX)


def archives(t):
    return upload.archive_plan(plan(t), DEST, MAX, COUNT, PART)


@query("j01_not_in_store", ctes=MISSING, sql="SELECT ord, path, object_name, size FROM missing")
def j01(t):
    return lookups.missing(t.files, t.remote, "object_name").select("ord", "path", "object_name", "size")


@query("j01_not_in_store_at_size", sql="SELECT zip_key, member FROM packed WHERE member NOT IN (SELECT key FROM lake)")
def j01_big(t):
    return lookups.missing(t.packed, t.lake, "member", unique=True).select("zip_key", "member")


@query("w01_archives_to_build", ctes=PLAN, sql="""SELECT part*1000000+batch AS id, 'backup/collated_'||(part*1000000+batch)||'.zip' AS zip_key, count(*) AS n_members,
    sum(fold.size)::BIGINT AS size, string_agg(object_name,'|' ORDER BY ord) AS object_names FROM fold JOIN ordered USING (ord, part) GROUP BY part, batch""")
def w01(t):
    return archives(t).select("id", "zip_key", "n_members", "size", batching.joined_names(F.col("members"), "object_name").alias("object_names"))


@query("w01_next_fit_at_size", ctes=("sized AS (SELECT o_orderkey AS ord, floor(o_totalprice)::BIGINT AS size FROM orders)", fold("sized", 2_000_000, 12, 1000, "ord, size")),
       sql="SELECT ord, size, part, batch FROM fold")
def w01_orders(t):
    sized = t.table("orders").select(F.col("o_orderkey").alias("ord"), F.floor("o_totalprice").cast("long").alias("size"))
    return batching.assign_batches(sized, 2_000_000, 12, 1000).select("ord", "size", "part", "batch")


@query("w02_global_batch_ids", ctes=("f AS (SELECT ord, size FROM files)", fold("f", MAX, 10, 100, "ord, size")), sql="SELECT ord, part*1000000+batch AS id FROM fold")
def w02(t):
    return batching.assign_batches(t.files.select("ord", "size"), MAX, 10, 100).select("ord", "id")


@query("w03_batches_with_individuals", ctes=("f AS (SELECT ord, size FROM files WHERE size<=4000)", fold("f", MAX, PART, PART, "ord, size")),
       sql=f"SELECT ord, part, batch+1 AS batch FROM fold UNION ALL SELECT ord, ord//{PART}, 0 FROM files WHERE size>4000")
def w03(t):
    return batching.assign_batches_skipping(t.files.select("ord", "size"), F.col("size") > 4000, MAX, PART).select("ord", "part", "batch")


@query("w04_count_limited_batches", ctes=("f AS (SELECT ord, size FROM files)", fold("f", 10**12, 50, 500, "ord, size")),
       sql="SELECT part, batch, count(*) AS n, sum(size)::BIGINT AS bytes FROM fold GROUP BY part, batch")
def w04(t):
    limit = batching.members_limit(200)
    batched = batching.assign_batches(t.files.select("ord", "size"), 10**12, limit, 500)
    return batched.groupBy("part", "batch").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))


@query("w05_fixed_chunks", sql="SELECT user_id, event_id AS ord, (row_number() OVER (PARTITION BY user_id ORDER BY event_id)-1)//7 AS chunk FROM events")
def w05(t):
    rows = t.table("events").select("user_id", F.col("event_id").alias("ord"))
    return ordered.chunks(rows, ["user_id"], "ord", 7, narrow=True)


@query("w05_refilled_archives", ctes="m AS (SELECT zip_key, member, (row_number() OVER (ORDER BY ord)-1)//30 AS chunk FROM (SELECT zip_key, 'backup/'||name AS member, ord FROM manifest_names))",
       sql="SELECT chunk, count(*) AS n, min(member) AS first_member, max(member) AS last_member FROM m GROUP BY chunk")
def w05_refill(t):
    members = t.files.select("ord", F.col("object_name").alias("member"))
    return ordered.chunks(members, [], "ord", 30).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("member").alias("first_member"), F.max("member").alias("last_member"))


@query("a01_batch_roll_up", ctes=PLAN, sql="""SELECT part*1000000+batch AS id, count(*) AS n_members, sum(fold.size)::BIGINT AS size, string_agg(path,'|' ORDER BY ord) AS paths
    FROM fold JOIN ordered USING (ord, part) GROUP BY part, batch""")
def a01(t):
    return archives(t).select("id", "n_members", "size", batching.joined_names(F.col("members"), "path").alias("paths"))


@query("a23_batches_over_limit", ctes=("f AS (SELECT ord, size FROM files)", fold("f", 5000, 8, PART, "ord, size")),
       sql="""SELECT count(*) AS n_batches, count_if((bytes>5000 AND filled>1) OR n>8)::BIGINT AS n_broken, max(n) AS most, max(CASE WHEN filled>1 THEN bytes END)::BIGINT AS largest
       FROM (SELECT part, batch, count(*) AS n, sum(size)::BIGINT AS bytes, count_if(size>0) AS filled FROM fold GROUP BY part, batch)""")
def a23(t):
    batched = batching.assign_batches(t.files.select("ord", "size"), 5000, 8, PART)
    per_batch = batched.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"), F.count_if(F.col("size") > 0).alias("filled"))
    broken = batching.over_limit(batched, 5000, 8).agg(F.count(F.lit(1))).scalar()
    return per_batch.agg(
        F.count(F.lit(1)).alias("n_batches"), broken.alias("n_broken"), F.max("n").alias("most"),
        F.max(F.when(F.col("filled") > 1, F.col("bytes"))).alias("largest"),
    )


@query("j02_archives_still_to_build", ctes=PLAN, sql="""SELECT 'backup/collated_'||id||'.zip' AS zip_key, n, bytes FROM
    (SELECT part*1000000+batch AS id, count(*) AS n, sum(size)::BIGINT AS bytes FROM fold GROUP BY part, batch)
    WHERE 'backup/collated_'||id||'.zip' NOT IN (SELECT key FROM store)""")
def j02(t):
    return upload.still_to_build(archives(t), t.store).select("zip_key", F.col("n_members").alias("n"), F.col("size").alias("bytes"))


@query("j03_single_files_to_send", ctes=f"""m AS (SELECT 'backup/'||unnest(string_split_regex(text,'[|;,]')) AS member FROM manifest WHERE text IS NOT NULL), {MISSING}""",
       sql="SELECT ord, object_name, size FROM missing WHERE size>4000/2 AND object_name NOT IN (SELECT member FROM m)")
def j03(t):
    members = verify.explode_members(t.manifest)
    return upload.still_to_send(upload.upload_plan(t.files, t.remote, 4000), members).select("ord", "object_name", "size")


def _folder_members(t):
    # Orders seen as folders: their lines are the files on disk.
    return t.distinct_lines("l_linestatus = 'F'").select(
        F.col("l_orderkey").alias("folder"), t._lake_member().alias("member")
    )


@query("j13_folders_already_archived", ctes="""disk AS (SELECT DISTINCT l_orderkey AS folder, 'lake/'||l_partkey||'-'||l_linenumber||'-'||l_suppkey AS member FROM lineitem WHERE l_linestatus='F'),
    fl AS (SELECT folder, list(member ORDER BY member) AS names FROM disk GROUP BY folder), zl AS (SELECT zip_key, list(member ORDER BY member) AS names FROM packed GROUP BY zip_key)""",
    sql="SELECT folder, min(zip_key) AS zip_key FROM fl JOIN zl ON fl.names=zl.names GROUP BY folder")
def j13(t):
    return lookups.matching_manifests(_folder_members(t), t.packed, t.table("lineitem").count())


@query("j14_verified_folders", ctes="""logged AS (SELECT DISTINCT l_orderkey AS folder, l_partkey||'-'||l_linenumber AS name FROM lineitem WHERE l_returnflag<>'R'),
    disk AS (SELECT DISTINCT l_orderkey AS folder, l_partkey||'-'||l_linenumber AS name FROM lineitem WHERE l_linestatus='F'),
    c AS (SELECT folder, count(l.name) AS n_logged, count(d.name) AS n_local, count(CASE WHEN l.name IS NOT NULL AND d.name IS NOT NULL THEN 1 END) AS n_both
      FROM logged l FULL JOIN disk d USING (folder, name) GROUP BY folder)""",
    sql="SELECT folder, n_logged, n_local, n_both, n_logged=n_both AND n_local=n_both AS verified FROM c WHERE n_logged>0")
def j14(t):
    lines = t.table("lineitem").withColumn("folder", F.col("l_orderkey")).withColumn("name", F.concat_ws("-", "l_partkey", "l_linenumber"))
    return lookups.verified_folders(lines.filter("l_returnflag <> 'R'"), lines.filter("l_linestatus = 'F'"))


@query("j14_differing_names", ctes="""logged AS (SELECT DISTINCT l_orderkey AS folder, l_partkey||'-'||l_linenumber AS name FROM lineitem WHERE l_returnflag<>'R'),
    disk AS (SELECT DISTINCT l_orderkey AS folder, l_partkey||'-'||l_linenumber AS name FROM lineitem WHERE l_linestatus='F')""",
    sql="""SELECT folder, name, 'left' AS side FROM (SELECT * FROM logged EXCEPT SELECT * FROM disk) UNION ALL SELECT folder, name, 'right' FROM (SELECT * FROM disk EXCEPT SELECT * FROM logged)""")
def j14_names(t):
    """The names that keep folders from being verified, by invertible tables: logged and not on disk, or the other way."""
    lines = t.table("lineitem")
    names_ = lambda rows: rows.select(F.col("l_orderkey").alias("folder"), F.concat_ws("-", "l_partkey", "l_linenumber").alias("name")).distinct()
    return reconcile.differences(names_(lines.filter("l_returnflag <> 'R'")), names_(lines.filter("l_linestatus = 'F'")), "folder", "name")


@query("j15_complete_folders", sql="""SELECT regexp_replace(path,'/?[^/]*$','') AS folder, count(*) AS n_files, count(r.key) AS n_present, count(*)=count(r.key) AS skip
    FROM files LEFT JOIN remote r ON r.key=object_name GROUP BY 1""")
def j15(t):
    return lookups.complete_folders(t.files.withColumn("folder", paths.parent_dir(F.col("path"))), t.remote)


@query("j15_membership_flag", sql="SELECT member, key IS NOT NULL AS present FROM packed LEFT JOIN lake ON key=member")
def j15_flag(t):
    return lookups.membership(t.packed, t.lake, "member", unique=True).select("member", "present")


@query("a07_distinct_rows_in_order", sql="SELECT l_partkey, l_suppkey, min(l_orderkey*10+l_linenumber) AS first_ord FROM lineitem GROUP BY ALL")
def a07(t):
    lines = t.table("lineitem").withColumn("ord", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return stats.distinct_in_order(lines, ["l_partkey", "l_suppkey"], "ord")


def _folder_files(t):
    """Orders as files below folders of three levels."""
    o = t.table("orders")
    folder = F.concat(F.lit("/data/"), F.col("o_orderstatus"), F.lit("/c"), F.col("o_custkey").cast("string"))
    return o.select(
        F.col("o_orderkey").alias("ord"), folder.alias("folder"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".dat")).alias("name"), (F.floor("o_totalprice") * 512).cast("long").alias("size"),
    )


FOLDERS = """ff AS (SELECT o_orderkey AS ord, '/data/'||o_orderstatus||'/c'||o_custkey AS folder, o_orderkey||'.dat' AS name, floor(o_totalprice)::BIGINT*512 AS size FROM orders),
    dirs AS (SELECT DISTINCT folder FROM ff UNION SELECT DISTINCT regexp_replace(folder,'/[^/]*$','') FROM ff UNION SELECT '/data'),
    per AS (SELECT d.folder, count(f.name) AS n, coalesce(sum(f.size),0)::BIGINT AS b FROM dirs d LEFT JOIN ff f USING (folder) GROUP BY d.folder)"""


@query("a14_folder_statistics", ctes=FOLDERS, sql="SELECT folder, n AS n_files, b AS bytes FROM per")
def a14_folders(t):
    return folders.per_folder(_folder_files(t))


@query("a14_collation_advice", ctes=(FOLDERS, """g AS (SELECT count(*) AS n_folders, sum(n)::BIGINT AS n_files, sum(b)::BIGINT AS bytes, count_if(n>0 AND b/1048576.0::DOUBLE/n<=64)::BIGINT AS n_small_mean,
    count_if(n<=2)::BIGINT AS n_le_2, count_if(n>0 AND n<=2 AND b/1048576.0::DOUBLE/n<=64)::BIGINT AS n_collatable FROM per)"""),
    sql="""SELECT *, round(bytes/1048576.0::DOUBLE/n_files,6) AS mean_mib, round(n_files/n_folders,6) AS files_per_folder, round(n_small_mean*100.0::DOUBLE/n_folders,6) AS pct_small_mean,
    round(n_le_2*100.0::DOUBLE/n_folders,6) AS pct_le_2, round(n_collatable*100.0::DOUBLE/n_folders,6) AS pct_collatable,
    CASE WHEN n_small_mean*100.0/n_folders>10 AND n_collatable*100.0/n_folders>10 THEN 'advised: many small files and collatable folders'
    WHEN n_small_mean*100.0/n_folders>5 THEN 'advised: many small files, few collatable folders'
    WHEN n_collatable*100.0/n_folders>5 THEN 'advised: many collatable folders' ELSE 'not advised' END AS advice FROM g""")
def a14(t):
    out = folders.collation_advice(folders.per_folder(_folder_files(t)))
    return out.select(*[F.round(c, 6).alias(c) if kind == "double" else c for c, kind in out.dtypes])


@query("a15_sizes_to_depth", ctes=FOLDERS, sql="""SELECT folder, bytes, n_files, bytes/1073741824.0::DOUBLE AS gib FROM
    (SELECT '/data' AS folder, sum(size)::BIGINT AS bytes, count(*) AS n_files FROM ff
    UNION ALL SELECT regexp_replace(folder,'/[^/]*$',''), sum(size)::BIGINT, count(*) FROM ff GROUP BY 1)""")
def a15(t):
    return folders.sizes_to_depth(_folder_files(t), 2)


@query("a15_sizes_at_every_depth", ctes="""p AS (SELECT size, string_split(regexp_replace(key,'/?[^/]*$',''),'/') AS parts FROM page_objects WHERE contains(key,'/')),
    e AS (SELECT array_to_string(parts[1:depth],'/') AS folder, depth, size FROM (SELECT *, unnest(range(1,len(parts)+1)) AS depth FROM p))""",
    sql="SELECT folder, depth, count(*) AS n_files, sum(size)::BIGINT AS bytes FROM e GROUP BY folder, depth")
def a15_all(t):
    """Every folder at any depth, from its interval in the frozen listing."""
    frozen = materialise(listing.in_path_order(t.page_objects.select(F.col("key").alias("path"), "size")), "frozen")
    return folders.intervals(frozen).select("folder", "depth", "n_files", "bytes")


@query("a16_folder_routing", ctes=FOLDERS, sql="""SELECT folder, regexp_replace(folder,'/[^/]*$','') AS parent, n AS n_files, b AS bytes, folder LIKE '%/c%' AS is_leaf,
    CASE WHEN n=0 THEN 'empty' WHEN b/n>134217728 THEN 'individual' WHEN folder LIKE '%/c%' AND n<4 AND b<96*1048576 THEN 'as is' ELSE 'collate' END AS route FROM per""")
def a16(t):
    return folders.routing(_folder_files(t))


@query("a17_archives_per_parent", ctes=FOLDERS, sql="""SELECT parent, n_files, largest, ceil(n_files/ceil(1073741824/largest))::BIGINT AS n_archives FROM
    (SELECT regexp_replace(folder,'/[^/]*$','') AS parent, count(*) AS n_files, max(size) AS largest FROM ff GROUP BY 1)""")
def a17(t):
    return folders.archive_counts(_folder_files(t), units.GIB)


@query("a19_logged_lists_per_folder", ctes="""lv AS (SELECT *, len(string_split(folder,'/')) AS d FROM (SELECT event_id AS ord, CASE WHEN user_id%3=0 THEN '/data' WHEN user_id%3=1 THEN '/data/run'||(user_id%4)
    ELSE '/data/run'||(user_id%4)||'/u'||user_id END AS folder, event_id::VARCHAR AS name FROM events))""",
    sql="SELECT folder, list_no, string_agg(name,',' ORDER BY ord) AS names, count(*) AS n FROM (SELECT *, (row_number() OVER (PARTITION BY folder ORDER BY ord)-1)//500 AS list_no FROM lv WHERE d>(SELECT min(d) FROM lv)+1) GROUP BY folder, list_no")
def a19(t):
    user = F.col("user_id")
    run = F.concat(F.lit("/data/run"), (user % 4).cast("string"))
    folder = F.when(user % 3 == 0, "/data").when(user % 3 == 1, run).otherwise(F.concat(run, F.lit("/u"), user.cast("string")))
    logged = t.table("events").select(F.col("event_id").alias("ord"), folder.alias("folder"), F.col("event_id").cast("string").alias("name"))
    return folders.file_lists(folders.deep_only(logged), per_list=500)


@query("a25_first_of_group", sql="SELECT folder, arg_min(name, ord) AS first_name FROM (SELECT o_custkey AS folder, o_orderkey AS ord, o_orderkey||'.dat' AS name FROM orders) GROUP BY folder")
def a25(t):
    files = t.table("orders").select(F.col("o_custkey").alias("folder"), F.col("o_orderkey").alias("ord"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".dat")).alias("name"))
    return stats.first_per_key(files, "folder", "ord").select("folder", F.col("name").alias("first_name"))


@query("c04_segment_plan", sql="""SELECT key, n_segments, i+1 AS segment, i*50000 AS start, CASE WHEN n_segments=1 THEN size ELSE least((i+1)*50000,size) END AS "end" FROM
    (SELECT key, size, n_segments, unnest(range(n_segments)) AS i FROM (SELECT key, size, CASE WHEN size>75000 THEN ceil(size/50000)::BIGINT ELSE 1 END AS n_segments FROM whole_lake))""")
def c04(t):
    return segments.segments(t.whole_lake, 50_000, 75_000)


@query("c10_jobs_per_subfolder", sql="""SELECT CASE WHEN contains(key,'/') THEN split_part(key,'/',1) ELSE '' END AS subfolder, count(*) AS n_files, sum(size)::BIGINT AS bytes,
    NOT contains(min(key),'/') AS loose_files FROM page_objects GROUP BY 1""")
def c10(t):
    return folders.top_level_jobs(t.page_objects.withColumnRenamed("key", "relative"))


@query("c11_resumed_plan", ctes=PLAN, sql="""SELECT 'backup/collated_'||id||'.zip' AS zip_key, n FROM (SELECT part*1000000+batch AS id, count(*) AS n FROM fold GROUP BY part, batch)
    WHERE 'backup/collated_'||id||'.zip' NOT IN (SELECT key FROM store)""")
def c11(t):
    where = shared_dir(t.spark, "plan")
    upload.resume(where, lambda: archives(t), t.store)
    # The second call finds the saved plan.
    return upload.resume(where, lambda: archives(t), t.store).select("zip_key", F.col("n_members").alias("n"))


@query("o01_sorted_log", sql="SELECT ord, start_us FROM upload_log")
def o01(t):
    return t.upload_log.select("ord", "start_us").orderBy("start_us", "ord")


@query("o02_first_keys", sql="SELECT key, size FROM whole_lake ORDER BY key LIMIT 1000")
def o02(t):
    from invspark.operators import selection

    return selection.limited(t.whole_lake.select("key", "size"), "key", 1000)


@query("o03_head_and_tail", sql="(SELECT ord, FILE_SIZE FROM upload_log ORDER BY ord LIMIT 5) UNION ALL (SELECT ord, FILE_SIZE FROM upload_log ORDER BY ord DESC LIMIT 5)")
def o03(t):
    from invspark.operators import selection

    log = t.upload_log.select("ord", "FILE_SIZE")
    return selection.head(log, "ord").unionByName(selection.tail(log, "ord"))


@query("o04_concatenated_listings", sql="SELECT key, size FROM stored UNION ALL SELECT key, size FROM page_objects UNION ALL SELECT key, size FROM whole_lake")
def o04(t):
    pick = ["key", "size"]
    return t.stored.select(*pick).unionByName(t.page_objects.select(*pick)).unionByName(t.whole_lake.select(*pick))


@query("o05_exploded_members", ctes="""n AS (SELECT zip_key, list_distinct(list_filter(CASE WHEN contains(text,'|') THEN string_split(text,'|') WHEN contains(text,';') THEN string_split(text,';') ELSE string_split(text,',') END, lambda x: x<>'')) AS l FROM manifest)""",
       sql="SELECT zip_key, len(l) AS total, 'backup/'||unnest(l) AS member FROM n")
def o05(t):
    return verify.explode_members(t.manifest)


@query("o06_unique_sites", sql="SELECT DISTINCT split_part(BUCKET_NAME,'_',2) AS site, split_part(BUCKET_NAME,'_',-1) AS workers FROM upload_log")
def o06(t):
    run = F.col("BUCKET_NAME")
    return t.upload_log.select(names.site(run).alias("site"), names.token(run, "_", -1).alias("workers")).distinct()
