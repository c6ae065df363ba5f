"""Packing and unpacking archives."""

import zlib

from pyspark.sql import functions as F

from invspark.functions import paths
from invspark.operators import batching, lookups
from invspark.plans import actions, archive, logs, ranges
from invspark.session import materialise, mounted_dir
from invspark.sources import listing, tables

from .base import query
from .planning import fold
from .views import DEST

BATCHES = ("f AS (SELECT ord, size FROM files)", fold("f", 50_000, 60, 500, "ord, size"))


def to_pack(t):
    batched = batching.assign_batches(t.files.select("ord", "size"), 50_000, 60, 500)
    return batched.select("ord", paths.archive_key(F.col("id"), DEST).alias("zip_key")).join(t.contents, "ord")


@query("c01_packed_archives", ctes=BATCHES, sql="""SELECT 'backup/collated_'||(part*1000000+batch)||'.zip' AS zip_key, count(*) AS n_members, sum(octet_length(encode(text)))::BIGINT AS bytes,
    md5(string_agg(md5(text),'' ORDER BY source||'/'||lang||'/'||doc_id||'.txt')) AS digests FROM fold JOIN documents ON doc_id=ord GROUP BY part, batch""")
def c01(t):
    """Packed, read back, and compared by the digests of all members."""
    packed = archive.pack_contents(to_pack(t))
    members = archive.unpack_contents(packed.select("zip_key", "content"), keep_content=False)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("member", "md5"))), lambda m: m["md5"])
    return members.groupBy("zip_key").agg(
        F.count("member").alias("n_members"), F.sum("size").alias("bytes"), F.md5(F.array_join(ordered, "")).alias("digests")
    )


@query("c02_unpacked_members", ctes=BATCHES, sql="""SELECT 'backup/collated_'||(part*1000000+batch)||'.zip' AS zip_key, source||'/'||lang||'/'||doc_id||'.txt' AS member,
    octet_length(encode(text))::BIGINT AS size, md5(text) AS md5 FROM fold JOIN documents ON doc_id=ord""")
def c02(t):
    packed = archive.pack_contents(to_pack(t), compress=True)
    return archive.unpack_contents(packed, keep_content=False).select("zip_key", "member", "size", "md5")


@query("c02_unpack_and_sync", ctes=BATCHES, sql="""SELECT decision, count(*) AS n FROM (SELECT CASE WHEN etag IS NULL THEN 'upload' WHEN etag=md5(text) THEN 'skip' WHEN contains(etag,'-') THEN 'skip segmented' ELSE 'replace' END AS decision
    FROM documents LEFT JOIN remote r ON r.key='backup/'||source||'/'||lang||'/'||doc_id||'.txt') GROUP BY 1""")
def c02_sync(t):
    members = archive.unpack_contents(archive.pack_contents(to_pack(t)), keep_content=False)
    keyed = members.select(paths.join_key(paths.parent_dir(F.col("zip_key")), F.col("member")).alias("key"), "md5")
    return lookups.sync_decision(keyed, t.remote).groupBy("decision").agg(F.count(F.lit(1)).alias("n"))


@query("c02_extracted_members", ctes=BATCHES, sql="""SELECT status, 'backup/'||source||'/'||lang||'/'||doc_id||'.txt' AS key, octet_length(encode(text))::BIGINT AS size, md5(text) AS md5
    FROM (SELECT *, 'done' AS status FROM fold JOIN documents ON doc_id=ord) LEFT JOIN remote r ON r.key='backup/'||source||'/'||lang||'/'||doc_id||'.txt'
    WHERE etag IS NULL OR (etag<>md5(text) AND NOT contains(etag,'-'))""")
def c02_extracted(t):
    """Archives written as files; members that the store lacks or holds otherwise are written out and read again."""
    out, target = (mounted_dir(t.spark, name) for name in ("archives", "members"))
    contents = archive.pack_contents(to_pack(t), compress=True)
    stored = materialise(archive.write_contents(contents, out), "stored")
    members = materialise(archive.unpack_files(stored, out), "members")
    keyed = members.select("zip_key", "member", paths.join_key(paths.parent_dir(F.col("zip_key")), F.col("member")).alias("key"), "md5")
    wanted = lookups.sync_decision(keyed, t.remote).filter(F.col("decision").isin("upload", "replace"))
    done = materialise(archive.extract_files(wanted.select("zip_key", "member"), out, target), "extracted")
    written = done.select("status", paths.join_key(paths.parent_dir(F.col("zip_key")), F.col("member")).alias("key"))
    digests = archive.digest_files(written.select(F.concat(F.lit(target + "/"), "key").alias("path")))
    return written.join(digests.select(F.substring("path", F.lit(len(target) + 2), F.length("path")).alias("key"), "size", "md5"), "key")


def document_files(t):
    """Every document as a file below a shared folder, by several tasks; the folder."""
    where = mounted_dir(t.spark, "documents")
    files = t.contents.select(F.col("member").alias("zip_key"), "content").repartition("zip_key")
    materialise(archive.write_contents(files, where), "written")
    return where


def frozen_files(t):
    """These files, walked and numbered in path order."""
    where = document_files(t)
    return listing.freeze(listing.walk_tree(t.spark, where), where, DEST)


# What the SQL knows of the same files: ``ord`` is their place in path order.
TREE = "tree AS (SELECT row_number() OVER (ORDER BY member)-1 AS ord, member, bytes AS size, md5 FROM (SELECT source||'/'||lang||'/'||doc_id||'.txt' AS member, octet_length(encode(text))::BIGINT AS bytes, md5(text) AS md5 FROM documents))"
TREE_BATCHES = (TREE, fold("tree", 200_000, 20, batching.ROWS_PER_PART, "ord, size"))


def below(path, folder: str):
    """The path relative to ``folder``."""
    return F.substring(path, F.lit(len(folder) + 2), F.length(path))


@query("c01_packed_files", ctes=TREE_BATCHES, sql="""SELECT 'backup/collated_'||(part*1000000+batch)||'.zip' AS zip_key, member, size, md5 FROM fold JOIN (SELECT ord, member, md5 FROM tree) USING (ord)""")
def c01_files(t):
    """Files packed into archives on disk by one task each, and read back."""
    out = mounted_dir(t.spark, "archives")
    plan = batching.roll_up(batching.assign_batches(frozen_files(t), 200_000, 20), DEST)
    packed = materialise(archive.pack_files(plan, out, DEST, compress=True), "packed")
    return archive.unpack_files(packed, out).select("zip_key", "member", "size", "md5")


@query("i07_log_of_packed_files", ctes=TREE_BATCHES, sql="""SELECT 'backup/collated_'||(part*1000000+batch)||'.zip' AS "DESTINATION_KEY", count(*)::VARCHAR AS "FILES_PER_ZIP", true AS same_size, true AS same_checksum, true AS in_order,
    CASE WHEN count(*)>5 THEN list_aggregate(list(member ORDER BY ord)[1:5],'string_agg','|')||' abbreviated' ELSE string_agg(member,'|' ORDER BY ord) END AS "ZIP_CONTENTS" FROM fold JOIN (SELECT ord, member FROM tree) USING (ord) GROUP BY part, batch""")
def i07_packed(t):
    """A packing job's own rows and times, appended to the log, read back and held against the archives as they lie there."""
    out, log = mounted_dir(t.spark, "archives"), mounted_dir(t.spark, "log")
    plan = batching.roll_up(batching.assign_batches(frozen_files(t), 200_000, 20), DEST)
    packed = materialise(archive.pack_files(plan, out, DEST), "packed")
    tables.append_log(logs.packed_rows(packed, out, "store"), log)
    back = tables.typed_log(t.spark.read.parquet(log).withColumn("members", F.col("FILES_PER_ZIP")))
    digests = archive.digest_files(back.select(F.col("LOCAL_PATH").alias("path"))).withColumnRenamed("path", "LOCAL_PATH")
    return back.join(digests, "LOCAL_PATH").select(
        "DESTINATION_KEY", F.col("members").alias("FILES_PER_ZIP"), "ZIP_CONTENTS", (F.col("FILE_SIZE") == F.col("size")).alias("same_size"), (F.col("CHECKSUM") == F.col("md5")).alias("same_checksum"),
        ((F.col("start_us") <= F.col("end_us")) & (F.abs(F.col("UPLOAD_TIME") * 1e6 - (F.col("end_us") - F.col("start_us"))) < 1)).alias("in_order"),
    )


def large_archives(t):
    """One archive per source, its members cut into pieces of 4 KiB and deflated by all tasks."""
    out, work = mounted_dir(t.spark, "archives"), mounted_dir(t.spark, "pieces")
    source = F.element_at(F.split("object_name", "/"), 2)
    members = frozen_files(t).select(
        F.concat(F.lit(DEST + "/"), source, F.lit(".zip")).alias("zip_key"), "ord", F.concat_ws("/", F.slice(F.split("object_name", "/"), 3, 9)).alias("member"), "path", "size"
    )
    return out, ranges.build_archives(ranges.deflate_pieces(members, work, piece=4096), out, range_bytes=1 << 16)


LARGE = "SELECT 'backup/'||source||'.zip' AS zip_key, lang||'/'||doc_id||'.txt' AS member, octet_length(encode(text))::BIGINT AS size, md5(text) AS md5 FROM documents"


@query("c01_archives_of_many_tasks", sql=LARGE)
def c01_many(t):
    """Archives each built by many tasks, read back by a sequential reader."""
    out, built = large_archives(t)
    return archive.unpack_files(built.filter("status = 'done'"), out).select("zip_key", "member", "size", "md5")


@query("c02_members_by_range", sql=f"SELECT *, 'done' AS status FROM ({LARGE})")
def c02_ranges(t):
    """Archives indexed, and their members inflated from byte ranges by many tasks per archive."""
    out, built = large_archives(t)
    index = materialise(ranges.index_archives(built, out), "index")
    return ranges.unpack_ranges(index, out, 1 << 16).select("zip_key", "member", "size", "md5", "status")


@query("c02_extracted_by_range", sql="""SELECT 'done' AS status, 'backup/'||lang||'/'||doc_id||'.txt' AS key, octet_length(encode(text))::BIGINT AS size, md5(text) AS md5
    FROM documents LEFT JOIN remote r ON r.key='backup/'||source||'/'||lang||'/'||doc_id||'.txt' WHERE etag IS NULL OR (etag<>md5(text) AND NOT contains(etag,'-'))""")
def c02_extracted_ranges(t):
    """Members that the store lacks or holds otherwise are extracted by many tasks per archive, and the files read again."""
    (out, built), target = large_archives(t), mounted_dir(t.spark, "members")
    index = materialise(ranges.index_archives(built, out), "index")
    found = ranges.unpack_ranges(index, out, 1 << 16)
    keyed = found.select("zip_key", "member", F.concat(F.regexp_replace("zip_key", "[.]zip$", "/"), "member").alias("key"), "md5")
    wanted = lookups.sync_decision(keyed, t.remote).filter(F.col("decision").isin("upload", "replace")).select("zip_key", "member")
    done = materialise(ranges.extract_ranges(index.join(wanted, ["zip_key", "member"]), out, target, 1 << 16), "extracted")
    written = done.select("status", paths.join_key(paths.parent_dir(F.col("zip_key")), F.col("member")).alias("key"))
    digests = archive.digest_files(written.select(F.concat(F.lit(target + "/"), "key").alias("path")))
    return written.join(digests.select(below("path", target).alias("key"), "size", "md5"), "key")


@query("u05_applied_actions", sql="SELECT source||'/'||lang||'/'||doc_id||'.txt' AS key, 'done' AS copied, 'done' AS deleted, octet_length(encode(text))::BIGINT AS size, md5(text) AS md5 FROM documents")
def u05(t):
    """A move carried out on files by tasks with side effects: copy, then delete what was copied; the moved files are read again."""
    where = document_files(t)
    keys = listing.walk_tree(t.spark, where).filter("not is_dir").select(below("path", where).alias("key"))
    copies = actions.move(keys, "moved")
    first = materialise(archive.apply_actions(copies, where), "copied")
    second = materialise(archive.apply_actions(actions.delete_copied(copies, first), where), "deleted")
    now = materialise(listing.walk_tree(t.spark, where).filter("not is_dir").select("path", below("path", where).alias("target")), "now")
    old_gone = lookups.missing(second, now, "key", "target").select("key", F.col("status").alias("deleted"))
    moved = archive.digest_files(now).select(below("path", where).alias("target"), "size", "md5")
    return first.select("key", "target", F.col("status").alias("copied")).join(moved, "target").join(old_gone, "key").drop("target")


@query("c11_resumed_actions", sql="SELECT source||'/'||lang||'/'||doc_id||'.txt' AS key, 1::BIGINT AS n_done, CASE WHEN n_chars%2=0 THEN 1 ELSE 2 END::BIGINT AS n_tried, md5(text) AS md5 FROM documents")
def c11_actions(t):
    """A plan of copies run twice under its id: what could not be read the first time is done the second time, the rest is not done again."""
    where, results = document_files(t), mounted_dir(t.spark, "results")
    # The first run finds half of the files gone.
    sizes = t.table("documents").select(F.concat("source", F.lit("/"), "lang", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("key"), "n_chars")
    plan = materialise(actions.with_plan_id(actions.move(sizes, "copies"), "plan 1"), "plan")
    away = sizes.filter("n_chars % 2 <> 0").select(F.lit("copy").alias("action"), "key", F.concat(F.lit("away/"), "key").alias("target"))
    gone = materialise(archive.apply_actions(away, where), "away")
    materialise(archive.apply_actions(gone.select(F.lit("delete").alias("action"), "key", F.lit(None).cast("string").alias("target")), where), "gone")

    def run(todo, number):
        done = actions.with_plan_id(archive.apply_actions(todo, where), "plan 1").withColumn("run", F.lit(number))
        done.write.mode("append").parquet(results)
        return t.spark.read.parquet(results)

    first = run(plan, 1)
    back = gone.select(F.lit("copy").alias("action"), F.col("target").alias("key"), F.col("key").alias("target"))
    materialise(archive.apply_actions(back, where), "back")
    both = run(actions.undone(plan, first), 2)
    copied = archive.digest_files(both.filter("status = 'done'").select(F.concat(F.lit(where + "/"), "target").alias("path")))
    counts = both.groupBy("key").agg(F.count_if(F.col("status") == "done").alias("n_done"), F.count(F.lit(1)).alias("n_tried"))
    return counts.join(copied.select(below("path", where + "/copies").alias("key"), "md5"), "key")


@query("u01_partition_function", sql="""SELECT p_partkey, ((len(b)+list_sum(list_transform(b, lambda x, i: (len(b)-i+1)*x)))%65521*65536+(1+list_sum(b))%65521)::BIGINT AS checksum
    FROM (SELECT p_partkey, list_transform(string_split(p_name,''), lambda c: ascii(c)::BIGINT) AS b FROM part)""")
def u01(t):
    """A frame-to-frame function over batches of a partition, for work that has no built-in: the rolling checksum (Adler-32) that syncing tools compare blocks by."""

    def adler(batches):
        for batch in batches:
            yield batch[["p_partkey"]].assign(checksum=[zlib.adler32(name.encode()) for name in batch["p_name"]])

    return t.table("part").select("p_partkey", "p_name").mapInPandas(adler, "p_partkey long, checksum long")


@query("u02_row_function", sql="SELECT p_partkey, damerau_levenshtein(lower(p_name),lower(p_type)) AS edits FROM part")
def u02(t):
    """A function applied to rows: edits between two strings, swaps included."""

    @F.udf("long", useArrow=True)
    def edits(a, b):
        # cost[i][j]: edits between the first i and the first j characters; last: where a character was seen before.
        most, last = len(a) + len(b), {}
        cost = [[most] * (len(b) + 2) for _ in range(len(a) + 2)]
        for i in range(len(a) + 1):
            cost[i + 1][1] = i
        for j in range(len(b) + 1):
            cost[1][j + 1] = j
        for i in range(1, len(a) + 1):
            swap = 0
            for j in range(1, len(b) + 1):
                k, m, same = last.get(b[j - 1], 0), swap, a[i - 1] == b[j - 1]
                swap = j if same else swap
                cost[i + 1][j + 1] = min(
                    cost[i][j] + (not same), cost[i + 1][j] + 1, cost[i][j + 1] + 1, cost[k][m] + (i - k - 1) + 1 + (j - m - 1)
                )
            last[a[i - 1]] = i
        return cost[-1][-1]

    return t.table("part").select("p_partkey", edits(F.lower("p_name"), F.lower("p_type")).alias("edits"))


PARTS = ("f AS (SELECT ord, size FROM files)", fold("f", 40_000, 30, 200, "ord, size"))


@query("u03_grouped_function", ctes=PARTS, sql="SELECT part, batch, count(*) AS n, sum(size)::BIGINT AS bytes FROM fold GROUP BY part, batch")
def u03(t):
    """A function applied to groups: next-fit over the files of a part, which is sequential. A part holds 200 files."""

    def fit(group):
        group = group.sort_values("ord")
        batch = batching._next_fit(group["size"].to_numpy(), 40_000, 30)
        return group.assign(batch=batch).groupby(["part", "batch"], as_index=False).agg(n=("size", "count"), bytes=("size", "sum"))

    parts = t.files.select("ord", "size", F.call_function("div", F.col("ord"), F.lit(200)).alias("part"))
    return parts.groupBy("part").applyInPandas(fit, "part long, batch long, n long, bytes long")


@query("u04_custom_aggregate", ctes=PARTS, sql="SELECT part, max(batch)+1 AS n_archives FROM fold GROUP BY part")
def u04(t):
    """An aggregate of one's own: how many archives next-fit needs for a part."""
    import pandas as pd

    @F.pandas_udf("long")
    def archives(ord: pd.Series, size: pd.Series) -> int:
        return int(batching._next_fit(size[ord.sort_values().index].to_numpy(), 40_000, 30)[-1]) + 1

    parts = t.files.select("ord", "size", F.call_function("div", F.col("ord"), F.lit(200)).alias("part"))
    return parts.groupBy("part").agg(archives("ord", "size").alias("n_archives"))


@query("c03_digest_of_files", sql="SELECT source||'/'||lang||'/'||doc_id||'.txt' AS path, octet_length(encode(text))::BIGINT AS listed, octet_length(encode(text))::BIGINT AS size, md5(text) AS md5 FROM documents")
def c03_files(t):
    """Files written from the documents, listed, and read again block by block."""
    where = document_files(t)
    found = listing.walk_tree(t.spark, where).filter("not is_dir").select("path", F.col("size").alias("listed"))
    return archive.digest_files(found).join(found, "path").select(below("path", where).alias("path"), "listed", "size", "md5")
