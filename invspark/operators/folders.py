"""Folder-level roll-ups of a listing (folder, name or path, size)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import paths, units
from . import ordered

# Limits of the collation advice.
FEW_FILES = 2
SMALL_MEAN_MIB = 64


def directories(files: DataFrame, folder: str = "folder") -> DataFrame:
    """Every folder that holds a file, and every folder above one."""
    return files.select(folder).distinct().select(F.explode(paths.ancestors(F.col(folder))).alias(folder)).distinct()


def per_folder(files: DataFrame, dirs: DataFrame | None = None, folder: str = "folder") -> DataFrame:
    """File count and bytes directly in each folder; folders without files count 0."""
    held = files.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))
    every = directories(files, folder) if dirs is None else dirs.select(folder).unionByName(directories(files, folder)).distinct()
    zero = F.lit(0).cast("long")
    return every.join(held, folder, "left").select(
        folder, F.coalesce("n_files", zero).alias("n_files"), F.coalesce("bytes", zero).alias("bytes")
    )


def collation_advice(folder_stats: DataFrame) -> DataFrame:
    """One row: how the tree is shaped and whether packing small files pays."""
    small = (F.col("n_files") > 0) & (units.mib(F.col("bytes")) / F.col("n_files") <= SMALL_MEAN_MIB)
    base = folder_stats.agg(
        F.count(F.lit(1)).alias("n_folders"),
        F.coalesce(F.sum("n_files"), F.lit(0)).alias("n_files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.count_if(small).alias("n_small_mean"),
        F.count_if(F.col("n_files") <= FEW_FILES).alias("n_le_2"),
        F.count_if(small & (F.col("n_files") <= FEW_FILES)).alias("n_collatable"),
    )
    share = lambda name: F.coalesce(F.when(F.col("n_folders") > 0, F.col(name) * 100.0 / F.col("n_folders")), F.lit(0.0))
    small_share, collatable_share = share("n_small_mean"), share("n_collatable")
    advice = (
        F.when((small_share > 10) & (collatable_share > 10), "advised: many small files and collatable folders")
        .when(small_share > 5, "advised: many small files, few collatable folders")
        .when(collatable_share > 5, "advised: many collatable folders")
        .otherwise("not advised")
    )
    return base.select(
        "*",
        units.ratio(units.mib(F.col("bytes")), F.col("n_files"), 0.0).alias("mean_mib"),
        units.ratio(F.col("n_files"), F.col("n_folders"), 0.0).alias("files_per_folder"),
        small_share.alias("pct_small_mean"),
        share("n_le_2").alias("pct_le_2"),
        collatable_share.alias("pct_collatable"),
        advice.alias("advice"),
    )


def sizes_to_depth(files: DataFrame, max_depth: int, folder: str = "folder") -> DataFrame:
    """Total bytes and files below every folder down to ``max_depth`` components.

    Folders are summed before they are spread over their ancestors.
    """
    held = files.groupBy(folder).agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n_files"))
    spread = held.withColumn("above", F.explode(F.slice(paths.ancestors(F.col(folder)), 1, max_depth)))
    return spread.groupBy(F.col("above").alias(folder)).agg(
        F.sum("bytes").alias("bytes"), F.sum("n_files").alias("n_files")
    ).withColumn("gib", units.gib(F.col("bytes")))


def intervals(listing: DataFrame, path: str = "path", size: str = "size") -> DataFrame:
    """(folder, depth, first, last, n_files, bytes) of every folder with a file somewhere below it, at any depth.

    ``listing`` bears ``ord`` in path order (``listing.in_path_order``), so the files below a folder are the interval ``first`` to
    ``last``, and their bytes the difference of two running sums. A folder opens at the file whose predecessor does not lie below it and
    closes at the one whose successor does not: each folder gives two rows, however many files and levels are below it.
    """
    rows = listing.select("ord", paths.parent_dir(F.col(path)).alias("folder"), F.coalesce(size, F.lit(0).cast("long")).alias("size"))
    folder = F.col("folder")
    run = ordered.scan(rows, [], "ord", sums={"before": F.col("size")}, previous={"left": folder}, following={"right": folder}, shifts=(20, 23))

    def beyond(neighbour: str) -> Column:
        """The folders above a file, its own included, that the neighbouring file is not below."""
        mine, other = F.split("folder", "/"), F.split(F.col(neighbour), "/")
        both = F.least(F.size(mine), F.size(other))
        differs = F.array_position(F.zip_with(F.slice(mine, F.lit(1), both), F.slice(other, F.lit(1), both), lambda a, b: a == b), False).cast("int")
        shared = F.when(F.col(neighbour).isNull(), 0).when(differs > 0, differs - 1).otherwise(both)
        # A leading slash makes an empty first component, which is no folder.
        lead = F.when(F.startswith(folder, F.lit("/")), 1).otherwise(0)
        start = F.greatest(shared, lead) + 1
        return F.when((folder != "") & (start <= F.size(mine)), F.transform(F.sequence(start, F.size(mine)), lambda k: F.struct(F.array_join(F.slice(mine, F.lit(1), k), "/").alias("folder"), (k - lead).cast("long").alias("depth"))))

    none = F.lit(None).cast("long")
    opened = run.select(F.inline(beyond("left")), F.col("ord").alias("first"), none.alias("last"), F.col("before").alias("from"), none.alias("to"))
    closed = run.select(F.inline(beyond("right")), none.alias("first"), F.col("ord").alias("last"), none.alias("from"), (F.col("before") + F.col("size")).alias("to"))
    held = opened.unionByName(closed).groupBy("folder", "depth").agg(*[F.max(name).alias(name) for name in ("first", "last", "from", "to")])
    return held.select("folder", "depth", "first", "last", (F.col("last") - F.col("first") + 1).alias("n_files"), (F.col("to") - F.col("from")).alias("bytes"))


def outside(listing: DataFrame, subtrees: DataFrame) -> DataFrame:
    """The files of ``listing`` (with ``ord``) that lie in none of the intervals (first, last) of ``subtrees``, which may nest.

    Ends of intervals and files are put in one order; a running count tells how many intervals are open at a file.
    """
    one = F.lit(1).cast("long")
    ends = subtrees.select(F.inline(F.array(F.struct(F.col("first").alias("ord"), one.alias("_by")), F.struct((F.col("last") + 1).alias("ord"), (-one).alias("_by")))))
    # Ends at a place come before its file.
    marks = ends.groupBy("ord").agg(F.sum("_by").alias("_by")).withColumns({"_at": F.col("ord") * 2, "_file": F.lit(False)})
    files = listing.withColumns({"_by": F.lit(0).cast("long"), "_at": F.col("ord") * 2 + 1, "_file": F.lit(True)})
    run = ordered.scan(files.unionByName(marks, allowMissingColumns=True), [], "_at", sums={"_open": F.col("_by")}, shifts=(21, 23))
    return run.filter("_file and _open = 0").select(*listing.columns)


def routing(files: DataFrame, mean_limit: int = 128 * units.MIB, few: int = 4, tiny: int = 96 * units.MIB, folder: str = "folder") -> DataFrame:
    """Per folder: upload files one by one, collate under the parent, or leave a tiny leaf as it is."""
    stats = per_folder(files, folder=folder)
    parents = stats.select(paths.parent_dir(F.col(folder)).alias(folder)).distinct().withColumn("_has_sub", F.lit(True))
    mean = F.when(F.col("n_files") > 0, F.col("bytes") / F.col("n_files")).otherwise(0.0)
    leaf = F.col("_has_sub").isNull()
    route = (
        F.when(F.col("n_files") == 0, "empty")
        .when(mean > mean_limit, "individual")
        .when(leaf & (F.col("n_files") < few) & (F.col("bytes") < tiny), "as is")
        .otherwise("collate")
    )
    return stats.join(parents, folder, "left").select(
        folder, paths.parent_dir(F.col(folder)).alias("parent"), "n_files", "bytes", leaf.alias("is_leaf"), route.alias("route")
    )


def archive_counts(files: DataFrame, max_archive: int, folder: str = "folder") -> DataFrame:
    """Archives needed per parent folder when each may hold ``ceil(max_archive / largest file)`` files."""
    held = files.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.max("size").alias("largest"))
    per_parent = held.groupBy(paths.parent_dir(F.col(folder)).alias("parent")).agg(
        F.sum("n_files").alias("n_files"), F.max("largest").alias("largest")
    )
    each = F.ceil(F.lit(max_archive) / F.col("largest"))
    return per_parent.filter("largest > 0").select("parent", "n_files", "largest", F.ceil(F.col("n_files") / each).alias("n_archives"))


def deep_only(df: DataFrame, folder: str = "folder", skip: int = 2) -> DataFrame:
    """Rows whose folder is not among the ``skip`` shallowest levels."""
    level = paths.depth(F.col(folder))
    shallowest = df.agg(F.min(level)).scalar()
    return df.filter(level > shallowest + (skip - 1))


def file_lists(df: DataFrame, folder: str = "folder", name: str = "name", order: str = "ord", per_list: int = 10_000) -> DataFrame:
    """Comma-joined file names per folder, in lists of bounded length.

    Files are numbered within their folder and every ``per_list`` of them make a
    list, so only a folder with more files becomes several rows.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(name).alias("n"))))
    cut = ordered.chunks(df.select(folder, order, name), [folder], order, per_list, "list_no", narrow=True)
    return cut.groupBy(folder, "list_no").agg(
        F.array_join(F.transform(listed, lambda x: x["n"]), ",").alias("names"), F.count(F.lit(1)).alias("n")
    )


def top_level_jobs(files: DataFrame, path: str = "relative") -> DataFrame:
    """One job per top-level subfolder with its bytes and files; loose files form a job of their own."""
    nested = F.contains(F.col(path), F.lit("/"))
    return (
        files.groupBy(F.when(nested, paths.first_component(F.col(path))).otherwise("").alias("subfolder"))
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").alias("bytes"))
        .withColumn("loose_files", F.col("subfolder") == "")
    )
