"""Path and object-key expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def base_name(path) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def parent_dir(path) -> Column:
    """Everything before the last slash; empty for a key at the root."""
    return F.regexp_replace(path, "/?[^/]*$", "")


def depth(path) -> Column:
    """Number of slash-separated parts (a leading slash counts as an empty part)."""
    return F.size(F.split(path, "/")).cast("long")


def first_component(path) -> Column:
    return F.element_at(F.split(path, "/"), 1)


def ancestors(folder) -> Column:
    """Array of the folder itself and every folder above it, shortest first."""
    parts = F.split(F.regexp_replace(folder, "^/", ""), "/")
    lead = F.when(F.startswith(folder, F.lit("/")), F.lit("/")).otherwise(F.lit(""))
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda n: F.concat(lead, F.array_join(F.slice(parts, F.lit(1), n), "/")),
    )


def strip_prefix(path, folder) -> Column:
    """Path relative to ``folder`` when it lies below it, else unchanged."""
    below = F.startswith(path, F.concat(folder, F.lit("/")))
    return F.when(below, F.substring(path, F.length(folder) + 2, F.length(path))).otherwise(path)


def object_name(path, root: str, dest: str) -> Column:
    """Destination key of a file below ``root``."""
    relative = F.substring(path, F.lit(len(root) + 2), F.length(path))
    return F.concat(F.lit(dest + "/"), relative) if dest else relative


def join_key(folder, name) -> Column:
    """``folder/name`` without a leading slash when the folder is empty."""
    return F.when(folder == "", name).otherwise(F.concat(folder, F.lit("/"), name))


def archive_key(batch_id, dest: str) -> Column:
    name = F.concat(F.lit("collated_"), batch_id.cast("string"), F.lit(".zip"))
    return F.concat(F.lit(dest + "/"), name) if dest else name


def base_up_to(path, component_pattern: str) -> Column:
    """Leading part of ``path`` up to the first component matching the pattern; null when none does."""
    hit = F.regexp_extract(path, f"^((?:[^/]*/)*?{component_pattern})(?:/|$)", 1)
    return F.when(hit != "", hit)


def rebase(path, from_pattern: str, to_base) -> Column:
    """Swap the base of ``path`` (up to a component matching ``from_pattern``) for ``to_base``, once."""
    base = base_up_to(path, from_pattern)
    swapped = F.concat(to_base, F.substring(path, F.length(base) + 1, F.length(path)))
    return F.coalesce(F.when(base.isNotNull() & to_base.isNotNull(), swapped), path)


def line_path(line, prefix: str = "") -> Column:
    """Last token of a line whose stripped text starts ``path:``; null for other lines."""
    token = F.regexp_extract(line, r"(\S+)\s*$", 1)
    return F.when(F.rlike(line, F.lit(r"^\s*path:")), F.concat(F.lit(prefix), token))
