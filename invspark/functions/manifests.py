"""Archive manifest expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from . import paths


def parse(text) -> Column:
    """Member names: split on a pipe when there is one, else ``;``, else ``,``; empties dropped, null stays null."""
    parts = (
        F.when(F.contains(text, F.lit("|")), F.split(text, "[|]"))
        .when(F.contains(text, F.lit(";")), F.split(text, ";"))
        .otherwise(F.split(text, ","))
    )
    return F.filter(parts, lambda name: name != "")


def qualify(members, zip_key) -> Column:
    """Member names as full keys: the archive's folder in front, no slash for an archive at the root."""
    folder = paths.parent_dir(zip_key)
    return F.transform(members, lambda name: paths.join_key(folder, name))


def abbreviate(members, limit: int = 5) -> Column:
    """The first names joined by pipes, marked when some were left out."""
    return F.when(
        F.size(members) > limit,
        F.concat(F.array_join(F.slice(members, 1, limit), "|"), F.lit(" abbreviated")),
    ).otherwise(F.array_join(members, "|"))
