"""Classification of keys and run names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# The key patterns that mark archives and their manifests.
ZIP_PATTERN = r"^.*collated_[0-9]+\.zip$"
MANIFEST_PATTERN = r"^.*collated_[0-9]+\.zip\.metadata$"
LOOSE_ZIP_PATTERN = r"(?i)collated_.*\.zip$"
LOOSE_MANIFEST_PATTERN = r"(?i)collated_.*\.zip\.metadata"

# Suffixes of the log tables kept at the root of a bucket; pass your own where they differ.
LOG_SUFFIX = "backup.csv"
PREVIOUS_LOG_SUFFIX = "files.csv"
VERIFICATION_SUFFIX = "backup-verification.csv"

# Data-set labels by the tokens of a run title, first match wins.
DATASET_LABELS = [
    (("merged", "vhs"), "VHS-merged"),
    (("merged", "video"), "VIDEO-merged"),
    (("merged",), "Unknown"),
    (("vhs",), "CSV-VHS"),
    (("dummy-data", "1perc"), "Dummy Data 1% Small Files"),
    (("dummy-data", "10perc"), "Dummy Data 10% Small Files"),
    (("dummy-data", "100perc"), "Dummy Data 100% Small Files"),
    (("dummy-data", "25perc"), "Dummy Data 25% Small Files"),
    (("dummy-data", "50perc"), "Dummy Data 50% Small Files"),
]


def is_zip(key) -> Column:
    return F.rlike(key, F.lit(ZIP_PATTERN))


def is_manifest(key) -> Column:
    return F.rlike(key, F.lit(MANIFEST_PATTERN))


def is_loose_zip(key) -> Column:
    return F.rlike(key, F.lit(LOOSE_ZIP_PATTERN))


def is_loose_manifest(key) -> Column:
    return F.rlike(key, F.lit(LOOSE_MANIFEST_PATTERN))


def key_class(key) -> Column:
    return F.when(is_zip(key), "zip").when(is_manifest(key), "manifest").otherwise("other")


def log_class(key, log=LOG_SUFFIX, previous=PREVIOUS_LOG_SUFFIX, verification=VERIFICATION_SUFFIX) -> Column:
    return (
        F.when(F.endswith(key, F.lit(verification)), "verification")
        .when(F.endswith(key, F.lit(log)), "log")
        .when(F.endswith(key, F.lit(previous)), "previous log")
    )


def verification_twin(key, log=LOG_SUFFIX, previous=PREVIOUS_LOG_SUFFIX, verification=VERIFICATION_SUFFIX) -> Column:
    """Name of the verification table that belongs to a log."""
    quoted = "|".join(s.replace(".", "[.]") for s in (previous, log))
    return F.regexp_replace(key, f"-({quoted})$", f"-{verification}")


def token(text, delimiter: str, index: int) -> Column:
    """The index-th token counted from 1; negative counts from the end."""
    return F.split_part(text, F.lit(delimiter), F.lit(index))


def digits(text) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def relabel(text, labels: Mapping[str, str]) -> Column:
    """Replace known values, keep the others."""
    if not labels:
        return text
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), text), text)


def label_ladder(tokens, rules: Sequence[tuple[Sequence[str], str]] = DATASET_LABELS, other: str = "Unknown") -> Column:
    """Label of the first rule whose tokens are all present."""
    ladder = None
    for needed, label in rules:
        hit = None
        for word in needed:
            test = F.array_contains(tokens, word)
            hit = test if hit is None else hit & test
        ladder = F.when(hit, label) if ladder is None else ladder.when(hit, label)
    return ladder.otherwise(other)


def title_figures(title) -> dict[str, Column]:
    """What a run's title says of its set-up: MiB per file, connections, files per folder; null where it does not."""
    figure = lambda pattern: F.nullif(F.regexp_extract(title, pattern, 1), F.lit("")).cast("int")
    return {
        "file_mib": figure("([0-9]+)MiB-[0-9]+GiB"),
        "n_procs": figure("_([0-9]+)-procs"),
        "files_per_folder": figure("([0-9]+)fpf"),
    }


def transfer_type(path) -> Column:
    return F.when(F.endswith(path, F.lit(".zip")), "zip").otherwise("file")


def compression_used(kind, run) -> Column:
    """True for archives of a run whose name does not say otherwise."""
    return (kind == "zip") & ~F.contains(run, F.lit("NoComp"))


def site(run) -> Column:
    return token(run, "_", 2)


def workers(run) -> Column:
    return token(token(run, "_", -1), "-", 1).cast("int")


def threads(run) -> Column:
    return token(token(run, "_", -1), "-", 2).cast("int")
