"""From raw documents to token ids: the operators of ``invspark.llm`` as one pipeline.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns what it keeps, which is
written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from invspark.llm import mixing, pii, quality, similar
from invspark.llm.common import materialise, read
from invspark.llm.queries import MIX, MIX_KEY, MIX_RATE, PII_KEY, encoded


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current quality policy."""
    return quality.keep(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: five-word shingles, SimHash similarity of 0.8 or more."""
    return similar.keep_one(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data; ``n_chars`` follows the new text."""
    changed = pii.pseudonymise(docs, PII_KEY, places="_surrogates")
    return changed.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn with the chances that bring sources, languages and topics to their target weights."""
    return mixing.sample(docs, MIX, MIX_RATE, MIX_KEY)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text."""
    return encoded(spark, docs).select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", dedup_stage),
    ("pii_surrogates", pii_stage),
    ("mixing", mixing_stage),
    ("byte_level_bpe", bpe_stage),
]

#: Keyed surrogates, hashes and merges are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place + 1 < len(STAGES):
            docs = materialise(docs, f"pipeline-{name}")
    return docs
