"""Corpus pipeline: toxicity, exact dedup, SimHash near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunledger.llm import exact_dedup, mixing, packing, simhash, toxicity
from sunledger.llm.common import read_table, stored


def clean_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic; nulls and empty texts are scored like any other."""
    return toxicity.keep_clean(docs, read_table(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts equal without white space; null counts as empty."""
    return exact_dedup.deduplicate(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of SimHash fingerprints within three bits."""
    return simhash.deduplicate(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents: repeated, whole or in part; n_chars follows the text."""
    mixed = mixing.mixed_documents(docs)
    kind = docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None
    return mixed.withColumn("n_chars", F.char_length("text").cast(kind)) if kind else mixed


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with the checksum of their ids."""
    return packing.pack(docs, digest=True, added_tokens=True).drop("bucket")


STAGES = [
    ("toxicity", clean_stage),
    ("exact_dedup", exact_stage),
    ("simhash_near_dedup", near_stage),
    ("mixing", mix_stage),
    ("packing", pack_stage),
]

#: The scores and the token ids have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
