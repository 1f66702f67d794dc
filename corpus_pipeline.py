"""Corpus pipeline: quality rules, SimHash near-dedup, substring dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet into the shared folder and read again as the next stage's ``docs``.
All but the last return the columns of ``docs``. Every stage works on all rows
that its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from outlay.llm import best_fit_packing, curriculum_mix, quality_rules, simhash_pivot, substring_dedup
from outlay.llm.common import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return quality_rules.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_pivot.keep_one(docs)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a smaller doc_id has."""
    return substring_dedup.remove_repeats(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per reading of the mix, in training order; every reading is of a whole document."""
    return curriculum_mix.materialize(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their bin and offset."""
    return best_fit_packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_dedup),
    ("substring_dedup", substring),
    ("mixing", mixing),
    ("best_fit_packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the packed pieces."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs


#: Fingerprints, the hash-dealt packing groups and best fit have no SQL form;
#: the tests hold ``run`` against a brute-force version.
ORACLE_SQL = None
