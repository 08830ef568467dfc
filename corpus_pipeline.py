"""The corpus pipeline: quality rules, toxicity, near duplicates, packing.

Every stage is a function of ``(spark, docs, sf_dir)``. All but the last return the columns
of ``documents``; :func:`run` writes each stage's rows below the shared folder and reads
them again as the next one's documents. No stage can be expressed by SQL alone, since the
second one is a fitted model.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from topicloom.llm import near_duplicates, packing, quality_rules, toxicity
from topicloom.llm.common import stored, table
from topicloom.llm.queries import BYTE_BPE

ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_duplicates.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed_pieces(docs, BYTE_BPE)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicate_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
