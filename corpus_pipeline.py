"""From raw documents to token counts: five stages, each a whole-table job
whose result is written as Parquet and read again by the next one.

All stages but the last return the columns of the documents, whatever their
names: columns that the operators add for themselves get names that are free.
An empty table stays empty through all stages. What NULLs, empty and very long
texts, repeated rows and ties lead to stands at each stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vehicle_metrics.llm import bpe, decontamination, language_id, quality_rules, simhash_golay
from vehicle_metrics.llm.queries import vocabulary_path
from vehicle_metrics.storage import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the certified cutoffs keep.

    NULL and empty texts have no words and go. Repeated rows are judged alike,
    each for itself; a NULL id matches no label but may stay. Without good
    labels only the base rules reject.
    """
    return quality_rules.keep_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    Texts without a letter go, and so does everything if no row with a
    language may be learned from. Rows with a NULL id or language are judged
    but not learned from; repeated rows count each.
    """
    return language_id.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the smallest id.

    NULL ids come last; of rows with the same id one stays, and rows of a
    component that all have a NULL id leave one row.
    """
    return simhash_golay.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    NULL and empty items match nothing, repeated items as one; a document
    without text contains none and stays.
    """
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left, one row for
    each; a NULL text has no tokens and the digests of an empty one."""
    return bpe.round_trip_digests(docs, vocabulary_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("bpe", tokenise),
]

#: n-gram profiles, connected components, edit matching and BPE are not SQL; tests hold the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
