"""From raw documents to packed sequences: toxic documents go, then those of no certain language, then all but one of
each group of near copies; what is left is packed.

Every stage is written as Parquet in the shared folder and read back as the next one's input. All but the last
return the columns of their input. Rows with null or empty text are not toxic by words, but have no language, so the
second stage drops them; an empty table gives an empty result of the packing's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketry.llm import toxic_crf, var_packing, vertical_jaccard, zstd_language
from docketry.llm.common import stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger, trained on the labelled ones among them, does not predict toxic."""
    return toxic_crf.keep_clean(docs, table(spark, sf_dir, "labels"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells with a sufficient margin."""
    return zstd_language.keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of linked shingle sets: the one with the smallest id."""
    return vertical_jaccard.keep_first(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences."""
    return var_packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

#: Trained stages have no SQL; tests/llm holds every stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
