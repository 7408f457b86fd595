"""Documents to tokens: quality, line dedup, near-duplicates, benchmark leaks, encoding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import decontamination, line_dedup, quality_classifier, sentencepiece, simhash
from clickloom.llm.common import shared_folder
from clickloom.llm.queries import PIECES, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return quality_classifier.drop_rejected(docs, table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each without the lines that another place keeps."""
    return line_dedup.drop_duplicate_lines(docs)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs, width=4, distance=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and whether they decode to its text."""
    return sentencepiece.round_trip(docs, PIECES)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", one_of_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("sentencepiece", encode),
]

#: Classifier, MinHash banding and Viterbi have no SQL form; a brute-force version tests ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "corpus")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
