"""From raw documents to encoded training text: quality, language, near-duplicates, benchmark passages, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationtide.llm import bpe, decontaminate, language, quality, simhash
from stationtide.llm.common import importable_on_workers, table, written
from stationtide.llm.suite import BYTE_TOKENIZER, PIECE_VOCABULARY


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the ones it is given, does not reject."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that their labels teach."""
    return language.keep_recognised(docs, language.train(docs, PIECE_VOCABULARY))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.keep_one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the text that they decode to."""
    return bpe.encode_documents(docs, BYTE_TOKENIZER).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("quality", good_text),
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("decontamination", no_benchmark),
    ("encoding", encoded),
]

#: The first two stages are trained models, so no SQL gives the rows; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its rows to the shared folder and the next one reads them there."""
    importable_on_workers(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
