"""The corpus pipeline: stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskweft.llm import decontam, jaccard, language, lines, mixing
from riskweft.llm.common import table
from riskweft.session import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language."""
    return language.keep_known(docs)


def first_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier, equal or with one word changed; copies, which lose all lines, go."""
    return lines.drop_repeated(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest doc_id."""
    return jaccard.one_of_each(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture: shard, source, slot, block, doc_id, first, words, text."""
    return mixing.mixture(docs)


STAGES = [
    ("language_id", known_language),
    ("line_dedup", first_lines),
    ("ngram_jaccard", one_of_each_group),
    ("decontamination", no_benchmark),
    ("mixing", mix_sources),
]

#: No SQL says a trained model's decisions; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
