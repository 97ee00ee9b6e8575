"""From raw documents to token ids: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.llm import decontaminate, jaccard_join, langid, mixing, token_output
from stintlab.llm.common import crc_fold, read, stage
from stintlab.llm.queries import tokenizer


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mostly in one of the languages learned from their own labels; the others go."""
    model = langid.train_languages(docs, F.coalesce(crc_fold(F.col("doc_id"), 4), F.lit(0)) != 2)
    return langid.keep_identified(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group linked by n-gram Jaccard similarity."""
    return jaccard_join.keep_one_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_leaks(docs, decontaminate.leak_indexes(read(spark, sf_dir, "benchmark")))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's target takes it, none or twice included."""
    return mixing.repeat_taken(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as read back from the files written."""
    return token_output.token_digest(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("jaccard_join", drop_near_copies),
    ("decontaminate", drop_benchmark_leaks),
    ("mix_sources", mix_sources),
    ("token_output", write_tokens),
]

# Tokenizer and language model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
