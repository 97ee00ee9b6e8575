"""The operators as named queries over the whole of their tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stintlab.llm import (
    decontaminate, jaccard_join, langid, mixing, periodic_runs, pii, prefix_trie, quality, sentence_pieces,
    substring_dedup, token_counts, token_output, topk,
)
from stintlab.llm.common import crc_fold, read

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_token_output(spark: SparkSession, d: str) -> DataFrame:
    return token_output.token_digest(read(spark, d, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op6_token_counts(spark: SparkSession, d: str) -> DataFrame:
    return token_counts.token_counts(read(spark, d, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op7_mix_sources(spark: SparkSession, d: str) -> DataFrame:
    mixed = mixing.mix(read(spark, d, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size",
        (F.floor(F.col("target") * 1e6 + 0.5) / 1e6).alias("target"), "taken",
    )


ORACLES["op7_mix_sources"] = mixing.SQL


@query
def op8_exact_top_k(spark: SparkSession, d: str) -> DataFrame:
    return topk.exact_top_k(read(spark, d, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLES["op8_exact_top_k"] = topk.SQL


@query
def op10_language_id(spark: SparkSession, d: str) -> DataFrame:
    """A row without an id is in no fold: it is not learned from and not held out."""
    docs = read(spark, d, "documents")
    fold = crc_fold(F.col("doc_id"), 4)
    model = langid.train_languages(docs, fold != 2)
    held = docs.select("doc_id", "text")
    return langid.predict_languages(held, model).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "n_spans"
    )


@query
def op5_quality(spark: SparkSession, d: str) -> DataFrame:
    """A row without an id is in no fold: it is not learned from and not held out."""
    fold = crc_fold(F.col("doc_id"), 5)
    docs, labels = read(spark, d, "documents").select("doc_id", "text"), read(spark, d, "labels")
    model = quality.train_quality(docs.filter(fold != 0), labels.filter(fold != 0))
    return quality.score_quality(docs, model).select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op9_decontaminate(spark: SparkSession, d: str) -> DataFrame:
    indexes = decontaminate.leak_indexes(read(spark, d, "benchmark"))
    return decontaminate.find_leaks(read(spark, d, "documents"), indexes)


@query
def op2_substring_dedup(spark: SparkSession, d: str) -> DataFrame:
    return substring_dedup.remove_repeated(read(spark, d, "documents"))


@query
def op1_pii(spark: SparkSession, d: str) -> DataFrame:
    return pii.digest(pii.find_personal_data(read(spark, d, "documents")))


@query
def op4_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard_join.similarity_classes(read(spark, d, "documents")).drop("n_links")


@query
def op11_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    turns = prefix_trie.slim_turns(read(spark, d, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.share_heads(turns))


ORACLES["op11_prefix_trie"] = prefix_trie.SQL


@query
def op12_sentence_pieces(spark: SparkSession, d: str) -> DataFrame:
    return sentence_pieces.piece_digest(read(spark, d, "documents"), tokenizer("piece_bpe_32k.model"))


@query
def op13_periodic_runs(spark: SparkSession, d: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.find_runs(periodic_runs.loop_tails(read(spark, d, "documents"))))
