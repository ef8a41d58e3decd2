"""The operators of this package over the benchmark tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.bytepairs import byte_digests
from strata.llm.classify import classify, train
from strata.llm.divergence import divergence
from strata.llm.html import extract_text
from strata.llm.leaks import find_leaks
from strata.llm.neardup import near_duplicates
from strata.llm.negatives import hard_negatives
from strata.llm.pieces import piece_digests
from strata.llm.substrings import remove_repeats
from strata.llm.tokenfiles import token_digests, write_token_files
from strata.llm.tokens import count_tokens
from strata.llm.topk import top_k
from strata.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Components of documents that share 85 % of their shingles of three words."""
    return near_duplicates(table(spark, sf, "documents"), shingle=3, percent=85)


def op2_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """How toxic every document is; labels of one fold in four are not learned."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return classify(docs, train(docs, labels, "toxic", folds=4, fold=2), folds=4, fold=2)


def op3_html_text(spark: SparkSession, sf: str) -> DataFrame:
    """The visible text of every page."""
    return extract_text(table(spark, sf, "pages"))


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document, and whether they pass 2,048."""
    return count_tokens(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Every document in pieces: how many, their checksum, and whether decoding gives the text again."""
    return piece_digests(table(spark, sf, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_quality(spark: SparkSession, sf: str) -> DataFrame:
    """How good every document is; labels of one fold in five are not learned."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return classify(docs, train(docs, labels, "quality", folds=5, fold=0), folds=5, fold=0)


def op7_leaks(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of the benchmark in documents, up to 15 % of their words edited."""
    return find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op8_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The five highest inner products of every fiftieth vector with all others."""
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's ids through the binary files: where they start, how many, their checksum."""
    path = scratch_dir(spark, "token-files")
    write_token_files(table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_digests(spark, path)


def op10_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without the runs of 20 words or more that start earlier in the corpus."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    """For every hundredth vector and its five nearest of its label, ten near rows of other labels."""
    vectors = table(spark, sf, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


def op12_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """Distances between the sources of each language, and the terms that mark each source."""
    return divergence(table(spark, sf, "documents"))


def op13_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's ids under the byte-level ranks, and the bytes they decode to."""
    return byte_digests(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


QUERIES: dict[str, Query] = {
    "op1_near_duplicates": op1_near_duplicates,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_token_counts": op4_token_counts,
    "op5_pieces": op5_pieces,
    "op6_quality": op6_quality,
    "op7_leaks": op7_leaks,
    "op8_top_k": op8_top_k,
    "op9_token_files": op9_token_files,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_source_divergence": op12_source_divergence,
    "op13_byte_bpe": op13_byte_bpe,
}
