"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from envstream.llm import (
    bpe, compression, packing, pages, quality, ranked, separators, shards, simhash, spans, tokenfiles,
    vectors, whitening,
)
from envstream.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Vocabulary files, read on the driver, and the id that ends a document in the token files.
LIBRARY_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
END_OF_DOCUMENT = 50256
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD_END = 2


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@registered
def op1_quality_rules(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@registered
def op2_separator_scan(spark, sf_dir):
    return separators.document_tokens(
        table(spark, sf_dir, "documents"), LIBRARY_VOCABULARY, END_OF_DOCUMENT)


@registered
def op3_adaptive_scan(spark, sf_dir):
    return vectors.search_all(table(spark, sf_dir, "embeddings"), every=20)


@registered
def op4_interleaved_shards(spark, sf_dir):
    return shards.assign(table(spark, sf_dir, "documents"))


@registered
def op5_simhash_trie(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents"), budget=2)


@registered
def op6_compression_classifier(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = compression.fit(docs, table(spark, sf_dir, "labels"))
    return compression.classify(docs, model)


@registered
def op7_block_factors(spark, sf_dir):
    return spans.digest(table(spark, sf_dir, "documents"), window=35)


@registered
def op8_matrix_bpe(spark, sf_dir):
    return bpe.encode_documents(
        table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


@registered
def op9_linear_grouping(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), LIBRARY_VOCABULARY)


@registered
def op10_host_paths(spark, sf_dir):
    return pages.extract(table(spark, sf_dir, "pages"))


@registered
def op11_ranked_bytes(spark, sf_dir):
    return tokenfiles.document_spans(table(spark, sf_dir, "documents"), WORD_VOCABULARY, WORD_END)


@registered
def op12_cholesky_jacobi(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@registered
def op13_hybrid_lists(spark, sf_dir):
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)
