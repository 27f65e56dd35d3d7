"""One query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shredloom.llm import (
    bpe, embedding_dedup, html_text, license_scan, line_dedup, mixing, ngram_join, packing, prefix_trie,
    quality, sharding, token_counts, whitening)
from shredloom.llm.common import pieces, table
from shredloom.llm.vocabulary import read_ranks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizers():
    """The installed package of public vocabulary files."""
    import public_tokenizers

    return public_tokenizers


@query
def op1_line_dedup(spark, sf):
    """Documents without the lines that too many pages of their source share."""
    docs = table(spark, sf, "documents")
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "source", "n_lines", "n_dropped",
        F.length("text").cast("long").alias("n_chars_kept"), F.md5("text").alias("text_md5"))


@query
def op2_embedding_dedup(spark, sf):
    """Links, components and survivors of near-duplicate vectors."""
    vectors = table(spark, sf, "embeddings")
    return embedding_dedup.near_vectors(vectors)


@query
def op3_token_counts(spark, sf):
    """Unigram tokens of each document: a public vocabulary's pieces, scored by all documents."""
    tokens = tokenizers()
    docs = table(spark, sf, "documents").select("doc_id", "text")
    scores = token_counts.estimated_scores(
        docs, token_counts.zipf_scores(read_ranks(tokens.path("byte_bpe_50k.tiktoken"))),
        tokens.PATTERN)
    return token_counts.count_tokens(docs, scores, tokens.PATTERN)


@query
def op4_ngram_join(spark, sf):
    """Components of documents whose sets of 4-word shingles are at least 85 % alike."""
    return ngram_join.similar_documents(table(spark, sf, "documents"))


@query
def op5_sharding(spark, sf):
    """All documents in eight shards of equal counts, equal texts together."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    same_text = F.array(F.when(F.col("text").isNotNull(), F.xxhash64("text")))
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    return sharding.shard_documents(docs, same_text, size)


@query
def op6_license_scan(spark, sf):
    """License notices in documents."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return license_scan.scan_licenses(docs)


@query
def op7_html_text(spark, sf):
    """Main text of every page."""
    return html_text.extract_main_text(table(spark, sf, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_mixing(spark, sf):
    """Words that a mix of all sources takes from each document."""
    docs = table(spark, sf, "documents").select("doc_id", "source", "text")
    size = F.size(F.array_remove(pieces(F.col("text")), ""))
    return mixing.mix(docs, size).select("doc_id", "size", "source_size", "target", "taken")


@query
def op9_byte_bpe(spark, sf):
    """Digests of the token ids of each document and of what they decode to."""
    tokens = tokenizers()
    ranks = read_ranks(tokens.path("byte_bpe_50k.tiktoken"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, tokens.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(bpe.decode(F.col("ids"), ranks, spark), 256).alias("decoded_sha256"))


@query
def op10_quality_rules(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return quality.quality_rules(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept")


@query
def op11_prefix_trie(spark, sf):
    """Nodes of the trie of all conversations, which share first turns in groups of twenty."""
    turns, turnless = prefix_trie.with_shared_heads(
        prefix_trie.numbered_turns(table(spark, sf, "conversations")), every=20, heads=4)
    return prefix_trie.prefix_trie(turns, turnless)


@query
def op12_whitening(spark, sf):
    """All valid vectors on the 32 leading components, each with variance one."""
    return whitening.whiten(table(spark, sf, "embeddings"))


@query
def op13_packing(spark, sf):
    """All documents in windows of 512 to 4,096 tokens, and the training step of each."""
    with open(tokenizers().path("word_bpe_49k.json"), encoding="utf-8") as file:
        vocabulary = file.read()
    pieces = packing.pack_pieces(table(spark, sf, "documents"), vocabulary)
    rest = [c for c in pieces.columns if c != "ids"]
    return packing.number_sequences(
        pieces.select(*rest, F.crc32("ids").alias("ids_crc32")))
