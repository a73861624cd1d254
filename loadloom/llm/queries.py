"""The registered queries of the text operators, one per operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, fill_middle, langid, license_scan, line_dedup, packing, prefix_trie, quality_knn, quality_rules, simhash, substring_dedup, url_filter
from .common import read, shown_id, stored
from .queries_sql import ORACLES  # noqa: F401

BPE_FILE = "byte_bpe_multi_50k.tiktoken"


def tokenizer(spark: SparkSession) -> bpe.Tokenizer:
    return bpe.Tokenizer(spark, public_tokenizers.path(BPE_FILE), public_tokenizers.PATTERN)


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.result(simhash.near_duplicates(read(spark, sf_dir, "documents")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of every document."""
    docs = read(spark, sf_dir, "documents")
    found = stored(license_scan.hits(docs), "licence-hits")
    return license_scan.scan(docs, license_scan.fit(docs, found=found), found=found)


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded bytes of every document."""
    return bpe.digests(read(spark, sf_dir, "documents"), tokenizer(spark))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = read(spark, sf_dir, "documents")
    found = langid.predict(docs, langid.fit(docs))
    return found.select("doc_id", (~langid.learnable(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.judged(read(spark, sf_dir, "documents")).drop("failed")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in documents, with edits and place."""
    return decontam.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts and digest of the kept words of every document."""
    found = substring_dedup.dedup_substrings(read(spark, sf_dir, "documents"))
    return found.select(shown_id().alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: The rules that the query judges by: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judged(read(spark, sf_dir, "pages"), rules).drop("url")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and digest of the kept text of every document."""
    found = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return found.select(shown_id().alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = read(spark, sf_dir, "documents")
    scores = quality_knn.score(docs, quality_knn.fit(docs, read(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id", (~quality_knn.learnable(F.col("doc_id"))).alias("held_out"), "score",
        (F.col("score") >= quality_knn.ACCEPT).cast("int").alias("predicted"),
    )


#: The vocabulary of the packed sequences, a file of the tokenizers library.
PACKED_FILE = "byte_bpe_50k.json"


def packed_vocabulary() -> packing.Vocabulary:
    return packing.Vocabulary(packing.ranks_of(public_tokenizers.path(PACKED_FILE)), public_tokenizers.PATTERN)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens."""
    vocabulary = packed_vocabulary()
    return packing.digests(packing.pack(read(spark, sf_dir, "documents"), vocabulary), vocabulary.width)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, form and digests of the fill-in-the-middle output of every document."""
    return fill_middle.digests(read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations."""
    return prefix_trie.nodes(read(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup, op2_license_scan, op3_byte_bpe, op4_language_id, op5_quality_rules,
        op6_benchmark_decontamination, op7_substring_dedup, op8_url_filter, op9_line_dedup, op10_quality_classifier,
        op11_packing, op12_fill_middle, op13_prefix_trie,
    )
}
