"""Registered queries of this folder: each operator over its whole table, and SQL answers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labweave.llm import oracle
from labweave.llm.common import crc_rest, table
from labweave.llm.conversation_trie import conversation_trie
from labweave.llm.decontam import digest, find_items
from labweave.llm.line_rules import quality_rules
from labweave.llm.lm_score import lm_scores
from labweave.llm.near_dup import near_duplicates
from labweave.llm.page_text import extract_text
from labweave.llm.pieces import encode_texts
from labweave.llm.quality_classifier import classify
from labweave.llm.shards import shard_rows
from labweave.llm.simhash_cover import simhash_components
from labweave.llm.token_alignment import align_tokens
from labweave.llm.token_counts import PATTERN as BYTE_PATTERN, token_counts
from labweave.llm.url_rules import judge_urls

#: Folder of the public vocabularies.
TOKENIZERS = "/opt/tokenizers"
#: The url rules in force: host, path start, verdict.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op1_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(
        table(spark, sf_dir, "documents"), TOKENIZERS + "/byte_bpe_50k.tiktoken", rule="majority")


def op2_pu_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", (crc_rest(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


def op3_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_page_differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages")).drop("n_partner")


def op5_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm_scores(
        table(spark, sf_dir, "documents"), crc_rest(F.col("doc_id"), 10) != 0)
    return scored.select(
        "doc_id", (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score")


def op6_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_items(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op7_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links", "copies", "n_shingles")


def op8_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"), shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_shared_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), TOKENIZERS + "/piece_bpe_32k.model")


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_anchor_cover(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op12_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(
        table(spark, sf_dir, "documents"), TOKENIZERS + "/byte_bpe_50k.json",
        TOKENIZERS + "/piece_bpe_32k.model", pattern=BYTE_PATTERN)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations")).drop("x1", "x2")


QUERIES = {
    "op1_section_tokens": op1_section_tokens,
    "op2_pu_classifier": op2_pu_classifier,
    "op3_line_frequency": op3_line_frequency,
    "op4_page_differences": op4_page_differences,
    "op5_backoff_automaton": op5_backoff_automaton,
    "op6_fm_index": op6_fm_index,
    "op7_lsh_forest": op7_lsh_forest,
    "op8_ring_shards": op8_ring_shards,
    "op9_shared_prefix": op9_shared_prefix,
    "op10_url_rules": op10_url_rules,
    "op11_anchor_cover": op11_anchor_cover,
    "op12_shared_cuts": op12_shared_cuts,
    "op13_conversation_trie": op13_conversation_trie,
}

ORACLE = {
    "op3_line_frequency": oracle.LINE_RULES,
    "op6_fm_index": oracle.FM_INDEX,
    "op7_lsh_forest": oracle.LSH_FOREST,
    "op10_url_rules": oracle.url_rules(URL_RULES),
    "op13_conversation_trie": oracle.CONVERSATION_TRIE,
}
