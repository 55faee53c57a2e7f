"""A training corpus from raw documents: rules, classifier, near duplicates, benchmarks, pieces.

Each stage takes all that its predecessor kept. A stage's result is written as Parquet into the
shared folder and read again, so that a stage is done once and a lost executor repeats only its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from labweave.llm.common import table
from labweave.llm.decontam import remove_items
from labweave.llm.line_rules import quality_rules
from labweave.llm.near_dup import keep_one
from labweave.llm.pieces import encode_texts
from labweave.llm.quality_classifier import classify
from labweave.llm.queries import TOKENIZERS
from labweave.session import checkpoint


#: The columns that the stages read or change; all others are set aside under private names.
OWN = ("doc_id", "text", "source", "n_chars")


def aside(docs: DataFrame) -> DataFrame:
    """``docs`` with other columns named by place, so that none can clash with a stage's own."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in OWN else f"_document_{i}")
                         for i, c in enumerate(docs.columns)])


def back(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` under their own names."""
    return out.select(*[F.col(c if c in OWN else f"_document_{i}").alias(c)
                        for i, c in enumerate(docs.columns)])


def counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long"))


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that are frequent on their host."""
    own = aside(docs)
    return back(counted(quality_rules(own, keep=own.columns, trim=True).filter("kept")), docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones."""
    own, labels = aside(docs), table(spark, sf_dir, "labels")
    return back(classify(own, labels, keep=own.columns).filter("predicted = 1"), docs)


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return back(keep_one(aside(docs)), docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages; one that was nothing else is gone."""
    marked = aside(docs).withColumn("was", F.xxhash64("text"))
    clean = counted(remove_items(marked, table(spark, sf_dir, "benchmark")))
    return back(clean.filter(
        (F.xxhash64("text") == F.col("was"))
        | F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")), docs)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document."""
    return encode_texts(docs, TOKENIZERS + "/piece_bpe_32k.model")


STAGES = [
    ("quality rules", quality_rules_stage),
    ("quality classifier", quality_classifier_stage),
    ("n-gram Jaccard join", near_duplicates_stage),
    ("benchmark decontamination", decontamination_stage),
    ("SentencePiece encoding", pieces_stage),
]

#: SQL has neither a fitted classifier nor the tokenizer's segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = checkpoint(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
