"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its result is
written as Parquet and read again as the next one's docs. The first four return the columns of
documents, the last a row per piece of a packed sequence.

Nulls, empty texts, repeated rows and empty tables are treated as the operators state: null and
empty texts fail the first rule; documents without a doc_id are never duplicates of others; rows that share a
doc_id are judged each by its own text, and equal ones are copies. Columns that documents has besides
its own are carried along whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.classifier import score_documents, train
from tripflow.llm.minhash import without_near_duplicates
from tripflow.llm.packing import pack_documents
from tripflow.llm.quality import passing
from tripflow.llm.substring import without_passages
from tripflow.llm.work import kept_beyond, private_tables, ready, unused

#: Documents whose probability of good quality is below this go.
LEAST_QUALITY = 0.3


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the divergence rules keep."""
    return passing(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is high enough, by a model trained on the labelled ones."""
    model = train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))
    name = unused(docs, "quality_score")
    scored = score_documents(docs.withColumn("text", F.col("text").cast("string")), model, name=name, keep_text=True)
    return scored.where(F.col(name) >= LEAST_QUALITY).drop(name)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group at similarity 0.8 or more on five-word shingles."""
    return without_near_duplicates(docs, size=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 20 words or more that an earlier one has as well."""
    cut = without_passages(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else cut


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), added_tokens=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Training, hashing and tokenizing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over the whole table of documents."""
    ready(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        with private_tables(spark):  # a stage's own tables go once its result is written
            docs = kept_beyond(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
