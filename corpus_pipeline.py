"""The corpus pipeline: rules, classifier, near duplicates, decontamination, tokens.

Each stage reads all that the one before kept; ``run`` writes every stage's rows as Parquet to
the shared checkpoint folder and reads them again. All stages but the last return the columns
of documents.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from traveltiers.llm import bpe_transducer, host_rules, jaccard_join, template_leaks, weak_labels
from traveltiers.llm.common import table
from traveltiers.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: documents that the rules reject go."""
    return host_rules.keep_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the classifier rejects go."""
    return weak_labels.keep_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: one document of each group of near duplicates stays, the one with the smallest id."""
    return jaccard_join.keep_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold a benchmark item go."""
    return template_leaks.keep_documents(docs, table(spark, sf_dir, "benchmark"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: doc_id, n_tokens, hashes of ids and decoded bytes, and the ids."""
    import public_tokenizers as P

    return bpe_transducer.encode_decode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, with_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs


#: The classifier and the tokeniser can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
