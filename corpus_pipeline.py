"""A corpus cleaned in five stages, each a written table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmill.llm import byte_bpe, decontamination, secrets, simhash, toxicity
from riskmill.llm.common import materialize, table
from riskmill.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labelled documents, calls toxic go."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest doc_id stays."""
    return simhash.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that contain a benchmark passage go."""
    return decontamination.drop_leaking_rows(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are replaced by a mark; every document stays, ``n_chars`` follows its text."""
    return secrets.redact_secrets(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a check that they decode to its text."""
    return byte_bpe.encode_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("secret redaction", redact),
    ("byte-pair encoding", encode),
]

#: No SQL expresses a trained network or a projection; tests/llm holds the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; every stage but the last is written and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
