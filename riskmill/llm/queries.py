"""Registered queries of this subpackage and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskmill.llm import byte_bpe, centroids, conversation_trie, decontamination, exact_dedup, minhash, page_text, ranked_ids, secrets, simhash, token_counts, toxicity, warc
from riskmill.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; the package lies on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str):
    def add(function):
        QUERIES[name] = function
        return function

    return add


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


@query("op2_ranked_token_files")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_ids.round_trip(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op5_byte_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


@query("op6_page_text")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.extract_pages(table(spark, sf_dir, "pages"))


@query("op7_warc_round_trip")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op8_minhash_fingerprints")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.edited_report(table(spark, sf_dir, "documents"))


@query("op9_decontamination")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_secret_scans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_report(table(spark, sf_dir, "documents"))


@query("op11_exact_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.find_copies(table(spark, sf_dir, "documents"))


@query("op12_conversation_trie")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_centroid_clustering")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster_report(table(spark, sf_dir, "embeddings"))


SQL["op10_secret_scans"] = secrets.report_sql()
SQL["op11_exact_dedup"] = exact_dedup.copies_sql()
SQL["op12_conversation_trie"] = conversation_trie.trie_sql()
SQL["op13_centroid_clustering"] = centroids.report_sql()
