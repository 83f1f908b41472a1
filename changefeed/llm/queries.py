"""Registered queries: each operator over its whole table, with the digest its contract asks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.llm.common import table
import public_tokenizers
from changefeed.llm import cotraining, kd_shards, licenses, line_chunks, pieces, repair_store, suffix_dedup, va_clusters
from changefeed.llm.cross_polytope import nearest_neighbours
from changefeed.llm.prefix_trie import prefix_trie
from changefeed.llm.decontaminate import find_contamination, judge
from changefeed.llm.rules import cascade
from changefeed.llm.simhash import near_duplicates


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences found in each document: units compared, matches, names and the best score."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_units", F.size("matches").cast("bigint").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct("matches.name")), ",").alias("licenses"),
        F.round(F.coalesce(F.array_max("matches.dice"), F.lit(0.0)), 9).alias("best_dice"),
    )


def op2_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What removing globally repeated line chunks leaves of each document."""
    return line_chunks.remove_repeated(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_chunks", "removed", "removed_lines", F.md5("text").alias("kept_md5")
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judge(find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
    ids = F.array_sort(F.transform("items", lambda x: x.cast("string")))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = repair_store.store_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=2
    )
    return repair_store.read_store(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op5_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of both views and the verdict for every document."""
    docs = table(spark, sf_dir, "documents")
    return cotraining.train_and_score(docs, table(spark, sf_dir, "labels"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeated(table(spark, sf_dir, "documents")).drop("kept")


def op7_piece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and whether decoding them gives the text back."""
    found = pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    n_tokens = F.coalesce(F.size("ids"), F.lit(0)).cast("bigint")
    return found.select("doc_id", n_tokens.alias("n_tokens"), "ids_crc32", "decoded_sha256", "round_trip")


def op8_rule_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade(table(spark, sf_dir, "documents"))


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of each vector after five exact rounds."""
    return va_clusters.with_inertia(*va_clusters.cluster(table(spark, sf_dir, "embeddings")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations")).drop("size")


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_license_scan, op2_line_chunks, op3_decontaminate, op4_repair_tokens, op5_cotraining,
        op6_suffix_dedup, op7_piece_viterbi, op8_rule_cascade, op9_kd_shards, op10_golay_simhash,
        op11_cross_polytope, op12_va_clusters, op13_prefix_trie,
    )
}
