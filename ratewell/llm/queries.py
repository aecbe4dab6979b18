"""The queries opN_<name> over the given tables, one per operator, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.llm import sql
from ratewell.llm.alignment import align_tokens
from ratewell.llm.backoff import score_texts
from ratewell.llm.common import crc_of_id, table
from ratewell.llm.html_text import extract_text
from ratewell.llm.jaccard import jaccard_components
from ratewell.llm.packing import pack_pieces, token_pieces
from ratewell.llm.quality import score_quality
from ratewell.llm.secret_scan import scan_secrets, written
from ratewell.llm.sharding import shard_by_bytes
from ratewell.llm.spelling import spelling_variants
from ratewell.llm.tiling import find_leaks
from ratewell.llm.token_files import read_token_files, with_starts, write_token_files
from ratewell.llm.topk import search
from ratewell.llm.toxicity import score_toxicity

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_greedy_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=5, share=0.5)
    return found.select("doc_id", "item_id", "n_words", "n_covered", F.size("tiles").alias("n_tiles"))


def op2_no_random_access_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


def op3_owner_frequency_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"), owner="source", repository="doc_id")
    counted = lambda flag: F.size(F.filter("spans", lambda s: s[flag])).cast("long").alias(f"n_{flag}")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"),
        counted("live"), counted("copied"),
    )


def op4_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op5_prefix_sum_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(table(spark, sf_dir, "documents"), shards=24)


def op6_backoff_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), order=2, fold=10)


def op7_vertical_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op8_subword_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), label="quality", most=2000)
    return scored.select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 4 == 2).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


def op9_large_item_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), WORD_BPE, capacity=4096, end_id=1)
    packed = pack_pieces(pieces.drop("ids"), capacity=4096)
    return packed.select("doc_id", F.col("piece").cast("int").alias("piece"), "start", "length", "ids_crc32", "sequence_id", "offset")


def op10_seekable_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write_token_files(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=2)
    found = with_starts(index, read_token_files(index, keep_ids=False))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_shared_cut_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op12_bloom_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), least=7, every=31, times=10)


def op13_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, table(spark, sf_dir, "labels"), label="toxic")
    return scored.select(
        "doc_id", (crc_of_id(F.col("doc_id")) % 3 == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_greedy_string_tiling, op2_no_random_access_topk, op3_owner_frequency_secrets, op4_html_main_text, op5_prefix_sum_shards, op6_backoff_automaton,
        op7_vertical_jaccard_join, op8_subword_classifier, op9_large_item_packing, op10_seekable_token_files,
        op11_shared_cut_alignment, op12_bloom_spelling_variants, op13_boosted_toxicity,
    )
}
ORACLE_SQL: dict[str, str] = {"op2_no_random_access_topk": sql.OP2, "op3_owner_frequency_secrets": sql.OP3, "op7_vertical_jaccard_join": sql.OP7}
