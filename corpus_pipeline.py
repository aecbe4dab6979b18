"""A training corpus from raw documents: five stages, each a table that the next one reads.

Documents that the quality classifier rejects go; of each group of near duplicates one document stays;
documents that leak benchmark items go; secrets are masked in the text; what is left is packed into
sequences.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewell.llm.common import fresh_name, new_folder, table
from ratewell.llm.jaccard import jaccard_components, without_words
from ratewell.llm.packing import pack_pieces, token_pieces
from ratewell.llm.quality import score_quality
from ratewell.llm.queries import WORD_BPE
from ratewell.llm.secret_scan import mask_secrets
from ratewell.llm.tiling import without_leaks


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the classifier finds good with 0.7 or more; texts without words go too."""
    score = fresh_name(docs, "quality_score")
    scored = score_quality(docs, table(spark, sf_dir, "labels"), label="quality", most=2000, score=score)
    return scored.where(F.col(score) >= 0.7).drop(score)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: the one with the smallest doc_id, then text.

    Documents link at a Jaccard similarity of 0.8 of their five-word shingles.  A document is its doc_id and
    its text: rows that repeat both stay once, unlike texts under one doc_id are documents of their own.
    A null doc_id is the largest.  Documents without words stay, and so do their repeats.
    """
    key, none = fresh_name(docs, "document_key"), F.col("doc_id").isNull()
    named = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit("")))
    marked = docs.withColumn(key, F.unhex(F.md5(named.cast("binary"))))
    found = jaccard_components(marked, size=5, percent=80, keys=(key,)).where(F.col("component").isNotNull())
    first = found.groupBy("component").agg(F.min(F.struct(none.alias("none"), "doc_id", F.col(key).alias("key"))).alias("first"))
    wordless = without_words(F.col("text"))
    # Joined and deduplicated by one key, so rows are shuffled once.
    one = marked.where(~wordless).join(first.select(F.col("first.key").alias(key)), key, "left_semi").dropDuplicates([key])
    return docs.where(wordless).unionByName(one.select(docs.columns))


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose tiles cover half of a benchmark item or more."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"), shortest=5, share=0.5)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the value of every secret but widely copied placeholders; documents stay."""
    return mask_secrets(docs, owner="source", repository="doc_id")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 ids and their places in sequences."""
    pieces = token_pieces(docs, WORD_BPE, capacity=4096, end_id=1).drop("ids")
    return pack_pieces(pieces, capacity=4096).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_quality),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", no_benchmark),
    ("secret scans", no_secrets),
    ("best-fit packing", packed),
]
ORACLE_SQL = None  # a trained classifier and a tokenizer have no SQL counterpart


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet in the shared folder and reread."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = new_folder(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
