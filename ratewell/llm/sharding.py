"""Contiguous shards of nearly equal bytes, cut on a global prefix sum."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratewell.staging import stage


def shard_by_bytes(docs: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) in one of ``shards`` shards of nearly equal bytes.

    Rows are laid in one line, equal texts next to each other (by md5 of the text, then doc_id, nulls
    first), so a shard is a contiguous run and a group of copies is parted only where a cut falls in
    it.  The bytes before a row are the totals of the partitions before its own plus a running sum
    inside it; its middle byte says which of the equal targets it falls into, so a shard is off its
    target by less than its two largest rows.  Partitions are ranges over (md5, doc_id), so a group
    of copies is spread over several of them; one total per partition reaches the driver.

    ``size`` is the UTF-8 bytes of the text plus ``overhead``.  A null text counts as empty, a null
    doc_id comes first, repeated rows take neighbouring slots, an empty table gives no rows, other
    columns are left out.
    """
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(body) + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.md5(body).alias("text_md5"),
    )
    line = ["text_md5", "doc_id"]
    # Written once: the ranges are drawn from a sample and must not be drawn twice.
    ranged = stage(rows.repartitionByRange(*line).withColumn("part", F.spark_partition_id()))
    totals = ranged.groupBy("part").agg(F.sum("size").alias("size")).orderBy("part").collect()
    before = list(accumulate((t["size"] for t in totals), initial=0))
    spark = docs.sparkSession
    bases = spark.createDataFrame([(t["part"], b) for t, b in zip(totals, before)], "part int, base long")
    inside = Window.partitionBy("part").orderBy(*line).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside))
        .join(F.broadcast(bases), "part")
        .withColumn("twice", 2 * (F.col("base") + F.col("upto")) - F.col("size"))
        .withColumn("shard", F.expr(f"int((twice * {shards}) div {max(2 * before[-1], 1)})"))
        .drop("base", "twice")
    )
    placed = stage(placed)
    counts = placed.groupBy("shard", "part").count().orderBy("shard", "part").collect()
    firsts, shard, at = [], None, 0
    for row in counts:
        at = 0 if row["shard"] != shard else at
        shard = row["shard"]
        firsts.append((shard, row["part"], at))
        at += row["count"]
    starts = spark.createDataFrame(firsts, "shard int, part int, first long")
    here = Window.partitionBy("part", "shard").orderBy(*line, "upto")
    return (
        placed.withColumn("nth", F.row_number().over(here) - 1)
        .join(F.broadcast(starts), ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
            (F.col("first") + F.col("nth")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
