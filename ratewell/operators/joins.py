"""Joins of a fact table with a lookup that holds one row per key.

A dimension table joins without a hint: Spark compares its size with
``spark.sql.autoBroadcastJoinThreshold`` and falls back to a sort-merge join beyond it.  Two cases
need more than that and are handled here:

* a small result of an aggregation over a large table, whose size Spark overestimates (``bounded``);
* a lookup as large as the facts, where one key may hold much of the fact table (``spread_join``).
"""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CONSTANT_ROWS = 5_000
SALTS = 32
HOT_SHARE = 0.005


def local_table(spark: SparkSession, rows: list[tuple], schema: str | T.StructType) -> DataFrame:
    """A constant table that carries its exact size, so that Spark can broadcast it."""
    layout = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    columns = zip(*rows) if rows else [()] * len(layout)
    table = pa.table({f.name: pa.array(list(c)) for f, c in zip(layout, columns)})
    return spark.createDataFrame(table, layout)


def bounded(df: DataFrame, max_rows: int = CONSTANT_ROWS) -> DataFrame:
    """``df`` as a constant table when it has at most ``max_rows``, else unchanged.

    Spark then broadcasts it by its own size rule.  At most ``max_rows + 1`` rows reach the driver.
    A table that is constant already is left alone, which saves the job.
    """
    if df.isLocal():
        return df
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return df
    return df.sparkSession.createDataFrame(rows, df.schema)


def broadcasts(df: DataFrame) -> bool:
    """Whether Spark broadcasts the table by its own size rule; no job runs."""
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= conf.autoBroadcastJoinThreshold()


def same(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    null_safe: bool = False,
) -> DataFrame:
    """Attach the other columns of ``lookup``, which has one row per ``on`` key."""
    if not null_safe:
        return df.join(lookup, on, how)
    renamed = lookup.withColumnsRenamed({k: f"__{k}" for k in on})
    condition = reduce(
        lambda a, b: a & b, [df[k].eqNullSafe(renamed[f"__{k}"]) for k in on]
    )
    return df.join(renamed, condition, how).drop(*[f"__{k}" for k in on])


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that may hold more than ``share`` of the rows, as a ``__hash`` column.

    One pass, no shuffle of the keys; at most ``1 / share`` rows by construction.  The count is
    approximate, so the rows are only fit to be collected once.
    """
    hashed = df.select(F.xxhash64(*on).alias("h"))
    frequent = hashed.stat.freqItems(["h"], share)
    return frequent.select(F.explode("h_freqItems").alias("__hash"))


def spread_join(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    how: str = "left",
    salts: int = SALTS,
) -> DataFrame:
    """``lookup_join`` for a lookup that may be large and facts that may crowd on a few keys.

    A lookup that Spark broadcasts moves no facts, so nothing crowds.  Else the hot keys of ``df`` are
    spread over ``salts`` shuffle keys and only their lookup rows are repeated, so every other key
    is joined once.  The salt depends on the row content alone: a recomputed task gives it again.
    """
    if broadcasts(lookup):
        return df.join(lookup, on, how)
    # Taken once: both sides must see the same keys, and an approximate count may not repeat itself.
    # At most 1 / HOT_SHARE rows reach the driver.
    listed = [(r["__hash"], True) for r in hot_keys(df, on).collect()]
    hot = local_table(df.sparkSession, listed, "__hash bigint, __hot boolean")
    salt = F.when(F.col("__hot"), F.pmod(F.xxhash64(*df.columns), F.lit(salts))).otherwise(0)
    # Rows with a NULL key match nothing; the row hash spreads them as well.
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    salt = F.when(has_null, F.pmod(F.xxhash64(*df.columns), F.lit(salts))).otherwise(salt)
    facts = (
        df.withColumn("__hash", F.xxhash64(*on))
        .join(hot, "__hash", "left")
        .withColumn("__salt", salt.cast("int"))
        .drop("__hash", "__hot")
    )
    copies = F.when(F.col("__hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    spread = (
        lookup.withColumn("__hash", F.xxhash64(*on))
        .join(hot, "__hash", "left")
        .withColumn("__salt", F.explode(copies))
        .drop("__hash", "__hot")
    )
    return facts.join(spread, [*on, "__salt"], how).drop("__salt")
