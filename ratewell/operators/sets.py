"""Unions and distinct lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratewell.operators.joins import bounded


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """All rows; a column missing from one input is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    return union_by_name(*dfs).distinct()


def code_list(*columns: tuple[DataFrame, str], name: str = "code") -> DataFrame:
    """Distinct codes over columns of several tables."""
    parts = [df.select(F.col(column).alias(name)).distinct() for df, column in columns]
    return union_distinct(*parts)


def count_by(df: DataFrame, keys: list[str], name: str = "count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def groups_by(df: DataFrame, parent: list[str], keys: list[str], name: str = "count") -> DataFrame:
    """Number of distinct ``keys`` groups under each ``parent``."""
    return count_by(df.select(*parent, *keys).distinct(), parent, name)


def latest_load(df: DataFrame, key: str = "indicator_id", loaded: str = "creation_date") -> DataFrame:
    """Rows of the latest load of each indicator, ties included."""
    latest = bounded(df.groupBy(key).agg(F.max(loaded).alias("__latest")))
    return df.join(latest, key).filter(F.col(loaded) == F.col("__latest")).drop("__latest")


def combine_landing(dfs: list[DataFrame], latest: bool = True) -> DataFrame:
    """One staging table from the landing tables; keeps the latest load of each indicator."""
    staged = union_by_name(*dfs)
    return latest_load(staged) if latest else staged
