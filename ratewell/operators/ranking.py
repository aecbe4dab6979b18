"""Quantile bands and dense ids without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.operators.joins import bounded, local_table
from ratewell.staging import stage


def _placed(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    """``df`` in ranges of ``order``, numbered in a ``__range`` column.

    The rows are written to a table: the work behind them is done once, and a recomputed task
    cannot move a row to another range.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *order)
    return stage(ranged.withColumn("__range", F.spark_partition_id()))


def _matches(by: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by], F.lit(True)
    )


def ranked_counts(
    counted: DataFrame,
    column: str,
    by: list[str],
    order: Callable[[str], Column] = F.asc,
    partitions: int | None = None,
) -> DataFrame:
    """Counted values (``by``, ``column``, ``__n``) with first rank and group size.

    Adds ``__rank`` and ``__total``.  Values are ranked
    in ranges whose sizes are added up, so a group may spread over many tasks.
    """
    placed = _placed(counted, [*by, column], partitions)
    # One row per group and range.
    sizes = placed.groupBy(*by, "__range").agg(F.sum("__n").alias("__size"))
    group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    earlier = group.orderBy(order("__range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = bounded(
        sizes.select(
            *[F.col(k).alias(f"__{k}") for k in by],
            F.col("__range").alias("__at"),
            F.coalesce(F.sum("__size").over(earlier), F.lit(0)).alias("__before"),
            F.sum("__size").over(group).alias("__total"),
        )
    )
    inside = (
        Window.partitionBy(*by, "__range")
        .orderBy(order(column))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    rank = F.col("__before") + F.coalesce(F.sum("__n").over(inside), F.lit(0)) + 1
    joined = placed.join(offsets, _matches(by) & (F.col("__range") == F.col("__at")))
    return joined.withColumn("__rank", rank).select(*by, column, "__n", "__rank", "__total")


def quantile_band(
    df: DataFrame,
    column: str,
    n: int = 5,
    invert: bool = True,
    by: list[str] | None = None,
    name: str = "quantile",
    partitions: int | None = None,
) -> DataFrame:
    """Band 1..n of a value by its smallest rank, so equal values share a band.

    With ``invert`` the highest value is in band 1.  Distinct values are counted and ranked in
    ranges whose sizes are added up; each band is then one span of values per group, so rows are
    banded by comparison and no crowded value or group meets in one task.
    """
    by = by or []
    value = F.col(column)
    order = F.desc if invert else F.asc
    counted = (
        df.filter(value.isNotNull()).groupBy(*by, column).agg(F.count(F.lit(1)).alias("__n"))
    )
    placed = ranked_counts(counted, column, by, order, partitions)
    left_over = F.col("__total") + 1 - F.col("__rank")
    band = F.floor(F.lit(n + 1) - F.ceil(left_over / (F.col("__total") / n)))
    ranked = placed.withColumn("__band", F.when(band == 0, 1).otherwise(band))
    # The last value of each band, one row per group.
    edge = F.min if invert else F.max
    edges = bounded(
        ranked.groupBy(*[F.col(k).alias(f"__{k}") for k in by]).agg(
            *[edge(F.when(F.col("__band") == b, value)).alias(f"__edge{b}") for b in range(1, n + 1)],
        )
    )

    def reached(edge_value: Column) -> Column:
        return value >= edge_value if invert else value <= edge_value

    if by:
        joined = df.join(edges, _matches(by), "left")
        edge_of = {b: F.col(f"__edge{b}") for b in range(1, n + 1)}
    else:
        first = edges.first()
        joined = df
        kind = df.schema[column].dataType
        edge_of = {b: F.lit(first[f"__edge{b}"]).cast(kind) for b in range(1, n + 1)}
    banded = F.coalesce(*[F.when(reached(e), b) for b, e in edge_of.items()])
    return joined.withColumn(name, banded).select(*df.columns, name)


def with_surrogate_id(
    df: DataFrame, order: list[str], name: str = "population_id", partitions: int | None = None
) -> DataFrame:
    """Dense ids 1..N in ``order``: each range numbers its rows after those of earlier ranges."""
    rest = [c for c in df.columns if c not in order]
    placed = _placed(df, [*order, *rest], partitions)
    # One row per range reaches the driver.
    sizes = placed.groupBy("__range").count().collect()
    starts, seen = [], 0
    for row in sorted(sizes, key=lambda r: r["__range"]):
        starts.append((row["__range"], seen))
        seen += row["count"]
    offsets = local_table(df.sparkSession, starts, "__range int, __start bigint")
    within = Window.partitionBy("__range").orderBy(*order, *rest)
    return (
        placed.join(offsets, "__range")
        .withColumn(name, F.col("__start") + F.row_number().over(within))
        .select(*df.columns, name)
    )
