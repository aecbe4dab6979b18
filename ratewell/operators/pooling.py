"""Pooling of yearly census rows into multi-year windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.schema import CODES, POOL_KEYS

YEAR = "period_year"


def total(column: str | Column) -> Column:
    """Sum that is 0, not NULL, over no values."""
    return F.coalesce(F.sum(column), F.lit(0.0))


def poolable_rows(df: DataFrame, only_yearly: bool = False) -> DataFrame:
    """Census rows with a pooled year type, and the year they start in.

    ``only_yearly`` leaves out rows that already cover several years.
    """
    rows = df.filter(
        (F.col("population_type") == CODES.census)
        & F.col("year_type").isin(list(CODES.pooled_year_types))
        & F.col("start_date").isNotNull()
    )
    if only_yearly:
        rows = rows.filter(F.col("time_period_type") == "1 year")
    return rows.withColumn(YEAR, F.year("start_date"))


def yearly_totals(df: DataFrame, only_yearly: bool = False) -> DataFrame:
    """Census numerators and denominators per pooling key, year type and starting year."""
    return (
        poolable_rows(df, only_yearly)
        .groupBy(*POOL_KEYS, "year_type", YEAR)
        .agg(total("numerator").alias("numerator"), total("denominator").alias("denominator"))
    )


def year_windows(years: DataFrame, k: int, column: str = YEAR) -> DataFrame:
    """Every window of ``k`` years inside the span of ``column``; none if the span is shorter."""
    if k < 1:
        raise ValueError("a window needs at least one year")
    span = years.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    fits = span.filter(F.col("last") - F.col("first") >= k - 1)
    starts = F.explode(F.sequence("first", F.col("last") - (k - 1)))
    return fits.select(starts.alias("from")).select(
        "from", (F.col("from") + (k - 1)).alias("to"), F.lit(k).alias("k")
    )


def expand_windows(
    yearly: DataFrame,
    spans: tuple[int, ...] = (3, 5),
    windows: DataFrame | None = None,
    years: DataFrame | None = None,
) -> DataFrame:
    """Repeat each yearly row for every window that covers its year.

    Windows of fixed spans are generated from the row's own year, without a join.  A given
    ``windows`` table (from, to, k) is matched year by year.  Windows reaching outside the years of
    all data (``years``, by default ``yearly`` itself) are left out in both cases.
    """
    years = yearly if years is None else years
    first = years.agg(F.min(YEAR)).scalar()
    last = years.agg(F.max(YEAR)).scalar()
    inside = (F.col("from") >= first) & (F.col("to") <= last)
    if windows is not None:
        covered = windows.select(
            "from", "to", "k", F.explode(F.sequence("from", "to")).alias(YEAR)
        )
        return yearly.join(covered, YEAR).filter(inside)
    options = [
        F.struct(
            (F.col(YEAR) - back).alias("from"),
            (F.col(YEAR) - back + (k - 1)).alias("to"),
            F.lit(k).alias("k"),
        )
        for k in spans
        for back in range(k)
    ]
    return (
        yearly.withColumn("__window", F.explode(F.array(*options)))
        .select("*", "__window.*")
        .drop("__window")
        .filter(inside)
    )


def pool_years(
    df: DataFrame,
    spans: tuple[int, ...] = (3, 5),
    windows: DataFrame | None = None,
    only_yearly: bool = False,
) -> DataFrame:
    """Totals per window, with the dates and label of the window and empty result columns.

    The yearly totals collapse any crowded key to one row per year before they are placed by
    pooling key, and the windows of a key are then summed where they lie: no shuffle of the
    repeated rows.
    """
    keys = [*POOL_KEYS, "year_type"]
    placed = yearly_totals(df, only_yearly).repartition(*keys)
    years = poolable_rows(df, only_yearly).select(YEAR)
    pooled = (
        expand_windows(placed, spans, windows, years)
        .groupBy(*keys, "from", "to", "k")
        .agg(F.sum("numerator").alias("numerator"), F.sum("denominator").alias("denominator"))
    )
    calendar = F.col("year_type") == "Calendar"
    empty = F.lit(None).cast("double")
    return pooled.select(
        "indicator_id",
        F.when(calendar, F.make_date("from", F.lit(1), F.lit(1)))
        .otherwise(F.make_date("from", F.lit(4), F.lit(1)))
        .alias("start_date"),
        F.when(calendar, F.make_date("to", F.lit(12), F.lit(31)))
        .otherwise(F.make_date(F.col("to") + 1, F.lit(3), F.lit(31)))
        .alias("end_date"),
        "numerator",
        "denominator",
        empty.alias("indicator_value"),
        empty.alias("lower_ci95"),
        empty.alias("upper_ci95"),
        *[c for c in POOL_KEYS if c not in ("indicator_id", "combination_id")],
        F.concat(F.col("k").cast("string"), F.lit(" year pooled")).alias("time_period_type"),
        "combination_id",
    )
