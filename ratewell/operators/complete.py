"""Exclusion of reporting periods that are not complete yet."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.operators.joins import bounded
from ratewell.operators.ranking import ranked_counts


def group_mode(df: DataFrame, keys: list[str], column: str, weight: str | None = None) -> DataFrame:
    """Most frequent value per group, the smallest among equals; NULLs do not count.

    Counts per value come first, so no group is gathered in one place.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(amount.alias("__n"))
    best = F.min_by(column, F.struct(-F.col("__n"), F.col(column)))
    return counted.groupBy(*keys).agg(best.alias("mode"))


def group_median(df: DataFrame, keys: list[str], column: str, weight: str | None = None) -> DataFrame:
    """Exact median per group; NULLs do not count, a group without values has none.

    Values are counted, ranked in ranges and only the middle one or two of each group are kept, so
    no group is gathered in one place however many values it has.
    """
    amount = F.sum(weight) if weight else F.count(F.lit(1))
    present = F.col(column).isNotNull()
    counted = df.groupBy(*keys, column).agg(F.when(F.first(present), amount).otherwise(0).alias("__n"))
    ranked = ranked_counts(counted, column, keys)
    total = F.col("__total")

    def at(rank: Column) -> Column:
        inside = (F.col("__rank") <= rank) & (rank < F.col("__rank") + F.col("__n"))
        return F.max(F.when(inside, F.col(column)))

    lower, upper = at(F.floor((total + 1) / 2)), at(F.floor((total + 2) / 2))
    return ranked.groupBy(*keys).agg(((lower + upper) / 2).alias("median"))


def typical_cycles(
    df: DataFrame, keys: list[str], start: str, end: str, current_date: date
) -> DataFrame:
    """Usual closing day (``MM-dd``) and usual length in days of the periods already over."""
    past = df.filter(F.col(end) <= F.lit(current_date))
    periods = past.groupBy(*keys, start, end).agg(F.count(F.lit(1)).alias("n"))
    periods = periods.withColumns(
        {
            "mmdd": F.date_format(end, "MM-dd"),
            "days": (F.datediff(end, start) + 1).cast("double"),
        }
    )
    closing = group_mode(periods, keys, "mmdd", "n").withColumnRenamed("mode", "end_mmdd")
    length = periods.groupBy(*keys).agg(F.percentile("days", 0.5, F.col("n")).alias("typical_days"))
    both = closing.unionByName(length, allowMissingColumns=True)
    return both.groupBy(*keys).agg(
        F.max("end_mmdd").alias("end_mmdd"), F.max("typical_days").alias("typical_days")
    )


def exclude_incomplete(
    df: DataFrame,
    year_type: str = "year_type",
    start: str = "start_date",
    end: str = "end_date",
    period: str | None = "time_period_type",
    current_date: date | None = None,
    enforce_duration: bool = True,
    tolerance_days: int = 5,
) -> tuple[DataFrame, DataFrame]:
    """Rows of completed periods of usual length, and the rows left out, both as they came in.

    A year type and period label close on their usual day; the latest such day not after
    ``current_date`` is the last completed cycle.
    """
    today = current_date or date.today()
    keys = ["__year_type"] + (["__period"] if period else [])
    marked = df.withColumn("__year_type", F.lower(year_type))
    if period:
        marked = marked.withColumn("__period", F.lower(period))

    def closing(year: int, mmdd):
        return F.concat(F.lit(f"{year:04d}-"), mmdd).try_cast("date")

    def latest(mmdd):
        this_year = closing(today.year, mmdd)
        return F.when(this_year <= F.lit(today), this_year).when(
            this_year > F.lit(today), closing(today.year - 1, mmdd)
        )

    cycles = bounded(
        typical_cycles(marked, keys, start, end, today).select(
            *[F.col(k).alias(f"{k}_seen") for k in keys],
            F.lit(True).alias("__seen"),
            latest(F.col("end_mmdd")).alias("__latest"),
            F.col("typical_days").alias("__days"),
        )
    )
    matches = reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_seen")) for k in keys]
    )
    joined = marked.join(cycles, matches, "left")
    last_cycle = F.when(F.col("__seen"), F.col("__latest")).otherwise(latest(F.lit("12-31")))
    kept = F.coalesce(F.col(end) <= last_cycle, F.lit(False))
    if enforce_duration:
        days = F.datediff(end, start) + 1
        kept &= F.coalesce(F.abs(days - F.col("__days")) <= tolerance_days, F.lit(True))
    flagged = joined.withColumn("__kept", kept)
    return (
        flagged.filter("__kept").select(df.columns),
        flagged.filter("not __kept").select(df.columns),
    )


def excluded_counts(excluded: DataFrame) -> DataFrame:
    """Excluded rows per indicator, most first."""
    counts = excluded.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("excluded_rows"))
    return counts.orderBy(F.desc("excluded_rows"), "indicator_id")
