"""Data-quality checks on processed facts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratewell.operators.select import IndicatorIds, select_indicators
from ratewell.operators.sets import union_by_name
from ratewell.schema import CODES, DUPLICATE_KEYS, RESULT_COLS

IGNORED = ("numerator", "denominator")


def _active_ids(metadata: DataFrame, calculated_only: bool = False) -> DataFrame:
    active = F.col("status_code") == CODES.active_status
    if calculated_only:
        active &= F.col("precalculated") == "No"
    return metadata.filter(active).select("indicator_id").distinct()


def _usable() -> Column:
    return F.coalesce(F.col("denominator") != 0, F.lit(False))


def _any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns], F.lit(False))


def _checked_columns(df: DataFrame, cols: list[str] | None, ignore: tuple[str, ...]) -> list[str]:
    if cols is None:
        return [c for c in df.columns if c not in ignore]
    return [c for c in cols if c in df.columns]


def check_row_counts(df: DataFrame, reference: DataFrame) -> DataFrame:
    """One row: both counts and whether they are equal."""
    counts = [
        part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(side).alias("side"), "n")
        for side, part in (("input", df), ("reference", reference))
    ]
    both = union_by_name(*counts).agg(
        F.max(F.when(F.col("side") == "input", F.col("n"))).alias("input_rows"),
        F.max(F.when(F.col("side") == "reference", F.col("n"))).alias("reference_rows"),
    )
    return both.withColumn("passed", F.col("input_rows") == F.col("reference_rows"))


def check_missing(
    df: DataFrame,
    metadata: DataFrame,
    cols: list[str] | None = None,
    ignore: tuple[str, ...] = IGNORED,
) -> DataFrame:
    """Rows of active, not precalculated indicators with a NULL in a checked column."""
    checked = _checked_columns(df, cols, ignore)
    suspect = df.filter(_usable() & _any_null(checked))
    return suspect.join(_active_ids(metadata, calculated_only=True), "indicator_id", "left_semi")


def check_age_group_code(df: DataFrame) -> DataFrame:
    """Standardised indicators with more than one age code."""
    pairs = (
        df.filter(F.col("value_type_code") == CODES.dasr)
        .select("indicator_id", "age_group_code")
        .distinct()
    )
    return pairs.groupBy("indicator_id").agg(F.count(F.lit(1)).alias("count")).filter("count > 1")


def check_time_period(df: DataFrame) -> DataFrame:
    """Periods without a label."""
    return (
        df.filter(F.col("time_period_type").isNull())
        .select("indicator_id", "start_date", "end_date")
        .distinct()
    )


def check_active_values(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Rows of active indicators without a value or a limit."""
    suspect = df.filter(_usable() & _any_null(RESULT_COLS))
    return suspect.join(_active_ids(metadata), "indicator_id", "left_semi")


def check_combination(df: DataFrame) -> DataFrame:
    """Rows without a split combination."""
    return df.filter(F.col("combination_id").isNull())


def check_duplicates(
    df: DataFrame, keys: list[str] | None = None, ids: IndicatorIds = None
) -> DataFrame:
    """Key groups that occur more than once."""
    counted = select_indicators(df, ids).groupBy(*(keys or DUPLICATE_KEYS)).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return counted.filter("row_count > 1")


def _row_checks(df: DataFrame, metadata: DataFrame, cols: list[str] | None) -> tuple[DataFrame, dict[tuple[int, str], Column]]:
    """``df`` with what the metadata says of its indicators, and the checks that look at one row alone."""
    flags = metadata.groupBy("indicator_id").agg(
        F.bool_or(F.col("status_code") == CODES.active_status).alias("__active"),
        F.bool_or(
            (F.col("status_code") == CODES.active_status) & (F.col("precalculated") == "No")
        ).alias("__checked"),
    )
    missing = _any_null(_checked_columns(df, cols, IGNORED))
    failing = {
        (2, "missing columns"): F.col("__checked") & _usable() & missing,
        (4, "time period"): F.col("time_period_type").isNull(),
        (5, "active values"): F.col("__active") & _usable() & _any_null(RESULT_COLS),
        (6, "combination"): F.col("combination_id").isNull(),
    }
    return df.join(flags, "indicator_id", "left"), failing


def run_all_checks(
    df: DataFrame, reference: DataFrame | int, metadata: DataFrame, cols: list[str] | None = None
) -> DataFrame:
    """One row per check: failures found, and whether it passed.

    ``reference`` is the input or the number of its rows, where writing it has counted them.  All
    checks share one scan and one aggregation over three sets of keys: the indicator, its period and
    the keys that must not repeat.
    """
    joined, failing = _row_checks(df, metadata, cols)
    aged = F.col("value_type_code") == CODES.dasr
    flagged = joined.select(
        *DUPLICATE_KEYS,
        *[value.alias(f"__fails_{i}") for (i, _), value in failing.items()],
        F.when(aged, F.coalesce("age_group_code", F.lit(-1))).alias("__age"),
    )
    by_period, by_area = F.grouping("start_date") == 0, F.grouping("aggregation_id") == 0
    sets = [DUPLICATE_KEYS[:1], ["indicator_id", "start_date", "end_date"], DUPLICATE_KEYS]
    groups = flagged.groupingSets(sets, *DUPLICATE_KEYS).agg(
        F.when(by_area, 7).when(by_period, 4).otherwise(3).alias("__set"),
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(f"__fails_{i}").alias(f"fails_{i}") for i, _ in failing],
        (F.min("__age") < F.max("__age")).alias("ages"),
    )
    of = lambda k: F.col("__set") == k
    found = groups.agg(
        F.sum(F.when(of(3), F.col("n"))).alias("n"),
        *[F.sum(F.when(of(3), F.col(f"fails_{i}"))).alias(f"fails_{i}") for i in (2, 5, 6)],
        F.count_if(of(3) & F.col("ages")).alias("fails_3"),
        F.count_if(of(4) & (F.col("fails_4") > 0)).alias("fails_4"),
        F.count_if(of(7) & (F.col("n") > 1)).alias("fails_7"),
    )
    counted = F.lit(reference) if isinstance(reference, int) else reference.agg(F.count(F.lit(1))).scalar()
    named = {1: "row counts", 3: "one age code", 7: "duplicates"} | {i: name for i, name in failing}
    failures = {1: F.abs(F.coalesce("n", F.lit(0)) - counted)} | {
        i: F.coalesce(f"fails_{i}", F.lit(0)) for i in range(2, 8)
    }
    rows = [
        F.struct(F.lit(i).alias("check_id"), F.lit(named[i]).alias("check_name"), failures[i].cast("long").alias("failures"))
        for i in range(1, 8)
    ]
    return found.select(F.inline(F.array(*rows))).withColumn("passed", F.col("failures") == 0)


def failing_rows(
    df: DataFrame, metadata: DataFrame, show_n: int = 10, cols: list[str] | None = None
) -> DataFrame:
    """The first ``show_n`` rows that fail each check of single rows: check_id, check_name, nth, the row.

    Rows are ordered by all their columns, in the order of the table and nulls first, so the same rows are
    shown however the table is partitioned.  One scan for all checks; no task passes on more than
    ``show_n`` rows of a check.
    """
    joined, failing = _row_checks(df, metadata, cols)
    fails = [
        F.when(value, F.struct(F.lit(i).alias("check_id"), F.lit(name).alias("check_name")))
        for (i, name), value in failing.items()
    ]
    rows = joined.select(F.explode(F.array_compact(F.array(*fails))).alias("__check"), *df.columns)
    rows = rows.select("__check.check_id", "__check.check_name", *df.columns)
    order = Window.partitionBy("check_id").orderBy(*[F.asc_nulls_first(c) for c in df.columns])
    shown = rows.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= show_n)
    return shown.select("check_id", "check_name", "nth", *df.columns)
