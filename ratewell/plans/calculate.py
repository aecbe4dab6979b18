"""From staged facts to indicator values with confidence limits."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions import casts, intervals
from ratewell.operators import select
from ratewell.operators.complete import exclude_incomplete
from ratewell.operators.joins import bounded
from ratewell.operators.lookup import one_age_per_indicator, with_metadata, with_stdpop
from ratewell.operators.pooling import pool_years
from ratewell.operators.sets import union_by_name
from ratewell.operators.standardise import dsr, dsr_validate, signed
from ratewell.schema import CODES, DASR_KEYS, METADATA_COLS, PROCESSED_SCHEMA, TIDY_COLS
from ratewell.staging import stage

KEEP, SKIP, PERCENTAGE, RATE, DASR, UNSUPPORTED = (
    "keep", "skip", "percentage", "rate", "dasr", "unsupported"
)


@dataclass(frozen=True)
class Result:
    """The combined output and its parts; each reads the routed rows, which are a written table."""

    combined: DataFrame
    keep: DataFrame
    skip: DataFrame
    percentage: DataFrame
    crude_ratio: DataFrame
    dasr: DataFrame
    unsupported: DataFrame
    rejected: DataFrame
    excluded: DataFrame
    skip_reasons: DataFrame


def prepare(df: DataFrame) -> DataFrame:
    """Types, period label and split combination of staged rows."""
    return select.with_combination_id(select.with_duration_label(select.clean_types(df)))


def needs_calculation() -> Column:
    """No value yet, and a denominator to divide by."""
    denominator = F.col("denominator")
    usable = ~casts.missing(denominator) & (denominator != 0)
    return casts.missing(F.col("indicator_value")) & F.coalesce(usable, F.lit(False))


def route(df: DataFrame) -> DataFrame:
    """Name the treatment of each row in a ``route`` column."""
    kind = F.col("value_type_code")
    eligible = (
        F.col("multiplier").isNotNull()
        & F.coalesce(F.col("status_code").isin(list(CODES.eligible_status)), F.lit(False))
        & kind.isNotNull()
    )
    return df.withColumn(
        "route",
        F.when(~needs_calculation(), KEEP)
        .when(~eligible, SKIP)
        .when(kind == CODES.percentage, PERCENTAGE)
        .when(kind.isin(CODES.crude_rate, CODES.ratio), RATE)
        .when(kind == CODES.dasr, DASR)
        .otherwise(UNSUPPORTED),
    )


def skip_reasons(routed: DataFrame) -> DataFrame:
    """Why rows that needed a calculation did not get one, per indicator and status."""
    status = F.col("status_code")
    inactive = F.coalesce(status != CODES.active_status, F.lit(True))
    shown = F.concat(F.lit("status_code = "), F.coalesce(status.cast("int").cast("string"), F.lit("NA")))
    flags = routed.filter(F.col("route").isin(SKIP, UNSUPPORTED)).groupBy(
        "indicator_id", "status_code"
    ).agg(
        F.bool_or(F.col("multiplier").isNull()).alias("multiplier"),
        F.bool_or((F.col("route") == SKIP) & inactive).alias("status"),
        F.bool_or(F.col("value_type_code").isNull()).alias("value_type"),
        F.bool_or(F.col("route") == UNSUPPORTED).alias("unsupported"),
    )
    return flags.select(
        "indicator_id",
        "status_code",
        F.concat_ws(
            "; ",
            F.when(F.col("multiplier"), "missing multiplier"),
            F.when(F.col("status"), shown),
            F.when(F.col("value_type"), "missing value_type_code"),
            F.when(F.col("unsupported"), "unsupported value_type_code"),
        ).alias("reasons"),
    )


def calc_dasr(df: DataFrame, metadata: DataFrame, ages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Age-standardised rows with the age code of their indicator, and the rejected rows."""
    weighted = with_stdpop(df.filter(F.col("value_type_code") == CODES.dasr))
    usable, rejected = dsr_validate(weighted)
    rates = dsr(usable, DASR_KEYS, kind="standard")
    coded = rates.join(one_age_per_indicator(metadata, ages), "indicator_id", "left")
    return coded.withColumnRenamed("age_code", "age_group_code"), rejected


def by_row(routed: DataFrame) -> DataFrame:
    """Every route but the age-standardised one, row by row.

    Small fractional counts need limits found by bisection, which generated code can't hold, so they
    are a branch of their own; all other rows stay in generated code.
    """
    x = F.abs(F.coalesce("numerator", F.lit(0.0)))
    fractional = (F.col("route") == RATE) & (x < intervals.EXACT_BELOW) & (x != F.floor(x))
    rows = routed.filter(F.col("route").isin(KEEP, SKIP, PERCENTAGE, RATE))
    return union_by_name(
        _by_row(rows.filter(~fractional), False), _by_row(rows.filter(fractional), True)
    )


def _by_row(rows: DataFrame, fractional: bool) -> DataFrame:
    """Limits, scaling and cleaning are separate steps, so that each limit is worked out once."""
    way = F.col("route")
    calculated = way.isin(PERCENTAGE, RATE)
    x, n = F.col("__x"), F.col("denominator")
    started = rows.withColumn(
        "__x", F.when(calculated, F.coalesce(F.col("numerator"), F.lit(0.0)))
    )
    wilson = intervals.wilson(x, n)
    poisson = intervals.poisson_limits(F.abs(x), fractional=fractional)
    limited = started.withColumns(
        {
            name: F.when(way == PERCENTAGE, share).when(way == RATE, F.try_divide(count, n))
            for name, share, count in zip(("__low", "__high"), wilson, poisson)
        }
    )
    scaled = limited.withColumns(signed(F.col("__low"), F.col("__high"), x, n, F.col("multiplier")))
    kept_as_is = {"value": "indicator_value", "lowercl": "lower_ci95", "uppercl": "upper_ci95"}
    chosen = scaled.withColumns(
        {name: F.when(calculated, F.col(part)).otherwise(F.col(name)) for part, name in kept_as_is.items()}
    )
    return select.finite_or_null(
        chosen.withColumns(
            {
                "numerator": F.coalesce(x, F.col("numerator")),
                "denominator": F.coalesce(n, F.lit(0.0)),
                "age_group_code": F.when(calculated, F.col("age_group_code")).otherwise(
                    F.col("age_code")
                ),
            }
        ).select("route", *TIDY_COLS)
    )


def calculate_values(
    data: DataFrame,
    metadata: DataFrame,
    ages: DataFrame,
    current_date: date | None = None,
    spans: tuple[int, ...] = (3, 5),
    only_yearly: bool = False,
) -> Result:
    """The whole calculation on staged facts.

    Rows of incomplete periods leave first; census rows are pooled into windows; every row is then
    routed.  All routes but one work row by row.  Building the result runs jobs: the usual cycle of
    each kind of period is taken from the facts, small dimensions become constants unless they are,
    and the routed rows are written to a staging table.
    """
    metadata, ages = bounded(metadata).select(METADATA_COLS), bounded(ages)
    facts = with_metadata(prepare(data), metadata)
    kept, excluded = exclude_incomplete(facts, current_date=current_date)
    pooled = with_metadata(pool_years(kept, spans, only_yearly=only_yearly), metadata)
    every = union_by_name(pooled, kept.select(pooled.columns))
    coded = every.join(one_age_per_indicator(metadata, ages), "indicator_id", "left")
    # Written once: every part of the result reads it.
    routed = stage(route(coded))

    rows = by_row(routed)
    standardised, rejected = calc_dasr(routed.filter(F.col("route") == DASR), metadata, ages)
    dasr_rows = select.finite_or_null(select.tidy(standardised))
    tidy_rows = rows.drop("route")
    return Result(
        combined=union_by_name(tidy_rows, dasr_rows),
        keep=rows.filter(F.col("route") == KEEP).drop("route"),
        skip=rows.filter(F.col("route") == SKIP).drop("route"),
        percentage=rows.filter(F.col("route") == PERCENTAGE).drop("route"),
        crude_ratio=rows.filter(F.col("route") == RATE).drop("route"),
        dasr=dasr_rows,
        unsupported=routed.filter(F.col("route") == UNSUPPORTED).select(TIDY_COLS),
        rejected=rejected,
        excluded=excluded,
        skip_reasons=skip_reasons(routed),
    )


def processed_rows(combined: DataFrame, at: datetime | None = None) -> DataFrame:
    """Rows as they are published: finite numbers, load time, processed layout."""
    loaded = select.with_insertion_time(select.finite_or_null(combined), at)
    return loaded.select(
        [F.col(f.name).cast(f.dataType).alias(f.name) for f in PROCESSED_SCHEMA]
    )
