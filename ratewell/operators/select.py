"""Row filters, projections and previews."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions import casts, codes, dates, names
from ratewell.operators.joins import bounded
from ratewell.schema import (
    CODES,
    FLOAT_COLS,
    GEOGRAPHY,
    RESULT_COLS,
    SELF_HARM_CODES,
    TIDY_COLS,
    TIDY_SCHEMA,
    Geography,
)

IndicatorIds = str | int | float | Iterable[str | int | float | None] | None


def normalise_ids(ids: IndicatorIds) -> list[str | int | float] | None:
    """Requested ids as a list without blanks and repeats; None stands for every indicator."""
    if ids is None:
        return None
    if isinstance(ids, str):
        if ids.strip().lower() in {"all", "*"}:
            return None
        ids = ids.split(",")
    elif isinstance(ids, (int, float)):
        ids = [ids]
    wanted: dict[str | int | float, None] = {}
    for item in ids:
        if item is None or item != item:
            continue
        value: str | int | float = item
        if isinstance(item, str):
            value = item.strip()
            if not value:
                continue
            try:
                value = float(value)
            except ValueError:
                pass
        if isinstance(value, float) and value.is_integer():
            value = int(value)
        wanted[value] = None
    return list(wanted) or None


def select_indicators(df: DataFrame, ids: IndicatorIds = None, column: str = "indicator_id") -> DataFrame:
    """Rows of the requested indicators; prunes partitions of a table partitioned by the id."""
    wanted = normalise_ids(ids)
    if wanted is None:
        return df
    return df.filter(F.col(column).isin([i for i in wanted if not isinstance(i, str)]))


def clean_types(df: DataFrame) -> DataFrame:
    """Cast the tidy columns; a value that does not fit becomes NULL.

    Columns that have their type already are left alone, so filters on them still reach the scan.
    """
    present = {f.name: f.dataType for f in df.schema}
    wrong = [f for f in TIDY_SCHEMA if f.name in present and present[f.name] != f.dataType]
    return df.withColumns({f.name: casts.coerce(F.col(f.name), f.dataType) for f in wrong})


def with_combination_id(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "combination_id", codes.combination_id(F.col("imd_code"), F.col("ethnicity_code"))
    )


def with_duration_label(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "time_period_type",
        dates.duration_label(casts.to_date(F.col("start_date")), casts.to_date(F.col("end_date"))),
    )


def _constant(value: object) -> Column:
    if isinstance(value, Column):
        return value
    return casts.instant(value) if isinstance(value, datetime) else F.lit(value)


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Set constant columns and clear the result columns of rows still to be calculated."""
    values = {name: _constant(v) for name, v in constants.items()}
    empty = {name: F.lit(None).cast("double") for name in RESULT_COLS if name not in values}
    return df.withColumns({**empty, **values})


def stamp_all_persons(df: DataFrame, columns: Iterable[str], **constants: object) -> DataFrame:
    """``stamp`` with the all-persons code in each of ``columns``."""
    return stamp(df, **{c: CODES.all_persons for c in columns}, **constants)


def finite_or_null(df: DataFrame, columns: Iterable[str] = FLOAT_COLS) -> DataFrame:
    return df.withColumns({c: casts.finite(F.col(c)) for c in columns})


def with_insertion_time(df: DataFrame, at: datetime | None = None) -> DataFrame:
    stamp_at = F.current_timestamp() if at is None else casts.instant(at)
    return df.withColumn("insertion_date_time", stamp_at)


def default_unknown(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: codes.default_unknown(F.col(c)) for c in columns})


def recode(df: DataFrame, column: str, mapping: dict[str, str], keep: bool = True) -> DataFrame:
    return df.withColumn(column, codes.recode(F.col(column), mapping, keep))


def tidy(df: DataFrame) -> DataFrame:
    """Calculated rows in the common layout: limits renamed, totals as numerator and denominator."""
    moves = {
        "indicator_value": "value", "lower_ci95": "lowercl", "upper_ci95": "uppercl",
        "numerator": "total_count", "denominator": "total_pop",
    }
    return df.select(
        *[
            F.col(moves[c]).alias(c) if moves.get(c) in df.columns else F.col(c)
            for c in TIDY_COLS
        ]
    )


def census_indicator_ids(metadata: DataFrame) -> DataFrame:
    """Indicators whose denominator comes from the census."""
    from_census = F.lower("denominator_source").contains("census")
    return metadata.filter(from_census).select("indicator_id").distinct()


def filter_practices(
    df: DataFrame,
    system: str,
    size: str | None = "numerator",
    geography: Geography = GEOGRAPHY,
    drop_closed: bool = True,
) -> DataFrame:
    """Rows of one care system, without the excluded practices and closed networks."""
    keep = codes.same_text(F.col("system"), system)
    for practice in geography.excluded_practices:
        keep &= ~codes.same_text(F.col("practice_code"), practice)
    if drop_closed:
        keep &= ~codes.same_text(F.col("pcn_code"), geography.closed_practice)
    if size:
        keep &= F.col(size).isNotNull()
    return df.filter(keep)


def coded_events(
    admission: Column,
    order_in_spell: Column,
    diagnosis: Column,
    diagnosis_codes: Iterable[str] = tuple(SELF_HARM_CODES),
    admission_prefix: str = "2",
) -> tuple[Column, Column]:
    """Conditions on the episode (admission, first in spell) and on its diagnoses."""
    episode = (F.substring(admission, 1, 1) == admission_prefix) & (order_in_spell == 1)
    return episode, F.substring(diagnosis, 1, 3).isin(list(diagnosis_codes))


def in_period(month: Column, first: int, last: int, area: Column, areas: Iterable[str]) -> tuple[Column, Column]:
    """Conditions on the reconciliation month and on the area of residence."""
    return month.between(first, last), area.isin(list(areas))


def filter_geography(df: DataFrame, exclude: Iterable[str], column: str = "aggregation_type") -> DataFrame:
    """Rows of the other area types; a NULL type is dropped, as in SQL."""
    return df.filter(~F.col(column).isin(list(exclude)))


def filter_areas(df: DataFrame, area_codes: DataFrame, column: str = "Area Code") -> DataFrame:
    """Rows whose area code is listed in the first column of ``area_codes``.

    The column is found whatever its spaces and case; without one every row stays.
    """
    found = names.matching(df.columns, column)
    if found is None:
        return df
    listed = area_codes.select(F.col(area_codes.columns[0]).alias(found)).distinct()
    return df.join(bounded(listed), found, "left_semi")


def top_n(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def preview(df: DataFrame, n: int = 1000) -> DataFrame:
    return df.limit(n)


