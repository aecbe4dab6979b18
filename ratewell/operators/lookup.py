"""Enrichment from dimension tables and record-level sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratewell.functions import codes
from ratewell.operators.joins import bounded, lookup_join, spread_join
from ratewell.operators.sets import union_by_name
from ratewell.schema import CODES, ESP2013, METADATA_COLS


def with_metadata(df: DataFrame, metadata: DataFrame) -> DataFrame:
    """Attach the indicator metadata; indicators without metadata keep NULLs."""
    absent = [c for c in METADATA_COLS if c not in metadata.columns]
    if absent:
        raise ValueError(f"metadata lacks {', '.join(absent)}")
    return lookup_join(df, metadata.select(METADATA_COLS), ["indicator_id"], null_safe=True)


def age_lookup(metadata: DataFrame, ages: DataFrame) -> DataFrame:
    """Age code of each indicator, through the age label of its metadata."""
    labels = ages.select(F.col("age_group_label").alias("age"), "age_code")
    return lookup_join(
        metadata.select("indicator_id", "age"), labels, ["age"], null_safe=True
    ).select("indicator_id", "age_code")


def one_age_per_indicator(metadata: DataFrame, ages: DataFrame) -> DataFrame:
    """``age_lookup`` with a single row per indicator, so that it never repeats facts."""
    return age_lookup(metadata, ages).groupBy("indicator_id").agg(F.min("age_code").alias("age_code"))


def standard_population(age_code: Column) -> Column:
    """Standard weight of a five-year band 1..18, NULL for any other code."""
    weights = F.array(*[F.lit(float(w)) for w in ESP2013])
    return F.when(age_code.between(1, CODES.oldest_band), F.get(weights, age_code - 1))


def with_stdpop(df: DataFrame) -> DataFrame:
    """The 18 weights are constants of the plan, so no join is needed."""
    return df.withColumn("stdpop", standard_population(F.col("age_group_code")))


def with_fy_dates(df: DataFrame, dates: DataFrame, column: str = "financial_year") -> DataFrame:
    """Start and end of the financial year; repeated rows of the date table are collapsed first."""
    years = dates.select(
        F.col("financial_year_name").alias(column), "start_date", "end_date"
    ).distinct()
    return df.join(bounded(years), column)


def with_financial_year(df: DataFrame, dates: DataFrame, column: str = "time_period") -> DataFrame:
    """Financial-year name of a reconciliation month (yyyymm); NULL when unknown."""
    months = dates.select(
        F.col("reconciliation_month").alias(column),
        F.col("financial_year_name").alias("financial_year"),
    ).distinct()
    return df.join(bounded(months), column, "left")


def with_practice(df: DataFrame, practices: DataFrame) -> DataFrame:
    """Network, locality and care system of a practice; unknown practices are dropped.

    A practice with several rows counts with the smallest, by network, locality and system.
    """
    columns = ["pcn_code", "locality", "system"]
    return df.join(one_row(practices, "practice_code", columns), "practice_code")


def one_row(lookup: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """The smallest row of each key, NULLs first, so that a join repeats nothing."""
    least = F.min(F.struct(*columns)).alias("__row")
    return lookup.groupBy(key).agg(least).select(key, *[F.col(f"__row.{c}").alias(c) for c in columns])


def _attach(df: DataFrame, found: DataFrame, on: list[str], crowded: bool) -> DataFrame:
    return spread_join(df, found, on) if crowded else df.join(found, on, "left")


def update_from(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    column: str,
    value: str | None = None,
    crowded: bool = False,
) -> DataFrame:
    """Overwrite ``column`` where the key matches, also with a matched NULL; else keep it.

    A lookup with several rows per key counts with its smallest value.  ``crowded`` spreads the
    rows of ``df`` that share a key.
    """
    found = lookup.groupBy(*on).agg(
        F.min(value or column).alias("__value"), F.lit(True).alias("__matched")
    )
    joined = _attach(df, found, on, crowded)
    chosen = F.when(F.col("__matched"), F.col("__value")).otherwise(F.col(column))
    return joined.withColumn(column, chosen).select(df.columns)


def fill_from(
    df: DataFrame,
    sources: list[tuple[DataFrame, Column | None]],
    on: list[str],
    columns: dict[str, str],
    crowded: bool = False,
) -> DataFrame:
    """Fill the NULLs of ``columns`` (name to lookup column) from ``sources`` in order.

    A source is a lookup and a condition on the row, or None for every row.  A lookup with several rows
    per key counts with its smallest values.  The sources are stacked and brought to one row per key
    together, so the rows meet them in one join, however many there are; a condition sees what earlier
    sources have filled.
    """
    every = union_by_name(
        *[
            lookup.select(*on, F.lit(place).alias("__source"), *[F.col(value).alias(f"__{name}") for name, value in columns.items()])
            for place, (lookup, _) in enumerate(sources)
        ]
    )
    offers = {
        f"__{name}_{place}": F.min(F.when(F.col("__source") == place, F.col(f"__{name}")))
        for place in range(len(sources))
        for name in columns
    }
    found = every.groupBy(*on).agg(*[offer.alias(name) for name, offer in offers.items()])
    filled = _attach(df, found, on, crowded)
    for place, (_, condition) in enumerate(sources):
        offered = {name: F.col(f"__{name}_{place}") for name in columns}
        if condition is not None:
            offered = {name: F.when(condition, offer) for name, offer in offered.items()}
        filled = filled.withColumns({name: F.coalesce(F.col(name), offer) for name, offer in offered.items()})
    return filled.select(df.columns)


def map_codes(df: DataFrame, dim: DataFrame, column: str, key: str, code: str) -> DataFrame:
    """Replace a category by its code where the dimension knows it."""
    pairs = dim.select(F.col(key).alias(column), F.col(code).cast("string").alias("__code"))
    pairs = pairs.groupBy(column).agg(F.min("__code").alias("__code"))
    joined = df.join(pairs, column, "left")
    return joined.withColumn(column, F.coalesce("__code", column)).select(df.columns)


def with_small_area(
    df: DataFrame,
    lsoa_2011_to_2021: DataFrame,
    wards: DataFrame,
    localities: DataFrame,
    ward_imd: DataFrame,
) -> DataFrame:
    """Best-fit 2021 small area, then ward, local authority, locality and ward quintile.

    A key with several lookup rows counts with the smallest, so no event is repeated.
    """
    best = one_row(lsoa_2011_to_2021, "lsoa_2011", ["lsoa_2021"]).withColumnRenamed("lsoa_2021", "__best")
    area = (
        df.join(best, "lsoa_2011", "left")
        .withColumn("lsoa_2021", F.coalesce("lsoa_2021", "__best"))
        .drop("__best")
    )
    quintiles = one_row(ward_imd, "ward_code", ["quintile"]).withColumnRenamed("quintile", "imd")
    return (
        area.join(one_row(wards, "lsoa_2021", ["ward_code", "lad_code"]), "lsoa_2021", "left")
        .join(one_row(localities, "lsoa_2021", ["locality"]), "lsoa_2021", "left")
        .join(quintiles, "ward_code", "left")
    )


def keep_footprint(df: DataFrame, allowed: DataFrame) -> DataFrame:
    """Rows whose 2021 small area is listed; a NULL area is dropped."""
    listed = bounded(allowed.select("lsoa_2021").distinct())
    return df.join(listed, "lsoa_2021", "left_semi")


def map_geography(
    df: DataFrame,
    geography: DataFrame,
    types: list[str],
    by: str = "code",
    area: str = "area",
    into: str = "aggregation_id",
) -> DataFrame:
    """Area id by code or label among the given area types; NULL when unknown."""
    key = {"code": "aggregation_code", "label": "aggregation_label"}[by]
    ids = (
        geography.filter(F.col("aggregation_type").isin(types))
        .groupBy(F.col(key).alias(area))
        .agg(F.min("aggregation_id").alias(into))
    )
    return df.join(ids, area, "left")


def join_on(df: DataFrame, other: DataFrame, left: str, right: str) -> DataFrame:
    """Inner join on differently named keys; the left name stays."""
    return df.join(other.withColumnRenamed(right, left), left)


def with_age_codes(df: DataFrame, ages: DataFrame, column: str = "age") -> DataFrame:
    """Numeric age to band label, then to the band's code; the code stays text like its column."""
    banded = df.withColumn(column, codes.age_band(F.col(column)))
    return map_codes(banded, ages, column, "age_group", "age_code")
